"""Personal data: base patterns, generators of further candidates, and boosted trees that choose.

The generators propose spans generously: mail addresses with written-out signs, numbers
in groups without a plus sign, dotted numbers. They overlap each other and the base matches. A
boosted-tree model reads a candidate's format and its context; what it scores at or above its kind's
calibrated threshold joins the base spans unless it overlaps one of its own kind. Base matches stay always.

No table labels personal data, so the trees learn from the corpus itself: candidates from a bounded sample of rows, those of
which that the base rules confirm, or refute in any form (a bad check digit, a part over 255, a wrong number of digits). Both
are also learnt rewritten into forms the base rules do not know; candidates that are neither are not learnt as
refuted. The signs that make the base rules match (a plus, an at sign) are
hidden from the features, so that what is learnt is how such data look and what stands around them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import as_bytes, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Rows that the model is fitted on at most, chosen by hash; bounds what the driver holds.
SAMPLE_ROWS = 4000
#: Candidates that are learnt from one text at most, chosen by hash from anywhere in it.
SAMPLE_CANDIDATES = 20
#: A threshold is the least score at which at least this share of the confirmed sample is precise.
PRECISION = 0.995

# The base rules, written so that time grows with the text. Runs are taken whole and never given back, which changes
# no match, as no run can end with what has to follow it; and a run that leads to no match is not tried from its middle.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_WIDE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?(?:[\[({]\s?at\s?[\])}]|@)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:[\[({]\s?dot\s?[\])}]|\.)\s?[A-Za-z0-9-]{2,63})+", re.I),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?[.\[\]()]{1,3}\s?[0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ .\-/]{0,2}[0-9]{3,6}){2,4}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:00|\+|\()?[0-9]{2,4}\)?(?:[ ().\-/]{1,2}[0-9]{2,4}){2,4}(?![0-9])"),
}
_WRITTEN_AT = re.compile(r"\s?[\[({]\s?at\s?[\])}]\s?", re.I)
_WRITTEN_DOT = re.compile(r"\s?[\[({]\s?dot\s?[\])}]\s?", re.I)
_CUES = {
    "email": re.compile(r"mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|host|address|server", re.I),
    "card": re.compile(r"card|visa|credit|payment", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _valid(kind: str, s: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in s.split(".")))
    digits = _digits(s)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base matches of each kind, leftmost and without overlap; failing ones are dropped."""
    out = []
    # The name of an address is the run before its sign, which cannot hold a sign itself nor reach into the match before.
    begin = 0
    while (at := text.find("@", begin)) >= 0:
        left = at
        while left > begin and text[left - 1] in _MAIL:
            left -= 1
        domain = _DOMAIN.match(text, at + 1) if left < at else None
        begin = domain.end() if domain else at + 1
        if domain:
            out.append(("email", left, begin))
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            if kind == "phone" and "+" not in text:
                continue
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if _valid(kind, m.group())]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_MAIL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


class Spans:
    """Spans of each kind without overlap, in order: one step to tell whether another overlaps one of them."""

    def __init__(self, spans: list[tuple[str, int, int]] = ()):
        self.by = {k: [] for k in KINDS}
        for span in spans:
            self.add(span)

    def add(self, span: tuple[str, int, int]) -> None:
        insort(self.by[span[0]], span[1:])

    def overlap(self, kind: str, start: int, end: int) -> bool:
        own = self.by[kind]
        at = bisect_left(own, (end, 0))
        return at > 0 and own[at - 1][1] > start

    def inside(self, kind: str, start: int, end: int) -> bool:
        """Whether the span lies within one of the kind."""
        own = self.by[kind]
        at = bisect_left(own, (start + 1, 0))
        return at > 0 and own[at - 1][1] >= end


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that might be personal data; they may overlap, also within a kind."""
    out = []
    if "@" in text or "at" in text:
        if "@" in text or re.search(r"[\[({]\s?at\s?[\])}]", text, re.I):
            out += [("email", m.start(), m.end()) for m in _WIDE["email"].finditer(text)]
    if _DIGIT.search(text):
        for kind in ("ip", "card", "phone"):
            out += [(kind, m.start(), m.end()) for m in _WIDE[kind].finditer(text)]
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate, without the plus of a phone number, and with written-out signs put back."""
    s = text[start:end].lstrip("+")
    if kind == "email":
        s = _WRITTEN_DOT.sub(".", _WRITTEN_AT.sub("@", s))
    before, after = text[max(0, start - 24) : start], text[end : end + 24]
    digits = len(_DIGIT.findall(s))
    groups = re.findall(r"[0-9]+", s)
    return [
        float(KINDS.index(kind)),
        len(s),
        digits,
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        s.count(" "),
        s.count("-"),
        s.count("."),
        s.count("(") + s.count(")") + s.count("[") + s.count("]"),
        float(luhn(_digits(s))) if digits else 0.0,
        max((int(g) for g in groups if len(g) < 6), default=0),
        float(bool(_CUES[kind].search(before))),
        len(_DIGIT.findall(before)),
        len(_DIGIT.findall(after)),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before.rstrip()[-1:] in "=:\""),
    ]


# ---- boosted trees ----------------------------------------------------------


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, int, float] | None:
    """The best (gain, feature, threshold) of a node, or none."""
    total_g, total_h, best = g.sum(), h.sum(), None
    base = total_g**2 / (total_h + 1.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        at = np.flatnonzero(v[1:] > v[:-1])
        if not len(at):
            continue
        lg, lh = np.cumsum(g[order])[at], np.cumsum(h[order])[at]
        gain = lg**2 / (lh + 1) + (total_g - lg) ** 2 / (total_h - lh + 1) - base
        gain[(lh < least) | (total_h - lh < least)] = -1
        k = int(np.argmax(gain))
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), f, float((v[at[k]] + v[at[k] + 1]) / 2))
    return best


def _grow(x, g, h, depth, rate):
    """A tree as nested tuples: (feature, threshold, left, right) or a leaf's value."""
    found = _split(x, g, h, 0.5) if depth and len(x) > 4 else None
    if found is None:
        return -rate * float(g.sum() / (h.sum() + 1.0))
    _, f, t = found
    left = x[:, f] <= t
    return (f, t, _grow(x[left], g[left], h[left], depth - 1, rate), _grow(x[~left], g[~left], h[~left], depth - 1, rate))


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, t, a, b = tree
    return np.where(x[:, f] <= t, _apply(a, x), _apply(b, x))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3) -> list:
    margin, out = np.zeros(len(y)), []
    for _ in range(trees if len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        out.append(_grow(x, p - y, p * (1 - p), depth, rate))
        margin += _apply(out[-1], x)
    return out


def score(model: list, x: np.ndarray) -> np.ndarray:
    margin = np.zeros(len(x))
    for tree in model:
        margin += _apply(tree, x)
    return 1 / (1 + np.exp(-margin))


_DATE = re.compile(r"(?:19|20)[0-9]{2}[-/. ][0-9]{1,2}[-/. ][0-9]{1,2}(?![0-9])")


def _refuted(kind: str, s: str) -> bool:
    """Whether no form of the kind allows the span, whatever its separators and signs."""
    if kind == "email":
        name, _, domain = _WRITTEN_DOT.sub(".", _WRITTEN_AT.sub("@", s)).partition("@")
        labels = domain.strip().split(".")
        return not labels[-1].isalpha() or any(p != p.strip("-") for p in labels) or name.strip() != name.strip().strip(".")
    digits = _digits(s)
    if kind == "ip":
        return any(int(p) > 255 for p in re.findall(r"[0-9]+", s))
    if kind == "card":
        return not 12 <= len(digits) <= 19 or not luhn(digits)
    return not 9 <= len(digits) <= 15 or bool(_DATE.match(s))


def _rewrites(kind: str, s: str) -> list[str]:
    """The span in forms that the base rules do not know."""
    if kind == "email":
        return [s.replace("@", at).replace(".", dot) for at, dot in ((" [at] ", "."), (" (at) ", " (dot) "), (" @ ", "."))]
    if kind == "ip":
        return [s.replace(".", "[.]"), s.replace(".", " . ")]
    digits = _digits(s)
    if kind == "card":
        return [sep.join(re.findall("....|.+", digits)) for sep in (".", "/")]
    return [s.lstrip("+"), "00" + s.lstrip("+"), s.lstrip("+").replace(" ", "-"), s.lstrip("+").replace("-", " ").replace(" ", ".")]


def lessons(text: str, most: int = SAMPLE_CANDIDATES) -> tuple[list[list[float]], list[float]]:
    """Features and labels of the candidates that the base rules confirm (1) or refute (0), as they are and rewritten.

    Rewriting both keeps the form from telling them apart. Candidates that are neither teach nothing: they
    are what the model is asked about. Nor does a phone number that could also be a card. Of more than ``most`` candidates, those
    whose surroundings have the least hashes teach, wherever in the text they are.
    """
    base, told, x, y = Spans(base_spans(text)), [], [], []
    for kind, start, end in candidates(text):
        if base.overlap(kind, start, end):
            told.append((1.0, kind, start, end))
        elif _refuted(kind, text[start:end]) or any(base.inside(k, start, end) for k in ("email", "ip")):
            told.append((0.0, kind, start, end))
    if len(told) > most:
        told.sort(key=lambda c: (zlib.crc32(text[max(0, c[2] - 40) : c[3] + 40].encode()), c[2], c[1]))
    for label, kind, start, end in told[:most]:
        s = text[start:end]
        x.append(features(text, kind, start, end))
        y.append(label)
        before, after = text[max(0, start - 80) : start], text[end : end + 80]
        for other in _rewrites(kind, s):
            near, a, b = before + other + after, len(before), len(before) + len(other)
            # The first span that the generator proposes for most of what was rewritten.
            for k, u, v in candidates(near):
                if k == kind and 2 * (min(v, b) - max(u, a)) > len(other):
                    x.append(features(near, k, u, v))
                    y.append(label)
                    break
    return x, y


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, per_text: int = SAMPLE_CANDIDATES) -> dict:
    """Trees and thresholds from about ``rows`` distinct texts that hold candidates, chosen by hash, and never from over twice as many.

    Whole texts are read, in tasks; ``per_text`` candidates of each text at most and their rewritten forms are learnt, and the
    driver gets their features only. A fifth of the texts sets the thresholds: as low as they may be for
    ``PRECISION`` of what they accept to be confirmed, and 0.5 at least. A kind without confirmed candidates accepts none.
    """
    found = docs.select(text_or_empty().alias("text")).filter("text RLIKE '[0-9@]'").withColumn("h", F.xxhash64("text"))
    kinds = found.agg(F.approx_count_distinct("h")).first()[0]
    # A share of the hashes: tasks send what is in the sample, not candidates for it. Copies count once.
    share = min(1.0, rows / max(1, kinds))
    chosen = found.filter(F.pmod("h", F.lit(1_000_003)) < int(share * 1_000_003) + (share == 1.0))
    sample = chosen.groupBy("h").agg(F.first("text").alias("text")).orderBy("h").limit(2 * rows)

    def learn(batches):
        for batch in batches:
            hashes, features_, labels = [], [], []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = lessons(text, per_text)
                hashes += [h] * len(x)
                features_ += x
                labels += y
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), pa.array(features_, pa.list_(pa.float64())), pa.array(labels, pa.float64())],
                ["h", "x", "y"],
            )

    got = sorted((r.h, list(r.x), r.y) for r in sample.mapInArrow(learn, "h long, x array<double>, y double").collect())
    x, y = [r[1] for r in got], [r[2] for r in got]
    held = [r[0] % 5 == 0 for r in got]
    if not x:
        return {"trees": [], "least": {k: 2.0 for k in KINDS}}
    x, y, held = np.array(x, float), np.array(y), np.array(held)
    trees = boost(x[~held], y[~held])
    scores, least = score(trees, x), {}
    for i, kind in enumerate(KINDS):
        own = x[:, 0] == i
        least[kind] = 2.0
        if not own.any():
            continue
        use = own & held if (own & held).any() else own
        order = np.argsort(-scores[use], kind="stable")
        s, good = scores[use][order], np.cumsum(y[use][order])
        fine = np.flatnonzero((good / np.arange(1, len(s) + 1) >= PRECISION) & np.r_[s[1:] < s[:-1], True])
        if not len(fine):
            continue
        k = fine[-1]
        # Halfway to the best score that is refused; 0.5 if none is.
        least[kind] = max(0.5, float((s[k] + s[k + 1]) / 2)) if k + 1 < len(s) else 0.5
    return {"trees": trees, "least": least}


def found_spans(text: str, model: dict) -> tuple[list, list]:
    """Base spans, and all spans: the base ones and what the model adds, by start and kind."""
    base = base_spans(text)
    known, taken = Spans(base), Spans()
    more = [c for c in candidates(text) if not known.overlap(*c)]
    added: list[tuple[str, int, int]] = []
    if more and model["trees"]:
        scores = score(model["trees"], np.array([features(text, *c) for c in more], float))
        for c, p in sorted(zip(more, scores), key=lambda x: (-x[1], x[0][1], x[0][2])):
            if p >= model["least"][c[0]] and not taken.overlap(*c):
                taken.add(c)
                added.append(c)
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans``.

    Counts and hash are of the base spans, ``spans`` has all. Positions are code points, the end is
    exclusive. Null and empty texts have no spans; time grows with the length of a text, also if it is one run. Rows stand alone: repeated rows and
    doc_ids give repeated results, other columns are ignored, an empty table gives no rows.
    """
    model = model or fit(docs)

    def work(batches):
        for batch in batches:
            rows = []
            for t in as_bytes(batch.column(1)):
                base, every = found_spans(t.decode(), model)
                count = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:4]]]
                + [pa.array(c, pa.string()) for c in columns[4:]],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    rows = docs.select("doc_id", text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        work, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )
