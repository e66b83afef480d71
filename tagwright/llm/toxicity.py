"""Toxicity by weak supervision: many voters, a generative model of their accuracies, a linear classifier.

Voters are words of a built-in lexicon, words and word beginnings that labelled rows show to
mark toxic text, and patterns (several hits, hits close together, shouting, runs of signs, attacks in the second
person). Each votes or abstains on a whole text. A generative model explains the votes of all documents
by a hidden class: how often each voter speaks in either class, and how it depends on the voter it is most
correlated with, given the class (a tree of dependencies). Expectation maximisation fits it over the counts of
distinct vote patterns, anchored by the training labels. Its posteriors are the labels on which the linear
classifier is trained.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import stored
from tagwright.operators.skew import spread_join

#: Labelled rows per label that the lexicon is learnt from, drawn by hash of their doc_id.
LEXICON_ROWS = 4000
#: Learnt voters at most; with the others they fit into the 62 bits of a vote pattern.
LEARNT = 36
#: A learnt term occurs in at least so many toxic rows, and so precisely.
TERM_ROWS, TERM_PRECISION = 3, 0.7
#: How far a training label is trusted by the generative model.
TRUST = 0.98
EM_STEPS, NEWTON_STEPS = 8, 10
RIDGE = 0.05
ACCEPTED = 0.7
FOLDS, HELD_OUT = 3, 1

LEXICON = "idiot moron stupid loser trash scum worthless pathetic disgusting clown dumb fool garbage".split()
#: Texts as they are (``raw``) or in lower case (``low``).
PATTERNS = {
    "attack": ("low", r"\b(?:shut up|get lost|go to hell|hate you|you are an?|you're an?|du bist|tu es|eres un)\b"),
    "signs": ("raw", r"[!?*#$%&@]{3}"),
    "shouting": ("raw", r"(?:\b[A-Z]{3,}\W+){4}"),
}

_WORD = re.compile(r"[^\W_]+")
_STEMS = (4, 5, 6)
_MOST_CHARS = 40
_DEFAULT_PRIOR = 0.05


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def stems(found: set[str]) -> Counter:
    """How many distinct words begin with each 4, 5 or 6 letters."""
    return Counter([w[:k] for w in found for k in _STEMS if len(w) > k])


def terms(found: set[str]) -> set[str]:
    """``=word``, and ``1^stem`` to ``3^stem`` for stems that so many distinct words share."""
    out = {"=" + w for w in found if len(w) <= _MOST_CHARS}
    for stem, n in stems(found).items():
        out.update(f"{k}^{stem}" for k in range(1, min(n, 3) + 1))
    return out


def held_out(doc_id: str = "doc_id") -> str:
    """SQL: the row is in the fold that nothing is learnt from."""
    return f"crc32(CAST(coalesce(CAST({doc_id} AS string), '') AS binary)) % {FOLDS} = {HELD_OUT}"


def training_labels(labels: DataFrame, target: str = "toxic") -> DataFrame:
    """One row (``id``, ``y``) per labelled doc_id outside the held-out fold; of several labels the greater."""
    return (
        labels.select(F.col("doc_id").alias("id"), F.col(target).cast("int").alias("y"))
        .filter(f"y IN (0, 1) AND id IS NOT NULL AND NOT {held_out('id')}")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )


def learnt_terms(
    docs: DataFrame, known: DataFrame, rows: int = LEXICON_ROWS, most: int = LEARNT, known_words: list[str] = LEXICON
) -> list[str]:
    """Terms that mark toxic rows, the most telling first.

    Terms are counted in Spark over the whole texts of at most ``rows`` doc_ids per label. One is kept if its share of toxic rows
    is too large for chance even among all terms tested (those frequent enough to stand out at all), and it is precise at the labels' natural shares.
    Terms that a kept stem covers as precisely, or that are in ``known_words``, add nothing and go.
    """
    share = dict(known.groupBy("y").count().collect())
    if len(share) < 2:
        return []
    prior = share[1] / (share[0] + share[1])
    # The hash bound holds about ``rows`` of each label, however large the table; it is broadcast.
    cut = " OR ".join(
        f"y = {y} AND pmod(xxhash64(id), 1000003) < {min(1000003, int(1000003 * rows / share[y]) + 1)}" for y in (0, 1)
    )
    chosen = known.filter(cut)

    def count(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in terms(words(text or "")):
                    seen.setdefault(term, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string())]
                + [pa.array([n[y] for n in seen.values()], pa.int64()) for y in (0, 1)],
                ["term", "neg", "pos"],
            )

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), F.expr("doc_id = id")
    )
    counts = stored(
        texts.select("y", "text")
        .mapInArrow(count, "term string, neg long, pos long")
        .groupBy("term")
        .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")),
        "terms",
    )
    drawn = dict(texts.groupBy("y").count().collect())
    if len(drawn) < 2:
        return []
    base = drawn[1] / (drawn[0] + drawn[1])
    # Terms too rare to stand out, were all their rows toxic, are not tested and need not be answered for.
    many = counts.groupBy(F.expr("least(pos + neg, 64)").alias("n")).count().collect()
    for least in range(TERM_ROWS, 65):
        tested = sum(r["count"] for r in many if r.n >= least)
        if least * -np.log(base) >= np.log(max(tested, 1)):
            break
    if not tested:
        return []
    told = counts.filter(f"pos >= {TERM_ROWS}").selectExpr(
        "term",
        "pos / (pos + neg) AS p",
        "pos + neg AS n",
        f"(pos + 0.5D) / {drawn[1] + 1} * {prior!r}D AS a",
        f"(neg + 0.5D) / {drawn[0] + 1} * {1 - prior!r}D AS b",
    )
    # Bits of evidence: how much the share of toxic rows departs from that of all rows drawn.
    evidence = f"n * (p * ln(p / {base!r}D) + IF(p < 1, (1 - p) * ln((1 - p) / {1 - base!r}D), 0D))"
    best = (
        told.selectExpr("term", "a / (a + b) AS precise", f"{evidence} AS evidence", "p")
        .filter(f"p > {base!r}D AND evidence > ln({tested}) AND precise >= {TERM_PRECISION}")
        .orderBy(F.desc("evidence"), "term")
        .limit(60 * most)
        .collect()
    )
    kept: dict[str, float] = {}
    for r in best:
        word = r.term.lstrip("=123^")
        covered = any(
            (t[0] == "1" and word.startswith(t[2:]) or t[0] in "23" and r.term[0] in "23" and word.startswith(t[2:]))
            and precise >= 0.95 * r.precise
            for t, precise in kept.items()
        )
        if not covered and not any(w.startswith(word) for w in known_words):
            kept[r.term] = r.precise
        if len(kept) == most:
            break
    return list(kept)


class Voters:
    """Text → vote pattern (bit k: the k-th voter speaks) and its number of hits, on a scale of 8."""

    def __init__(self, lexicon: list[str], learnt: list[str], patterns: dict[str, tuple[str, str]] = PATTERNS):
        self.names = ["=" + w for w in lexicon] + learnt + [*patterns, "two hits", "three hits", "close hits"]
        at = {n: k for k, n in enumerate(self.names)}
        self.words = {n[1:]: k for n, k in at.items() if n[0] == "="}
        self.stems = [(n[2:], int(n[0]), k) for n, k in at.items() if n[0] in "123" and n[1:2] == "^"]
        self.sizes = sorted({len(s) for s, _, _ in self.stems})
        self.patterns = [(side, re.compile(p), at[n]) for n, (side, p) in patterns.items()]
        self.several = [at["two hits"], at["three hits"], at["close hits"]]
        assert len(self.names) <= 62

    def __call__(self, text: str) -> tuple[int, int]:
        low = text.lower()
        all_words = _WORD.findall(low)
        found = set(all_words)
        bits, hit = 0, set()
        for w in found.intersection(self.words):
            bits |= 1 << self.words[w]
            hit.add(w)
        if self.stems:
            begins = {s: [w for w in found if w.startswith(s)] for s in {s for s, _, _ in self.stems} if s in low}
            for stem, least, k in self.stems:
                own = [w for w in begins.get(stem, ()) if len(w) > len(stem)]
                if len(own) >= least:
                    bits |= 1 << k
                    hit.update(own)
        for side, pattern, k in self.patterns:
            if pattern.search(text if side == "raw" else low):
                bits |= 1 << k
        total = 0
        if hit:
            places = [i for i, w in enumerate(all_words) if w in hit]
            total = len(places)
            two, three, close = self.several
            bits |= (len(hit) > 1) << two | (len(hit) > 2) << three
            bits |= any(b - a <= 20 for a, b in zip(places, places[1:])) << close
        return bits, min(7, total.bit_length())


def votes(docs: DataFrame, voters: Voters) -> DataFrame:
    """``doc_id``, ``bits`` and ``hits`` of every row, over whole texts; null is the empty text."""

    def work(batches):
        for batch in batches:
            got = [voters(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b for b, _ in got], pa.int64()), pa.array([h for _, h in got], pa.int32())],
                ["doc_id", "bits", "hits"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, bits long, hits int")


def _matrix(bits: np.ndarray, m: int) -> np.ndarray:
    return (bits[:, None] >> np.arange(m) & 1).astype(float)


class LabelModel:
    """P(toxic), and of each voter P(speaks | its parent voter speaks or not, class)."""

    def __init__(self, prior: float, parent: np.ndarray, p: np.ndarray):
        self.prior, self.parent, self.p = prior, parent, p  # p[class, parent's vote, voter]

    def posterior(self, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
        """Of vote patterns as rows of 0 and 1; ``label`` is -1 where there is none."""
        above = np.where(self.parent >= 0, b[:, np.maximum(self.parent, 0)], 0).astype(bool)
        logs = []
        for y in (0, 1):
            p = np.where(above, self.p[y, 1], self.p[y, 0])
            logs.append(np.log(np.where(b > 0, p, 1 - p)).sum(axis=1) + np.log(self.prior if y else 1 - self.prior))
        z = logs[1] - logs[0]
        if label is not None:
            z = z + np.where(label < 0, 0, np.log(TRUST / (1 - TRUST)) * (2 * label - 1))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _summed(patterns: DataFrame, work, size: int) -> np.ndarray:
    """The sum over all patterns of the vector ``work(bits, hits, y, n)``: one vector per task, added up in Spark."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            bits, hits, y, n = (c.to_numpy() for c in batch.columns)
            total += work(bits, hits, y, n.astype(float))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], ["k", "v"])

    out = np.zeros(size)
    # At most ``size`` rows, a number that the voters fix.
    for k, v in patterns.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v")).collect():
        out[k] = v
    return out


def _tables(sums: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the classes, and for each class the weight of every pair of voters that speak together."""
    return sums[:2], sums[2:].reshape(2, m, m)


def _tree(n: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Each voter's parent: the forest of greatest mutual information given the class, edges over noise only."""
    m = s.shape[1]
    total = n.sum()
    information = np.zeros((m, m))
    for y in (0, 1):
        one = np.diag(s[y])
        joint = np.stack([s[y], one[:, None] - s[y], one[None, :] - s[y], n[y] - one[:, None] - one[None, :] + s[y]])
        joint = np.maximum(joint, 0) + 0.25
        size = joint.sum(axis=0)
        a, b = (joint[0] + joint[1]) / size, (joint[0] + joint[2]) / size
        expected = np.stack([a * b, a * (1 - b), (1 - a) * b, (1 - a) * (1 - b)])
        information += (joint * np.log(joint / size / expected)).sum(axis=0) / max(total, 1e-9)
    np.fill_diagonal(information, 0)
    parent = np.full(m, -1)
    inside, gain, best = np.zeros(m, bool), np.zeros(m), np.full(m, -1)
    noise = np.log(total + 1) / max(total, 1)
    for _ in range(m):
        j = int(np.argmax(np.where(inside, -1, gain)))
        inside[j] = True
        parent[j] = best[j] if gain[j] > noise else -1
        better = ~inside & (information[j] > gain)
        gain[better], best[better] = information[j][better], j
    return parent


def _model(n: np.ndarray, s: np.ndarray, parent: np.ndarray) -> LabelModel:
    """The most likely tables for these weights, with a little smoothing towards the voter's own rate."""
    m = len(parent)
    p = np.empty((2, 2, m))
    up = np.maximum(parent, 0)
    for y in (0, 1):
        one = np.diag(s[y])
        rate = (one + 0.02) / (n[y] + 1)
        together, above = s[y][np.arange(m), up], one[up]
        p[y, 1] = np.where(parent >= 0, (together + 2 * rate) / (above + 2), rate)
        p[y, 0] = np.where(parent >= 0, (np.maximum(one - together, 0) + 2 * rate) / (np.maximum(n[y] - above, 0) + 2), rate)
    return LabelModel((n[1] + 0.5) / (n.sum() + 1), parent, np.clip(p, 1e-6, 1 - 1e-6))


def _expected(model: LabelModel | None, m: int):
    """Work for ``_summed``: class weights and pair weights under the model, or by the labels alone."""

    def work(bits, hits, y, n):
        b = _matrix(bits, m)
        if model is None:
            r, n = np.where(y == 1, 1.0, 0.0), np.where(y < 0, 0.0, n)
        else:
            r = model.posterior(b, y)
        out = [np.array([(n * (1 - r)).sum(), (n * r).sum()])]
        out += [(b * (n * w)[:, None]).T @ b for w in (1 - r, r)]
        return np.concatenate([o.ravel() for o in out])

    return work


def fit_label_model(patterns: DataFrame, voters: Voters, steps: int = EM_STEPS) -> LabelModel:
    """Accuracies and correlations of the voters by expectation maximisation over ``bits``, ``y`` and ``n``.

    The first tables are those of the training labels. Without labels of both kinds the built-in lexicon is
    taken to be mostly right. Every step is one job over the distinct vote patterns; only sums reach the driver.
    """
    m = len(voters.names)
    size = 2 + 2 * m * m
    n, s = _tables(_summed(patterns, _expected(None, m), size), m)
    if n.min() > 0:
        model = _model(n, s, _tree(n, s))
    else:
        speaks = np.array([[[0.005 if x[0] == "=" else 0.05] * 2, [0.2] * 2] for x in voters.names]).transpose(1, 2, 0)
        model = LabelModel(_DEFAULT_PRIOR, np.full(m, -1), speaks)
    for _ in range(steps):
        n, s = _tables(_summed(patterns, _expected(model, m), size), m)
        model = _model(n, s, _tree(n, s))
    return model


def _features(bits: np.ndarray, hits: np.ndarray, m: int) -> np.ndarray:
    b = _matrix(bits, m)
    return np.hstack([np.ones((len(b), 1)), b, hits[:, None] / 4.0])


def fit_classifier(patterns: DataFrame, model: LabelModel, m: int, steps: int = NEWTON_STEPS) -> np.ndarray:
    """Weights of a logistic classifier on the posterior labels, by Newton steps over the distinct patterns."""
    d = m + 2
    beta = np.zeros(d)
    ridge = np.r_[1e-6, np.full(d - 1, RIDGE)]

    def at(beta):
        def work(bits, hits, y, n):
            x = _features(bits, hits, m)
            goal = model.posterior(_matrix(bits, m), y)
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            return np.r_[x.T @ (n * (p - goal)), ((x * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x).ravel()]

        return work

    for _ in range(steps):
        sums = _summed(patterns, at(beta), d + d * d)
        step = np.linalg.solve(sums[d:].reshape(d, d) + np.diag(ridge), sums[:d] + ridge * beta)
        beta = beta - np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-3:
            break
    return beta


def score_rows(voted: DataFrame, beta: np.ndarray, m: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            x = _features(batch.column(1).to_numpy(), batch.column(2).to_numpy(), m)
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])

    return voted.mapInArrow(work, f"doc_id {voted.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, target: str = "toxic", lexicon_rows: int = LEXICON_ROWS) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Only the text is an input of the score. Null and empty texts are scored as the text on which no voter speaks. Rows stand
    alone: repeated rows and doc_ids give repeated results, and a doc_id that repeats in ``docs`` has its label in every
    row. Labels that are null or have no document are ignored; a null doc_id is hashed as the empty text and has no
    label. Other columns are ignored; an empty table gives no rows.
    """
    known = stored(training_labels(labels, target), "known")
    voters = Voters(LEXICON, learnt_terms(docs, known, lexicon_rows))
    m = len(voters.names)
    voted = stored(votes(docs, voters), "votes")
    labelled = spread_join(voted, known.select(F.col("id").alias("doc_id"), "y"), "doc_id", "left")
    patterns = stored(
        labelled.groupBy("bits", "hits", F.coalesce("y", F.lit(-1)).alias("y")).agg(F.count(F.lit(1)).alias("n")),
        "patterns",
    )
    model = fit_label_model(patterns, voters)
    beta = fit_classifier(patterns, model, m)
    return score_rows(voted, beta, m).selectExpr(
        "doc_id", f"{held_out()} AS held_out", "score", f"IF(score >= {ACCEPTED}, 1, 0) AS predicted"
    )
