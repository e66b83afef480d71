"""Texts that are one long run: same results as the plain rules, in time and memory that grow with the text."""

import random
import re
import time

import public_tokenizers
import pytest

from tagwright.llm import pii, tokens

# The base rules as they are stated.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, kind in enumerate(PLAIN):
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


@pytest.mark.parametrize("alphabet", ["a@.", "a_@.-b", "12.", "0123.+ -()", "4 -1", "+12 ()-.", "a1@.+_-% (", "aé@1.+😀 "])
def test_base_spans_equal_the_plain_rules(alphabet):
    rng = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_leading_zeros_beyond_the_limit_of_integers():
    text = "0" * 6000 + "1.2.3.4"
    assert pii.base_spans(text)[0] == ("ip", 0, len(text))


N = 1_000_000


@pytest.mark.parametrize(
    "text",
    ["1" * N, "a" * N, "a" * N + "@x", "a@" * (N // 2), "1." * (N // 2), "+1(" * (N // 3), "1 " * (N // 2), "a.b@c.d " * (N // 8),
     "12345678 " * (N // 9), "x" * N + "@" + "y" * N, "a [at] " * (N // 7)],
    ids=range(11),
)
def test_a_megabyte_takes_seconds(text):
    model = {"trees": [], "least": {k: 2.0 for k in pii.KINDS}}
    start = time.process_time()
    pii.found_spans(text, model)
    assert time.process_time() - start < 20


def test_many_spans_of_one_text():
    text = "".join(f"mail u{i}@h{i}.org or 10.0.{i % 256}.1, " for i in range(20_000))
    start = time.process_time()
    base, _ = pii.found_spans(text, {"trees": [0.5], "least": {k: 2.0 for k in pii.KINDS}})
    assert len(base) == 40_000 and time.process_time() - start < 60
    x, y = pii.lessons(text, 20)
    assert 20 <= len(x) == len(y) <= 100


def test_spans_know_overlaps():
    rng = random.Random(3)
    spans = pii.Spans()
    kept = []
    for _ in range(400):
        s = rng.randrange(1000)
        e = s + rng.randint(1, 20)
        slow = any(a < e and b > s for a, b in kept)
        assert spans.overlap("ip", s, e) == slow and not spans.overlap("card", s, e)
        assert spans.inside("ip", s, e) == any(a <= s and b >= e for a, b in kept)
        if not slow:
            kept.append((s, e))
            spans.add(("ip", s, e))


@pytest.fixture(scope="module")
def scores():
    return tokens.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def test_long_pre_tokens_count_alike_with_and_without_nodes(scores):
    rng = random.Random(1)
    for n in (1, 5, 30, 200, 3000):
        word = "▁" + "".join(rng.choices("abcdeinorst😀é1", k=n))
        whole = tokens.Trie(scores).add(word)
        for deep in (1, 2, 7, 40, len(word) - 1, len(word)):
            if deep:
                assert tokens.Trie(scores, deep=deep).add(word) == whole


def test_one_run_takes_bounded_nodes(scores):
    trie = tokens.Trie(scores, nodes=10_000)
    start = time.process_time()
    assert trie.add("▁" + "ab" * (N // 4)) > 0
    assert len(trie) <= tokens.DEEP + 1 and time.process_time() - start < 60
    for i in range(30):
        trie.add("▁" + f"{i:03d}" * 500)
    assert len(trie) <= 10_000 + 1502
