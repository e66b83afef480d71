"""Phrase mining against its SQL and against plain Python."""

import random
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
from compare import difference, spark_rows, sql_rows
from tagwright.llm import phrases

FOLDER = "/root/testdata/sf0.001"


def test_equals_its_sql(spark):
    ours = spark_rows(entry.queries()["op13_phrases"](spark, FOLDER))
    assert ours[1]
    assert difference(ours, sql_rows(FOLDER, entry.oracle_sql()["op13_phrases"])) is None


def slow_phrases(rows, longest=3, least=10, held=50, top=2000):
    f = Counter()
    for text, lang in rows:
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in range(1, longest + 1):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    n = Counter()
    for (lang, p), a in f.items():
        n[lang] += a if len(p) == 1 else 0
    found = [(lang, p, a) for (lang, p), a in f.items() if len(p) > 1 and a >= least]
    around = Counter()
    for lang, p, a in found:
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                around[lang, p[i : i + k]] = max(around[lang, p[i : i + k]], a)
    out = []
    for lang in n:
        ranked = []
        for la, p, a in found:
            if la != lang or (around[la, p] and 100 * around[la, p] >= held * a):
                continue
            score, k = min((10**6 * a * a // (f[la, p[:k]] * f[la, p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[la, p[:k]], f[la, p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = ["new", "york", "City", "times", "é", "the", "Ωmega", "x y", "of"]
    rows = []
    for i in range(400):
        words = rng.choices(vocabulary, k=rng.randint(0, 25))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " \v", "?!"]) for w in words)
        rows.append((text + " new york city" * rng.randint(0, 2), rng.choice(["en", "de", None, "und"])))
    return [*rows, (None, "en"), ("", "fr"), (" \t.\n", None), ("one", "fr"), rows[0], rows[0]]


@pytest.mark.parametrize("how", [{}, {"least": 2, "held": 80, "top": 7}, {"longest": 2, "least": 3}, {"longest": 4, "least": 4, "top": 50}, {"tail_most": 2}, {"tail_most": 1, "longest": 2}])
def test_equals_brute_force(spark, texts, how):
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(6)
    given = {"held_percent" if k == "held" else k: v for k, v in how.items()}
    ours = sorted(map(tuple, phrases.collocations(docs, **given).collect()))
    assert ours == slow_phrases(texts, **{k: v for k, v in how.items() if k != "tail_most"}) and ours


def test_windows_are_padded_and_stay_in_their_piece(spark):
    docs = spark.createDataFrame([("A b. c\td e", None)], "text string, lang string")
    assert sorted(map(tuple, phrases.windows(docs, least=1).collect())) == [
        ("und", "a", "b", ".", 1), ("und", "b", ".", ".", 1), ("und", "c", "d", "e", 1), ("und", "d", "e", ".", 1),
        ("und", "e", ".", ".", 1),
    ]
    # Rare words are counted together, and no sum over windows changes.
    assert sum(r.f for r in phrases.windows(docs).collect()) == 5


@pytest.mark.parametrize("how", [{}, {"tail_most": 1}, {"longest": 4}])
def test_pieces_of_a_long_text_join(spark, texts, monkeypatch, how):
    """Counting a few positions at a time, and flushing every few texts, changes nothing."""
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(2)
    plain = sorted(map(tuple, phrases.collocations(docs, **how).collect()))
    counting = phrases.Counting(how.get("longest", 3), 4, how.get("tail_most", 1024))
    text = " ".join(t or "" for t, _ in texts).encode()

    def total(blobs):
        out, places = Counter(), {}
        for bucket, blob in blobs:
            for line in blob.split(b"\n"):
                window, _, n = line.partition(b"\t")
                out[window] += int(n or 1)
                if "tail_most" not in how:
                    assert places.setdefault(window.rpartition(b" ")[0], bucket) == bucket
        return +out

    whole = total(counting.blobs([text]))
    monkeypatch.setattr(phrases, "_POSITIONS", 7)
    assert total(counting.blobs([text])) == whole
    monkeypatch.setattr(phrases, "FLUSH_BYTES", 300)
    assert sorted(map(tuple, phrases.collocations(docs, **how).collect())) == plain


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits: counts of 10 to the 12th give the score to the last digit."""
    a, l, r = 999_999_999_989, 999_999_999_999, 1_000_000_000_007
    big = "CAST({} AS DECIMAL(15, 0))"
    row = spark.range(1).selectExpr(
        f"(CAST({phrases.SCALE} AS DECIMAL(7, 0)) * ({big.format(a)} * {big.format(a)})) div ({big.format(l)} * {big.format(r)}) AS s"
    ).first()
    assert row.s == phrases.SCALE * a * a // (l * r)


def test_odd_and_empty_tables(spark, odd):
    rows = phrases.collocations(odd).collect()
    assert {r.lang for r in rows} == {"und"} and [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))
    assert phrases.collocations(odd.limit(0)).collect() == []
    assert phrases.collocations(odd.filter("text IS NULL")).collect() == []
