"""The pipeline's stages, each on what the one before kept, against plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tagwright.llm import packing, quality
from tagwright.llm.common import table
from test_brute_force import check_packed, lower, slow_components, slow_fingerprint, slow_targets

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Name → (rows before, rows after)."""
    base, docs, out = tmp_path_factory.mktemp("stages"), table(spark, FOLDER, "documents"), {}
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        after = docs.collect()
        out[name] = (before, after)
        before = after
    return out


def test_quality_keeps_exactly_what_scores_enough(spark, stages):
    before, after = stages["quality"]
    model = quality.fit(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    measure = quality.measurer(model["dictionaries"])
    scores = quality.probabilities(np.array([measure(r.text.encode()) for r in before]), model)
    assert sorted(after) == sorted(r for r, s in zip(before, scores) if s >= 0.3)
    assert 0 < len(after) < len(before)


def test_exact_dedup_keeps_the_largest_id(stages):
    before, after = stages["exact_dedup"]
    best = {}
    for r in before:
        key = lower(r.text)
        if key not in best or r["doc_id"] > best[key]["doc_id"]:
            best[key] = r
    assert sorted(after) == sorted(best.values())


def test_near_dedup_keeps_the_smallest_id(stages):
    before, after = stages["near_dedup"]
    roots = slow_components({r["doc_id"]: slow_fingerprint(r.text) for r in before})
    assert sorted(after) == sorted(r for r in before if roots[r["doc_id"]] == r["doc_id"])


def test_near_copies_go(spark, docs_of):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(4000)]
    rows = [(i, " ".join(words[:i] + ["other"] + words[i + 1 :]), "a") for i in range(0, 40, 10)]
    rows += [(100 + i, " ".join(rng.choices(words, k=300)), "a") for i in range(20)]
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs_of(rows), FOLDER).collect()}
    assert kept == {0, *range(100, 120)}


def test_mixing_repeats_whole_rows(stages):
    before, after = stages["mixing"]
    copies = Counter(after)
    assert set(copies) <= set(before) and max(copies.values()) <= 2
    size, taken, least = Counter(), Counter(), defaultdict(lambda: 1 << 60)
    for r in before:
        n = len(r.text.encode().split())
        size[r.source] += n
        taken[r.source] += n * copies[r]
        least[r.source] = min(least[r.source], n or 1 << 60)
    for source, goal in slow_targets(size).items():
        assert abs(taken[source] - goal) <= 0.02 * goal + 0.51 * least[source]


def test_packing_places_every_document_and_copy(stages):
    before, after = stages["packing"]
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for r in before:
        n = len(model.encode(r.text, add_special_tokens=False).ids) + 1
        expected.update((r["doc_id"], k, min(4096, n - s)) for k, s in enumerate(range(0, n, 4096)))
    assert Counter((r["doc_id"], r.piece, r.length) for r in after) == expected
    # Either the bound says that fewer sequences cannot do, or the rows say that the last part is not certified.
    gap = check_packed(after, 4096) - packing.lower_bound(np.array([r.length for r in after]))
    assert gap == 0 or gap <= 1 and not all(r.certified for r in after)


def test_run_gives_the_rows_of_the_stages(spark, stages):
    rows = entry.queries()["pipeline"](spark, FOLDER).collect()
    plain = lambda rs: Counter((r["doc_id"], r.piece, r.start, r.length, r.ids_crc32) for r in rs)
    assert plain(rows) == plain(stages["packing"][1])
