"""Every operator on odd and on empty tables."""

import public_tokenizers
import pytest

import corpus_pipeline
from tagwright.llm import exact, merkle, mixing, packing, pii, quality, sharding, simhash, suffix, tokens

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, None, 0), (4, 0, None), (5, 1, 0), (6, 0, 1), (None, 1, 0), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def per_row(labels):
    return {
        "simhash": simhash.near_groups,
        "mixing": mixing.mix,
        "exact": exact.exact_groups,
        "suffix": suffix.remove_repeats,
        "tokens": lambda d: tokens.count_tokens(d, PIECES),
        "quality": lambda d: quality.classify(d, labels),
        "merkle": merkle.fingerprint_edits,
        "sharding": sharding.shard,
        "pii": pii.find,
    }


NAMES = list(per_row(None))


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each(odd, labels, name):
    rows = per_row(labels)[name](odd).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(odd, labels, name):
    assert per_row(labels)[name](odd.limit(0)).collect() == []


def test_defined_results(odd, labels):
    by = {}
    for r in exact.exact_groups(odd).collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert [(r.keep_id, r.group_size, r.kept) for r in by[1]] == [(2, 3, False)] * 2
    assert [(r.keep_id, r.group_size, r.kept) for r in by[3] + by[4]] == [(4, 3, False), (4, 3, True)]
    assert {(r.keep_id, r.kept) for r in by[None]} == {(None, True), (4, False)}
    groups = {}
    for r in simhash.near_groups(odd).collect():
        groups.setdefault(r["doc_id"], set()).add((r.fingerprint, r.component_id))
    assert groups[3] == groups[4] == groups[7] == {("0" * 16, 3)}
    assert {c for _, c in groups[5] | groups[6]} == {5}
    mixed = {r["doc_id"]: r for r in mixing.mix(odd).collect()}
    assert (mixed[3].size, mixed[3].taken, mixed[8].size) == (0, 0, 1)
    spans = {r["doc_id"]: r for r in suffix.remove_repeats(odd).collect()}
    assert spans[5].n_removed == spans[5].n_bytes == spans[6].n_removed
    assert spans[3].n_bytes == spans[4].n_bytes == 0
    counts = {r["doc_id"]: r for r in tokens.count_tokens(odd, PIECES).collect()}
    assert counts[3].n_tokens == counts[4].n_tokens == counts[7].n_tokens == 0
    shards = {r["doc_id"]: r for r in sharding.shard(odd).collect()}
    assert shards[3]["size"] == shards[4]["size"] == 16 and shards[4].text_crc32 == 0


def test_packing_has_pieces_for_each_row(odd):
    rows = packing.pack(odd, WORDS).collect()
    assert sum(r.piece == 0 for r in rows) == odd.count()
    assert {r.length for r in rows if r["doc_id"] in (3, 4, 7)} == {1}
    assert packing.pack(odd.limit(0), WORDS).collect() == []


def test_operators_that_return_documents(odd, labels):
    for build in (
        lambda d: quality.accepted(d, labels),
        exact.deduplicated,
        simhash.first_of_groups,
        mixing.repeated,
    ):
        assert build(odd).columns == odd.columns
        assert build(odd.limit(0)).collect() == []
    assert exact.deduplicated(odd).count() == 9
    texts = [r["text"] for r in simhash.first_of_groups(odd.filter("doc_id IS NOT NULL")).collect()]
    assert sum(t is None or not t.strip() for t in texts) == 1


def test_labels_of_one_kind_or_none(odd, labels):
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.classify(odd, labels.filter("quality = 1")).collect()} == {1.0}


def test_stages_of_the_pipeline(spark, tmp_path, odd, labels):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, str(tmp_path))
        after.write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        assert i == 4 or after.columns == docs.columns
        docs = after
    assert "sequence_id" in docs.columns
