"""Weak supervision on planted toxic texts, and its label model against known voters."""

import random
import zlib

import numpy as np
import pytest

from tagwright.llm import toxicity
from tagwright.llm.toxicity import LabelModel, Voters


def planted(seed=4, n=900, labelled=0.6):
    """Clean and toxic texts; the toxic ones have built-in or invented words, never told to the operator."""
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(800)]
    bad = ["idiot", "scum", *["krum" + "".join(rng.choices("lmnop", k=3)) for _ in range(20)]]
    docs, labels, truth = [], [], {}
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(30, 120))
        truth[i] = int(rng.random() < 0.15)
        if truth[i]:
            for w in rng.choices(bad, k=rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), w.upper() if rng.random() < 0.2 else w + rng.choice(["", "!", ","]))
        docs.append((i, " ".join(words)))
        if rng.random() < labelled:
            labels.append((i, 1, truth[i]))
    return docs, labels, truth


def test_held_out_texts_are_told_apart(spark):
    docs, labels, truth = planted()
    rows = toxicity.classify(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    ).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    for held in (True, False):
        caught = [r.predicted for r in rows if truth[r.doc_id] and r.held_out == held]
        wrong = [r.predicted for r in rows if not truth[r.doc_id] and r.held_out == held]
        assert np.mean(caught) >= 0.9 and np.mean(wrong) <= 0.01


def test_nothing_is_learnt_from_held_out_labels(spark):
    docs, labels, _ = planted(n=300)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    score = lambda ls: {
        r.doc_id: round(r.score, 6)
        for r in toxicity.classify(frame, spark.createDataFrame(ls, "doc_id long, quality int, toxic int")).collect()
    }
    assert score(labels) == score(turned)


def test_learnt_terms_cover_what_words_share():
    found = toxicity.terms({"krumlop", "krumnom", "other"})
    assert {"=krumlop", "1^krum", "2^krum", "1^krumn", "=other"} <= found and "3^krum" not in found and "2^krumn" not in found


def test_votes_read_whole_texts():
    voters = Voters(["idiot"], ["2^krum", "=zap"])
    on = lambda text: {n for k, n in enumerate(voters.names) if voters(text)[0] >> k & 1}
    assert on("x " * 100_000 + "IDIOT###") == {"=idiot", "signs"}
    assert on("krumabc only krumabc") == set()
    assert on("krumabc and krumxyz, zap") == {"2^krum", "=zap", "two hits", "three hits", "close hits"}
    assert on("") == on("nothing idiots") == set()
    assert on("go to hell") == {"attack"} and on("SOME VERY LOUD WORDS HERE") == {"shouting"}


def brute_posterior(model, votes):
    joint = []
    for y in (0, 1):
        p = model.prior if y else 1 - model.prior
        for j, v in enumerate(votes):
            above = votes[model.parent[j]] if model.parent[j] >= 0 else 0
            q = model.p[y, above, j]
            p *= q if v else 1 - q
        joint.append(p)
    return joint[1] / sum(joint)


def test_label_model_finds_accuracies_and_correlations():
    """Three voters, of which the third repeats the second: the tree sees that and does not count it twice."""
    rng = np.random.default_rng(3)
    y = rng.random(20_000) < 0.2
    a = np.where(y, rng.random(len(y)) < 0.7, rng.random(len(y)) < 0.02)
    b = np.where(y, rng.random(len(y)) < 0.6, rng.random(len(y)) < 0.1)
    c = np.where(rng.random(len(y)) < 0.97, b, ~b)
    votes = np.stack([a, b, c], 1).astype(float)
    s = np.stack([(votes * w[:, None]).T @ votes for w in (~y, y)])
    n = np.array([(~y).sum(), y.sum()], float)
    parent = toxicity._tree(n, s)
    assert {frozenset((j, int(p))) for j, p in enumerate(parent) if p >= 0} == {frozenset((1, 2))}
    model = toxicity._model(n, s, parent)
    assert model.p[1, 0, 0] == pytest.approx(0.7, abs=0.03) and model.prior == pytest.approx(0.2, abs=0.02)
    every = np.array([[i >> k & 1 for k in range(3)] for i in range(8)])
    assert model.posterior(every.astype(float)) == pytest.approx([brute_posterior(model, v) for v in every])
    naive = LabelModel(model.prior, np.full(3, -1), toxicity._model(n, s, np.full(3, -1)).p)
    both = np.array([[0.0, 1, 1]])
    assert naive.posterior(both)[0] > model.posterior(both)[0]


def test_odd_empty_and_unlabelled_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (99, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.filter("toxic = 1")):
        rows = toxicity.classify(odd, known).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd.select("doc_id").collect())
        assert toxicity.classify(odd.limit(0), known).collect() == []
    assert len({r.score for r in rows if r.doc_id in (3, 4, 7)}) == 1
    insults = spark.createDataFrame([(1, "you are an idiot and a moron"), (2, "a fine day")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.classify(insults, labels.limit(0)).collect()}
    assert score[1] > score[2]
