"""The classifiers: risk, held-out accuracy, folds and odd rows."""

import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from popflow.llm import nnpu, pu_sample, quality, toxicity
from popflow.llm.pu_sample import training_sample


def held(i, mod, rest):
    return zlib.crc32(("" if i is None else str(i)).encode()) % mod == rest


def label_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_fit_lowers_the_risk_and_finds_the_hidden_positives():
    rng = np.random.default_rng(1)
    make = lambda n, pos: [([0] if pos and rng.random() < 0.9 else []) + list(1 + np.flatnonzero(rng.random(20) < 0.3)) for _ in range(n)]
    xp, xu = nnpu.Rows(make(300, True), 21), nnpu.Rows(make(200, True) + make(1800, False), 21)
    model = nnpu.calibrated(nnpu.fit(xp, xu, 0.1), xp, xu, 0.1, 0.5)
    zp, zu = xp.dot(model.weights) + model.bias, xu.dot(model.weights) + model.bias
    assert nnpu.risk(zp, zu, 0.1) < nnpu.risk(np.zeros(300), np.zeros(2000), 0.1)
    assert 0 < nnpu.risk(zp, zu, 0.1)
    assert (zu[:200] > 0).mean() > 0.8 and (zu[200:] > 0).mean() < 0.02


def test_gradient_is_that_of_the_risk():
    x = nnpu.Rows([[0, 2], [], [1]], 3)
    w = np.array([1.0, -2.0, 0.5])
    assert x.dot(w).tolist() == [1.5, 0.0, -2.0] and x.back(np.array([1.0, 5.0, 2.0])).tolist() == [1.0, 2.0, 1.0]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(300)]
    bad = ["scum", "vermin", "filthy", "filthier"]
    docs, labels = [], []
    for i in range(700):
        words = rng.choices(vocab, k=rng.randint(15, 80))
        toxic, good = int(i % 6 == 0), int(i % 7 != 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        text = " ".join(words).capitalize() + "."
        if not good:
            text = " ".join(w.upper() + "!!" for w in words) if i % 2 else " ".join(w + "###" for w in words)
        docs.append((i, text))
        labels.append((i, good, toxic))
    odd = [(900, None), (901, ""), (902, " \n\t "), (None, "a text without an id"), (3, docs[3][1]), (3, "another text"),
           (903, "word " * 100_000), (904, "!!! ??? 123")]
    return docs, odd, labels


@pytest.mark.parametrize("name,score,mod,rest,cut", [
    ("toxic", toxicity.score_toxicity, 5, 0, 0.5), ("quality", quality.score_quality, 4, 2, 0.7)])
def test_held_out_accuracy_and_odd_rows(spark, make_docs, corpus, name, score, mod, rest, cut):
    docs, odd, labels = corpus
    extra = [(3, None, None), (None, 1, 1), (5, 0, 0), (5, *labels[5][1:]), (99_999, 1, 1)]
    frame = make_docs(docs + odd, score=1, positive=True, label="clash")
    got = score(frame, label_table(spark, labels + extra)).collect()
    assert [c for c in got[0].__fields__] == ["doc_id", "held_out", "score", "predicted"]
    assert len(got) == len(docs) + len(odd)
    truth = {i: (t if name == "toxic" else q) for i, q, t in labels}
    assert all(r.held_out == held(r.doc_id, mod, rest) and 0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in got)
    out = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth and r.doc_id != 3]
    assert sum(a == b for a, b in out) / len(out) > 0.97 and len(out) > 100
    empties = {r.score for r in got if r.doc_id in (900, 901, 902)}
    assert len(empties) == 1
    same = [r.score for r in got if r.doc_id == 3]
    assert len(same) == 3 and len(set(same)) <= 2


def test_labels_of_the_held_out_fold_are_not_used(spark, make_docs, corpus):
    docs, _, labels = corpus
    flipped = [(i, 1 - q if held(i, 4, 2) else q, 1 - t if held(i, 5, 0) else t) for i, q, t in labels]
    frame = make_docs(docs)
    for score in (toxicity.score_toxicity, quality.score_quality):
        a, b = ({r.doc_id: r.score for r in score(frame, label_table(spark, x)).collect()} for x in (labels, flipped))
        assert a == b


@pytest.mark.parametrize("share", [0.05, 0.2, 0.6])
def test_prior_of_planted_shares(share):
    """From positives and unlabelled rows only; the classes overlap in some words."""
    rng = np.random.default_rng(7)

    def rows(n, positive):
        common = rng.random((n, 30)) < 0.3
        own = rng.random((n, 6)) < (0.5 if positive else 0.02)
        return [np.flatnonzero(r).tolist() for r in np.concatenate([common, own], axis=1)]

    hidden = int(4000 * share)
    xp, xu = nnpu.Rows(rows(1500, True), 36), nnpu.Rows(rows(hidden, True) + rows(4000 - hidden, False), 36)
    half_p, half_u = np.arange(1500) % 2 == 0, np.arange(4000) % 2 == 0
    assert abs(nnpu.class_prior(xp, xu, half_p, half_u, l2=3e-3) - share) < 0.03


def test_prior_without_positives_among_the_unlabelled_and_without_difference():
    rng = np.random.default_rng(3)
    make = lambda n, low: nnpu.Rows([[low + int(k) for k in rng.integers(0, 5, 3)] for _ in range(n)], 10)
    halves = np.arange(400) % 2 == 0
    assert nnpu.class_prior(make(400, 0), make(400, 5), halves, halves, l2=3e-3) < 0.01
    assert nnpu.class_prior(make(400, 0), make(400, 0), halves, halves, l2=3e-3) > 0.9
    assert nnpu.class_prior(make(1, 0), make(1, 5), np.array([True]), np.array([True]), l2=3e-3) == 1.0


def test_only_positive_labels_are_read(spark, make_docs, corpus):
    """Without any negative label the scores are the same, and the clean documents stay."""
    docs, _, labels = corpus
    frame = make_docs(docs)
    positives = [(i, q or None, t or None) for i, q, t in labels]
    for score in (toxicity.score_toxicity, quality.score_quality):
        a, b = ({r.doc_id: r.score for r in score(frame, label_table(spark, x)).collect()} for x in (labels, positives))
        assert a == b
    kept = {r.doc_id for r in toxicity.reject_toxic(frame, label_table(spark, positives)).collect()}
    toxic = {i for i, _, t in labels if t}
    clean = {i for i, _ in docs} - toxic
    assert len(kept & clean) > 0.97 * len(clean) and len(kept & toxic) < 0.05 * len(toxic)


def test_sample_is_bounded_by_the_smallest_hashes(spark, make_docs, monkeypatch):
    docs = make_docs([(i, f"text {i}") for i in range(3_000)])
    table = label_table(spark, [(i, 1, i % 2) for i in range(3_000)])
    whole = training_sample(docs, table, "toxic", 5, 0).select("doc_id", "positive").collect()
    monkeypatch.setattr(pu_sample, "MAX_POSITIVES", 100)
    monkeypatch.setattr(pu_sample, "MAX_UNLABELLED", 200)
    some = training_sample(docs, table, "toxic", 5, 0).select("doc_id", "positive").collect()
    assert sum(r.positive for r in some) == 100 and len(some) == 300
    hashes = {r.doc_id: r.o for r in docs.select("doc_id", F.xxhash64(F.lit(17), "doc_id").alias("o")).collect()}
    for kind, n in ((True, 100), (False, 200)):
        want = sorted((hashes[r.doc_id], r.doc_id) for r in whole if r.positive == kind)[:n]
        assert sorted((hashes[r.doc_id], r.doc_id) for r in some if r.positive == kind) == want


def test_empty_tables_and_missing_classes(spark, make_docs):
    docs = make_docs([(1, "a b c"), (2, None), (3, "d e")])
    for score in (toxicity.score_toxicity, quality.score_quality):
        assert score(make_docs([]), label_table(spark, [(1, 1, 1)])).collect() == []
        assert all(r.score < 1e-9 and r.predicted == 0 for r in score(docs, label_table(spark, [])).collect())
    # nothing tells unlabelled texts from positives: no word for the one, all alike for the other
    every = label_table(spark, [(i, 1, 1) for i in range(9)])
    assert all(r.score < 1e-9 for r in toxicity.score_toxicity(docs, every).collect())
    assert all(r.score > 0.99 for r in quality.score_quality(docs, every).collect())
    kept = toxicity.reject_toxic(docs, label_table(spark, []))
    assert kept.columns == docs.columns and kept.count() == 3
