"""The hash-prefix forest: exact scores, recall against brute force, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from popflow.llm import hash_forest
from popflow.llm.hash_forest import BITS, TREES, Forest, nearest_neighbours, strings
from popflow.llm.queries import op13_neighbours
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k, queries):
    """{query: [(vec_id, score)]} of usable rows {id: vector}."""
    out = {}
    for q in queries:
        scores = [(-float((rows[q] * v).sum()), i) for i, v in rows.items() if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_query_recall_and_scores(spark):
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()}
    got = result(op13_neighbours(spark, SF01))
    want = brute(rows, 20, [i for i in rows if i % 20 == 0])
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, found in got.items():
        assert all(math.isclose(s, float((rows[q] * rows[i]).sum()), rel_tol=1e-12, abs_tol=1e-15) for i, s in found)
        assert found == sorted(found, key=lambda p: (-p[1], p[0])) and q not in dict(found)


def test_clusters_over_many_shards_and_norms(spark, monkeypatch):
    """Near copies, norms from 0.1 to 10, several shards and blocks: recall holds for inner products."""
    monkeypatch.setattr(hash_forest, "LEAST_SHARD", 200)
    monkeypatch.setattr(hash_forest, "SHARD_VALUES", 200)
    monkeypatch.setattr(hash_forest, "QUERY_BLOCK", 20)
    monkeypatch.setattr(hash_forest, "BLOCKS_A_TASK", 2)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((40, 16))[rng.integers(0, 40, 1500)] + 0.2 * rng.standard_normal((1500, 16))
    x *= 10 ** rng.uniform(-1, 1, (1500, 1))
    x[:500] = x[0] + 1e-3 * rng.standard_normal((500, 16))  # a third of all rows alike
    rows = dict(enumerate(x))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in rows.items()], SCHEMA).repartition(3)
    got = result(nearest_neighbours(df, F.col("vec_id") % 10 == 0, k=10))
    want = brute(rows, 10, range(0, 1500, 10))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_odd_rows_have_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []),
            (6, [nan, 1.0]), (7, [1.0, inf]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [2.0]), (20, [-1.0, 0.0]),
            (20, [0.5, 0.5]), (40, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).withColumns(
        {"shard": F.lit("x"), "block": F.lit(2.5), "score": F.lit(None).cast("string"), "rank": F.lit(1)})
    got = result(nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=20))
    assert got == {0: [(9, 2.0), (1, 1.0), (2, 1.0), (20, 0.5)], 20: [(9, 1.0), (0, 0.5), (1, 0.5), (2, 0.5)]}
    assert nearest_neighbours(df, F.col("vec_id") == 77).count() == 0
    empty = nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0
    one = nearest_neighbours(df.where("vec_id = 9"), F.col("vec_id") == 9)
    assert one.count() == 0  # a query without any candidate


@pytest.fixture
def forest():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 12))
    bits = strings(x, np.zeros(300))
    places = np.argsort(bits, axis=1, kind="stable")
    return bits, Forest({"ids": np.arange(300).tobytes(), "vectors": x.tobytes(),
                         "strings": np.take_along_axis(bits, places, 1).tobytes(),
                         "places": places.astype(np.int32).tobytes()}, 12)


def shared(a, b):
    return BITS - int(a ^ b).bit_length()


def test_descent_and_ascent_equal_a_comparison_of_all_strings(forest):
    bits, trees = forest
    rng = np.random.default_rng(9)
    asked = strings(rng.standard_normal((5, 12)), np.zeros(5))
    common = np.array([[[shared(int(asked[t, i]), int(bits[t, r])) for r in range(300)] for t in range(TREES)] for i in range(5)])
    assert trees.longest(asked).tolist() == common.max(axis=(1, 2)).tolist()
    found = dict(trees.candidates(asked, 60))
    for i in range(5):
        length = max(n for n in range(BITS + 1) if (common[i] >= n).sum() >= 60 or n == 0)
        assert found[i].tolist() == np.flatnonzero((common[i] >= length).any(axis=0)).tolist()
        # asked for as many entries as a row's effort says, the ascent meets that row
        for row in (0, 7, 150):
            effort = int(trees.effort(asked[:, i:i + 1], np.array([row]))[0])
            assert row in dict(trees.candidates(asked[:, i:i + 1], effort))[0]
