"""Reconciliation by digests: equal to the full outer join, and no join of what is equal."""

import pytest
from pyspark.sql import functions as F

from popflow.operators import quality, views
from popflow.sources.events import game_events
from tests.conftest import SF001


def explain(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def stats(spark):
    return views.color_stats(game_events(spark, SF001)).persist()


KEYS, VALUES = ["player", "balloon_color"], ["balloon_pops", "points_by_color", "bonus_hits", "event_ts"]


def test_equal_tables_are_never_joined(spark, stats):
    got = quality.reconcile_by_digest(stats, stats.repartition(3).orderBy(F.rand(1)), KEYS, VALUES)
    assert tuple(got.first()) == (stats.count(), stats.count(), 0, 0, 0) and "Join" not in explain(got)
    empty = quality.reconcile_by_digest(stats.limit(0), stats.limit(0), KEYS, VALUES)
    assert tuple(empty.first()) == (0, 0, 0, 0, 0)


def test_planted_differences_are_found_and_little_is_joined(spark, stats):
    first, second, third = stats.orderBy(*KEYS).limit(3).collect()
    at = lambda r: (F.col("player") == r.player) & (F.col("balloon_color") == r.balloon_color)
    other = stats.where(~at(first)).withColumn("bonus_hits", F.when(at(second), F.lit(None)).otherwise(F.col("bonus_hits")))
    other = other.unionByName(stats.where(at(third)).withColumn("player", F.lit(None).cast("string")))
    by_join = quality.reconcile(stats, other, KEYS, VALUES).first()
    got = quality.reconcile_by_digest(stats, other, KEYS, VALUES)
    assert tuple(got.first()) == tuple(by_join) == (stats.count(), stats.count(), 1, 1, 1)
    for buckets in (1, 7):
        assert tuple(quality.reconcile_by_digest(stats, other, KEYS, VALUES, buckets).first()) == tuple(by_join)


def test_digest_tells_nulls_from_values_and_ignores_order(spark):
    rows = [(1, None, 2), (2, 2, None), (3, 5, 5)]
    a = spark.createDataFrame(rows, "k int, x int, y int")
    swapped = spark.createDataFrame([(1, 2, None), (2, None, 2), (3, 5, 5)], "k int, x int, y int")
    traded = spark.createDataFrame([(1, None, 2), (2, 5, 5), (3, 2, None)], "k int, x int, y int")
    for other, wrong in ((a.orderBy(F.desc("k")), 0), (swapped, 2), (traded, 2)):
        assert quality.reconcile_by_digest(a, other, ["k"], ["x", "y"]).first().mismatched_rows == wrong
