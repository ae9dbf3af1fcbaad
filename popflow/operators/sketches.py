"""Mergeable sketches: quantiles and distinct counts that roll up without a re-read.

A sketch per window (or per micro-batch) is a few hundred bytes in a table. Hours,
days and whole histories come from merging the stored sketches, never from the
windows' rows: KLL for quantiles, HyperLogLog for distinct counts.

KLL is exact up to ``k`` values and beyond that within a rank error of about
2.3 / k**0.9 on one side (k = 200: under 2 %). HyperLogLog counts exactly while a
sketch holds few values (thousands at ``lg`` = 12), then within about
1.04 / sqrt(2**lg) (under 2 %).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.functions.expressions import display_ratio
from popflow.operators.performance import score_value

KLL_K = 200
HLL_LG = 12
#: Box-plot quantiles and their names.
QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))


def value_sketches(df: DataFrame, value: Column, *keys, k: int = KLL_K) -> DataFrame:
    """Per key: ``sketch`` of a whole-numbered value, its exact ends and count.

    NULL values are not counted; a key without any value has a NULL sketch.
    """
    v = value.cast("bigint")
    kept = F.count(v)
    return df.groupBy(*keys).agg(
        F.when(kept > 0, F.kll_sketch_agg_bigint(v, k)).alias("sketch"), F.min(v).alias("min"),
        F.max(v).alias("max"), kept.alias("count"))


def merge_values(sketches: DataFrame, *keys) -> DataFrame:
    """The same columns per coarser keys."""
    found = sketches.where("sketch is not null")
    return found.groupBy(*keys).agg(
        F.kll_merge_agg_bigint("sketch").alias("sketch"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum("count").alias("count"))


def box_plot(sketches: DataFrame, *keys) -> DataFrame:
    """keys, min, q1, median, q3, max, count; each quantile is a value that occurs."""
    return sketches.select(*keys, "min", *[
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(name) for name, q in QUARTILES], "max", "count")


def perf_sketches(cpt: DataFrame, truncate: bool = True, k: int = KLL_K) -> DataFrame:
    """Per window: a sketch of its colour averages (the box plot's values)."""
    return value_sketches(cpt, score_value(truncate), "window_start", k=k)


def color_sketches(events: DataFrame, *keys, lg: int = HLL_LG) -> DataFrame:
    """Per key: a sketch of the distinct colours."""
    return events.groupBy(*keys).agg(F.hll_sketch_agg("balloon_color", lg).alias("colors"))


def coverage(sketches: DataFrame, lg: int = HLL_LG) -> DataFrame:
    """player, colors_used, total_colors, display: stored sketches united per player and over all.

    The overall count is an uncorrelated scalar subquery, not a join.
    """
    per = sketches.groupBy("player").agg(F.hll_union_agg("colors").alias("colors"))
    total = sketches.agg(F.hll_union_agg("colors").alias("u")).select(F.hll_sketch_estimate("u")).scalar()
    return (per.select("player", F.hll_sketch_estimate("colors").alias("colors_used"))
            .withColumn("total_colors", total).withColumn("display", display_ratio("colors_used", "total_colors")))
