"""Performance-trends page over ``color_performance_trends``.

By default the per-window average is truncated to an integer before any
statistic (the page loads it with an integer cast); ``truncate=False``
keeps the exact average.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.functions.expressions import round_half_even, truncate_int, ts_as

_UNIT_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}
# Bins generated per row before exploding (bounds every generated array).
BIN_CHUNK = 4096


def interval_micros(width: str) -> int:
    """``"15 seconds"`` -> 15_000_000 (fixed-length units only)."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", width.lower())
    if not m or m.group(2) not in _UNIT_US:
        raise ValueError(f"unsupported interval {width!r}")
    return int(m.group(1)) * _UNIT_US[m.group(2)]


def score_value(truncate: bool = True) -> Column:
    v = F.col("avg_score_per_pop")
    return truncate_int(v) if truncate else v.cast("double")


def performance_summary(cpt: DataFrame, truncate: bool = True) -> DataFrame:
    """Unweighted mean of the window averages, best window average, total pops."""
    v = score_value(truncate)
    return cpt.agg(F.avg(v).alias("mean_of_window_avgs"),
                   F.max(v).alias("best_window_avg"),
                   F.sum("total_pops").cast("long").alias("total_pops"))


def color_perf_stats(cpt: DataFrame, truncate: bool = True) -> DataFrame:
    """Per colour: mean/min/max/count of window averages and pops, rounded
    half-even to one decimal; highest average first (ties: colour name)."""
    v = score_value(truncate)
    return (cpt.groupBy("balloon_color")
            .agg(round_half_even(F.avg(v), 1).alias("average_score"),
                 F.min(v).alias("min_score"),
                 F.max(v).alias("max_score"),
                 F.count(v).alias("count"),
                 F.sum("total_pops").cast("long").alias("total_pops"))
            .orderBy(F.desc("average_score"), "balloon_color"))


def avg_by_color(cpt: DataFrame, truncate: bool = True) -> DataFrame:
    """Per colour: mean of window averages and the number of windows; highest
    average first (ties: colour name)."""
    v = score_value(truncate)
    return (cpt.groupBy("balloon_color").agg(F.avg(v).alias("avg_score"),
                                             F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("avg_score"), "balloon_color"))


def perf_distribution(cpt: DataFrame, truncate: bool = True, exact: bool = True,
                      accuracy: int = 10_000) -> DataFrame:
    """Box-plot five-number summary of the colour averages per window.

    A window holds at most one row per colour, so the exact percentile's
    per-group buffer is bounded by the number of colours; ``exact=False``
    uses the approximate sketch instead.
    """
    v = score_value(truncate)
    qs = [0.25, 0.5, 0.75]
    q = (F.percentile(v, F.array(*[F.lit(x) for x in qs])) if exact
         else F.percentile_approx(v.cast("double"), qs, accuracy))
    return (cpt.groupBy("window_start")
            .agg(F.min(v).alias("min"), q.alias("_q"), F.max(v).alias("max"))
            .select("window_start", "min",
                    F.col("_q")[0].cast("double").alias("q1"),
                    F.col("_q")[1].cast("double").alias("median"),
                    F.col("_q")[2].cast("double").alias("q3"),
                    "max"))


def _bin_index(ts: Column, epoch: Column, width_us: int) -> Column:
    return F.floor(F.timestamp_diff("MICROSECOND", epoch, ts) / F.lit(width_us)).cast("long")


def time_window_summary(cpt: DataFrame, freq: str = "15 seconds", truncate: bool = True,
                        bounds: DataFrame | None = None, start=None, end=None,
                        stretches: DataFrame | None = None) -> DataFrame:
    """Per ``freq`` bin of ``window_start``: mean/min/max/count of the window
    averages and total pops, **including empty bins** between the first and
    last bin (count and pops 0, statistics NULL).

    Plan: bins are generated from the global (min, max) in chunks of
    ``BIN_CHUNK`` (no single huge array), spread over tasks, and unioned with
    the data as zero-weight rows; one aggregation then yields filled and
    empty bins together (one shuffle, no join).

    ``bounds`` (one row: first and last ``window_start``, e.g.
    :func:`popflow.operators.views.window_bounds` of the events) spares a second
    evaluation of ``cpt`` for its minimum and maximum. ``start`` and ``end``
    (window starts, inclusive, UTC wall clock) restrict data and filled bins, so
    one stray timestamp cannot make the output unbounded. ``stretches`` (first,
    last bin; as :mod:`popflow.streaming.gaps` keeps them) names the empty bins
    instead: nothing is derived from the data's ends.
    """
    width_us = interval_micros(freq)
    # Zone-less epoch of the same type as window_start: bins stay aligned to
    # 1970-01-01 00:00 whatever the session time zone.
    ts_type = dict(cpt.dtypes)["window_start"]
    epoch = F.lit("1970-01-01 00:00:00").cast(ts_type)
    v = score_value(truncate)
    data = cpt.select(_bin_index(F.col("window_start"), epoch, width_us).alias("_b"),
                      v.alias("_v"), F.col("total_pops").cast("long").alias("_p"))
    limits = data.agg(F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
    if bounds is not None:
        first, last = bounds.columns
        limits = bounds.select(_bin_index(F.col(first), epoch, width_us).alias("_lo"),
                               _bin_index(F.col(last), epoch, width_us).alias("_hi"))
    if stretches is not None:
        limits = stretches.select(F.col("first").alias("_lo"), F.col("last").alias("_hi"))
    for value, pick, col in ((start, F.greatest, "_lo"), (end, F.least, "_hi")):
        if value is not None:
            edge = _bin_index(ts_as(value, ts_type), epoch, width_us)
            limits = limits.withColumn(col, pick(F.col(col), edge))
            data = data.where(F.col("_b") >= edge if col == "_lo" else F.col("_b") <= edge)
    limits = limits.where("_lo <= _hi")
    chunks = limits.select(
        "_lo", "_hi",
        F.explode(F.sequence(F.floor(F.col("_lo") / BIN_CHUNK).cast("long"),
                             F.floor(F.col("_hi") / BIN_CHUNK).cast("long"))).alias("_c"))
    empty = (chunks.repartition("_c")
             .select(F.explode(F.sequence(
                 F.greatest(F.col("_c") * BIN_CHUNK, F.col("_lo")),
                 F.least(F.col("_c") * BIN_CHUNK + (BIN_CHUNK - 1), F.col("_hi")))).alias("_b"),
                 F.lit(None).cast(data.schema["_v"].dataType).alias("_v"),
                 F.lit(0).cast("long").alias("_p")))
    both = data.unionByName(empty)
    return (both.groupBy("_b")
            .agg(round_half_even(F.avg("_v"), 1).alias("mean_score"),
                 F.min("_v").alias("min_score"),
                 F.max("_v").alias("max_score"),
                 F.count("_v").alias("n_colors"),
                 F.sum("_p").cast("long").alias("total_pops"))
            .select(F.timestamp_add("MICROSECOND", F.col("_b") * width_us, epoch)
                    .alias("window_start"),
                    "mean_score", "min_score", "max_score", "n_colors", "total_pops"))
