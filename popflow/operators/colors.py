"""Colour-analysis page over the windowed colour table (``colored_pops``).

Counts here are *rows* of the windowed table (one row per player, colour
and window), as the page computes them; ``weight="pops"`` counts pops
instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.functions.expressions import display_ratio, title_case
from popflow.operators.ranking import top_k

METRICS = ("balloon_pops", "points_by_color", "bonus_hits")


def for_player(df: DataFrame, player: str | None) -> DataFrame:
    """Equality filter on ``player`` (pushed to the scan); ``None`` = all."""
    return df if player is None else df.where(F.col("player") == F.lit(player))


def _weight(weight: str):
    if weight == "rows":
        return F.count(F.lit(1))
    if weight == "pops":
        return F.sum("balloon_pops").cast("long")
    raise ValueError(f"weight must be 'rows' or 'pops', got {weight!r}")


def color_usage(cp: DataFrame, player: str | None = None, weight: str = "rows") -> DataFrame:
    """Heat-map cells: (player, colour) -> count."""
    return (for_player(cp, player).groupBy("player", "balloon_color")
            .agg(_weight(weight).alias("count")))


def favorite_color(cp: DataFrame, player: str | None = None, weight: str = "rows") -> DataFrame:
    """Each player's most used colour (ties: colour name ascending).

    ``min_by`` over (-count, colour) has a struct buffer, which Spark
    aggregates by sorting each side of its shuffle; its input is one row per
    player and colour, and a task hands on one row per player.
    """
    usage = color_usage(cp, player, weight)
    pick = F.min_by(F.struct("balloon_color", "count"),
                    F.struct((-F.col("count")).alias("n"), F.col("balloon_color")))
    return (usage.groupBy("player").agg(pick.alias("_f"))
            .select("player", "_f.balloon_color", "_f.count"))


def color_coverage(cp: DataFrame, player: str | None = None) -> DataFrame:
    """Distinct colours used by each player next to the distinct colours
    overall, and a ``"used/total"`` label.

    The overall count is an uncorrelated scalar subquery (one value computed
    once and inlined), not a join.
    """
    total = cp.select(F.count_distinct("balloon_color")).scalar()
    per = (for_player(cp, player).groupBy("player")
           .agg(F.count_distinct("balloon_color").alias("colors_used")))
    return (per.withColumn("total_colors", total)
            .withColumn("display", display_ratio("colors_used", "total_colors")))


def color_popularity(cp: DataFrame, weight: str = "rows") -> DataFrame:
    """Colour -> count over all players."""
    return cp.groupBy("balloon_color").agg(_weight(weight).alias("count"))


def least_popular_colors(cp: DataFrame, n: int = 3, weight: str = "rows") -> DataFrame:
    """Bottom ``n`` colours by count (ties: name), title-cased."""
    pop = top_k(color_popularity(cp, weight), n, [F.asc("count"), F.asc("balloon_color")])
    return pop.select(title_case("balloon_color").alias("balloon_color"), "count")


def most_popular_colors(cp: DataFrame, n: int = 3, weight: str = "rows") -> DataFrame:
    """Top ``n`` colours by count (ties: name), title-cased."""
    pop = top_k(color_popularity(cp, weight), n, [F.desc("count"), F.asc("balloon_color")])
    return pop.select(title_case("balloon_color").alias("balloon_color"), "count")


def metric_by_color(cp: DataFrame, player: str | None = None,
                    metrics=METRICS) -> DataFrame:
    """Sum of each metric per (player, colour), long form
    ``player, balloon_color, metric, total``."""
    for m in metrics:
        if m not in METRICS:
            raise ValueError(f"unknown metric {m!r}")
    sums = (for_player(cp, player).groupBy("player", "balloon_color")
            .agg(*[F.sum(m).cast("long").alias(m) for m in metrics]))
    return sums.unpivot(["player", "balloon_color"], list(metrics), "metric", "total")


def player_totals(cp: DataFrame, player: str | None = None) -> DataFrame:
    """Per player totals of pops, points and bonus hits."""
    return (for_player(cp, player).groupBy("player")
            .agg(*[F.sum(m).cast("long").alias(m) for m in METRICS]))


def metric_total(cp: DataFrame, metric: str, player: str | None = None) -> DataFrame:
    """Grand total of one metric (one row)."""
    return for_player(cp, player).agg(F.sum(metric).cast("long").alias("total"))


def players(cp: DataFrame) -> DataFrame:
    """Sorted distinct player names."""
    return cp.select("player").distinct().orderBy("player")
