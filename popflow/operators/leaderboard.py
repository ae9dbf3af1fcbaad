"""Leaderboard page: scoreboard, top-k, player and time filters, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.functions.expressions import (
    compose_datetime,
    time_label,
    time_of_day,
    ts_as,
    to_utc,
    utc_hour,
    utc_instant,
)
from popflow.operators.ranking import global_rank, latest_by_key, top_k

LEADERBOARD_ORDER = (("total_score", "desc"), ("bonus_hits", "desc"), ("player", "asc"))


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise ``ValueError`` when ``df`` is empty (a one-row probe job)."""
    if df.isEmpty():
        raise ValueError(f"No data available for {what}")
    return df


def current_leaderboard(lb: DataFrame) -> DataFrame:
    """Latest row per player of a leaderboard changelog.

    Order: event time, then total score (scores never decrease, so the larger
    total is the later update when event times tie), then ``batch_id``. A view
    or current-state read (no ``batch_id``) already has one row per player and
    is returned as it is.
    """
    if "batch_id" not in lb.columns:
        return lb
    return latest_by_key(lb, ["player"], ["event_ts", "total_score", "batch_id"])


def scoreboard(lb: DataFrame, values: Sequence[str] = ("total_score", "bonus_hits")) -> DataFrame:
    """Per player totals of ``values`` from the latest leaderboard state.

    Only the columns needed are carried into the latest-row pick: the
    optimizer cannot prune fields inside the picked struct, so an unused
    column there would still be computed (for a view, down to its source).
    """
    keep = ["player", "event_ts", "total_score", *values,
            *(["batch_id"] if "batch_id" in lb.columns else [])]
    cur = current_leaderboard(lb.select(*dict.fromkeys(keep)))
    return cur.groupBy("player").agg(*[F.sum(v).cast("long").alias(v) for v in values])


def scoreboard_top(lb: DataFrame, k: int = 5,
                   values: Sequence[str] = ("total_score", "bonus_hits")) -> DataFrame:
    """Top ``k`` of the scoreboard by total score (ties: player name)."""
    return top_k(scoreboard(lb, values), k, [F.desc("total_score"), F.asc("player")])


def leaderboard_sorted(lb: DataFrame) -> DataFrame:
    """Whole leaderboard with its 1-based position by (score, bonus) desc."""
    base = lb.select("player", "total_score", "bonus_hits")
    return global_rank(base, LEADERBOARD_ORDER, "position")


def for_players(df: DataFrame, players) -> DataFrame:
    """Keep rows of the given players.

    ``players`` is a Python list (an ``IN`` filter, pushed to the scan) or a
    one-column DataFrame of player names (left-semi join). No broadcast hint:
    the planner broadcasts the names only when their size estimate is under
    ``spark.sql.autoBroadcastJoinThreshold``. A top-k list carries a proven
    bound (its limit: k rows), so it is broadcast and the semi join is
    pushed below the aggregation; a player table of unknown size gets a
    shuffle join, or a broadcast chosen by AQE from its runtime size.
    """
    if isinstance(players, DataFrame):
        keys = players.select(F.col(players.columns[0]).alias("_p"))
        return df.join(keys, df["player"] == F.col("_p"), "left_semi")
    return df.where(F.col("player").isin(list(players)))


def _ts_type(df: DataFrame, col: str) -> str:
    return dict(df.dtypes)[col]


def hour_bounds(start, end):
    """First and last UTC hour (hours since 1970) that the bounds touch."""
    return utc_hour(ts_as(start, "timestamp")), utc_hour(ts_as(end, "timestamp"))


def in_time_range(df: DataFrame, start, end, col: str = "window_start",
                  hour_col: str | None = None) -> DataFrame:
    """Rows with ``start <= col <= end`` (both inclusive; bounds read as UTC
    wall clock whatever the session time zone).

    ``hour_col`` names a derived hour partition column of a stored table; the
    matching bound on it lets the scan prune partitions.
    """
    t = _ts_type(df, col)
    cond = F.col(col).between(ts_as(start, t), ts_as(end, t))
    if hour_col and hour_col in df.columns:
        lo, hi = hour_bounds(start, end)
        cond = cond & F.col(hour_col).between(lo, hi)
    return df.where(cond)


def in_date_time_range(df: DataFrame, start_date, start_time, end_date, end_time,
                       col: str = "window_start", tz: str = "UTC") -> DataFrame:
    """As :func:`in_time_range`, with bounds given as separate date and time
    of day, as a clock in ``tz`` shows them."""
    lo = to_utc(compose_datetime(F.lit(str(start_date)), F.lit(str(start_time))), tz)
    hi = to_utc(compose_datetime(F.lit(str(end_date)), F.lit(str(end_time))), tz)
    if _ts_type(df, col) == "timestamp":
        lo, hi = utc_instant(lo), utc_instant(hi)
    return df.where(F.col(col).between(lo, hi))


def since(df: DataFrame, interval: str, now=None, col: str = "window_start") -> DataFrame:
    """Rows with ``col > now - interval``; ``now`` defaults to the current
    time and may be a literal (UTC wall clock) or a scalar Column (e.g. a
    subquery)."""
    now_col = ts_as(now, _ts_type(df, col))
    return df.where(F.col(col) > now_col - F.expr(f"INTERVAL {interval}"))


def score_trend(rs: DataFrame, players=None, start=None, end=None,
                unit: str = "minutes") -> DataFrame:
    """Score series per (window_start, player): the max total score, with a
    time label formatted for the display unit."""
    df = rs
    if start is not None and end is not None:
        df = in_time_range(df, start, end)
    if players is not None:
        df = for_players(df, players)
    return (df.groupBy("window_start", "player")
            .agg(F.max("total_score").alias("total_score"))
            .withColumn("time_label", time_label("window_start", unit)))


def time_bounds(rs: DataFrame, lb: DataFrame) -> DataFrame:
    """Default bounds for the time pickers: min/max window start, their dates
    and times of day (one global aggregate), and the scale's end: the largest
    total of the latest leaderboard state (a scalar subquery)."""
    agg = rs.agg(F.min("window_start").alias("min_time"),
                 F.max("window_start").alias("max_time"))
    agg = agg.withColumn("max_score", max_total_score(lb).scalar())
    return agg.select(
        "min_time", "max_time",
        F.to_date("min_time").alias("min_date"),
        F.to_date("max_time").alias("max_date"),
        time_of_day("min_time").alias("min_clock"),
        time_of_day("max_time").alias("max_clock"),
        "max_score")


def max_total_score(lb: DataFrame) -> DataFrame:
    """Largest scoreboard total (one row)."""
    return scoreboard(lb, ("total_score",)).select(F.max("total_score").alias("max_score"))


def top_players(lb: DataFrame, k: int = 5) -> DataFrame:
    """Names of the top ``k`` scoreboard players (a bounded k-row frame)."""
    return scoreboard_top(lb, k, ("total_score",)).select("player")


def scores_for_top_players(rs: DataFrame, lb: DataFrame, k: int = 5) -> DataFrame:
    """Windowed scores of the top ``k`` players."""
    return for_players(rs, top_players(lb, k))

