"""The five continuously maintained aggregates.

Each function takes any DataFrame with the event columns (``player``,
``balloon_color``, ``score``, ``favorite_color_bonus``, ``event_ts``) and
returns the aggregate. The same function serves a batch table and a
streaming DataFrame: on a stream it becomes a stateful aggregation that is
run in update mode (no watermark, so late events always correct their
window), or with ``watermark=`` to bound state.

Physical shape: ``HashAggregate(partial) -> Exchange(keys) ->
HashAggregate(final)``; the map-side partial aggregate collapses a hot
player or colour to one row per task before the shuffle, so a key holding a
third of all events does not land in one reducer. Tumbling windows compile
to a projection (no Expand).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.config import DEFAULT_WINDOW
from popflow.functions.expressions import count_true


def _with_watermark(df: DataFrame, watermark: str | None) -> DataFrame:
    return df.withWatermark("event_ts", watermark) if watermark else df


def _window_cols():
    return [F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end")]


def leaderboard(events: DataFrame) -> DataFrame:
    """Per player: total score, bonus hits, latest event time."""
    return events.groupBy("player").agg(
        F.sum("score").alias("total_score"),
        count_true("favorite_color_bonus").alias("bonus_hits"),
        F.max("event_ts").alias("event_ts"),
    )


def color_stats(events: DataFrame) -> DataFrame:
    """Per player and colour: pops, points, bonus hits, latest event time."""
    return events.groupBy("player", "balloon_color").agg(
        F.count(F.lit(1)).alias("balloon_pops"),
        F.sum("score").alias("points_by_color"),
        count_true("favorite_color_bonus").alias("bonus_hits"),
        F.max("event_ts").alias("event_ts"),
    )


def realtime_scores(events: DataFrame, width: str = DEFAULT_WINDOW,
                    watermark: str | None = None) -> DataFrame:
    """Per player and tumbling window: total score."""
    return (_with_watermark(events, watermark)
            .groupBy("player", F.window("event_ts", width))
            .agg(F.sum("score").alias("total_score"))
            .select("player", "total_score", *_window_cols()))


def colored_pops(events: DataFrame, width: str = DEFAULT_WINDOW,
                 watermark: str | None = None) -> DataFrame:
    """Per player, colour and tumbling window: pops, points, bonus hits."""
    return (_with_watermark(events, watermark)
            .groupBy("player", "balloon_color", F.window("event_ts", width))
            .agg(F.count(F.lit(1)).alias("balloon_pops"),
                 F.sum("score").alias("points_by_color"),
                 count_true("favorite_color_bonus").alias("bonus_hits"))
            .select("player", "balloon_color", "balloon_pops", "points_by_color",
                    "bonus_hits", *_window_cols()))


def color_performance(events: DataFrame, width: str = DEFAULT_WINDOW,
                      watermark: str | None = None) -> DataFrame:
    """Per colour and tumbling window: average score per pop and pop count.

    The average is DOUBLE here; :func:`to_table_types` casts it to the
    table's ``decimal(28,10)`` at the storage boundary.
    """
    return (_with_watermark(events, watermark)
            .groupBy("balloon_color", F.window("event_ts", width))
            .agg(F.avg("score").alias("avg_score_per_pop"),
                 F.count(F.lit(1)).alias("total_pops"))
            .select("balloon_color", "avg_score_per_pop", "total_pops", *_window_cols()))


#: Keys of the fanned-out aggregate; a view without one of them leaves it null.
FAN_KEYS = ("view", "player", "balloon_color", "window_start")
#: The key columns each view uses.
FAN_USES = {
    "leaderboard": ("player",),
    "balloon_color_stats": ("player", "balloon_color"),
    "realtime_scores": ("player", "window_start"),
    "balloon_colored_pops": ("player", "balloon_color", "window_start"),
    "color_performance_trends": ("balloon_color", "window_start"),
}


def window_start_of(ts: str, width: str, ts_type: str) -> Column:
    """Start of the tumbling window that holds a time; NULL for NULL."""
    from popflow.operators.performance import interval_micros

    us = interval_micros(width)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    if ts_type == "timestamp":
        return F.timestamp_micros(F.floor(F.unix_micros(ts) / F.lit(us)).cast("long") * us)
    steps = F.floor(F.timestamp_diff("MICROSECOND", epoch, F.col(ts)) / F.lit(us)).cast("long")
    return F.timestamp_add("MICROSECOND", steps * us, epoch)


def fan_out(events: DataFrame, width: str = DEFAULT_WINDOW, names=None) -> DataFrame:
    """All the views as one aggregate, from one read of the events.

    Each event becomes one row per view, tagged with the view and the keys that
    view groups by, and one hash aggregate over (view, keys) maintains the sums
    that every view is made of. Rows are five times the events only up to the
    map-side partial aggregate. As in the views themselves, an event without a
    time counts in the views without windows.
    """
    start = window_start_of("event_ts", width, dict(events.dtypes)["event_ts"])
    kinds = {"player": "player", "balloon_color": "balloon_color", "window_start": "_start"}
    tags = F.array(*[
        F.struct(F.lit(name).alias("view"), *[
            (F.col(kinds[key]) if key in FAN_USES[name] else F.lit(None).cast(dict(events.dtypes).get(key, dict(events.dtypes)["event_ts"])))
            .alias(key) for key in FAN_KEYS[1:]]) for name in names or FAN_USES])
    windowed = [n for n in names or FAN_USES if "window_start" in FAN_USES[n]]
    tagged = events.withColumn("_start", start).withColumn("_tag", F.explode(
        F.filter(tags, lambda t: ~t["view"].isin(*windowed) | t["window_start"].isNotNull())))
    return (tagged.select("_tag.*", "score", "favorite_color_bonus", "event_ts").groupBy(*FAN_KEYS).agg(
        F.count(F.lit(1)).alias("pops"), F.count("score").alias("scored"), F.sum("score").alias("points"),
        count_true("favorite_color_bonus").alias("bonus_hits"), F.max("event_ts").alias("event_ts")))


def from_fan(name: str, fanned: DataFrame, width: str = DEFAULT_WINDOW) -> DataFrame:
    """One view's rows out of the fanned-out aggregate, with the view's columns."""
    window = [F.col("window_start"), (F.col("window_start") + F.expr(f"INTERVAL {width}")).alias("window_end")]
    columns = {
        "leaderboard": ["player", F.col("points").alias("total_score"), "bonus_hits", "event_ts"],
        "balloon_color_stats": ["player", "balloon_color", F.col("pops").alias("balloon_pops"),
                                F.col("points").alias("points_by_color"), "bonus_hits", "event_ts"],
        "realtime_scores": ["player", F.col("points").alias("total_score"), *window],
        "balloon_colored_pops": ["player", "balloon_color", F.col("pops").alias("balloon_pops"),
                                 F.col("points").alias("points_by_color"), "bonus_hits", *window],
        "color_performance_trends": ["balloon_color", (F.col("points") / F.col("scored")).alias("avg_score_per_pop"),
                                     F.col("pops").alias("total_pops"), *window],
    }[name]
    return fanned.where(F.col("view") == name).select(*columns)


def events_for_windows(events: DataFrame, width: str = DEFAULT_WINDOW, start=None,
                       end=None, after=None) -> DataFrame:
    """Restrict events to those that can fall in a window whose start lies in
    ``[start, end]`` (or is ``> after``).

    A window starting at ``ws`` holds events with ``ws <= event_ts < ws +
    width``, so ``start <= event_ts < end + width`` keeps every event of
    every qualifying window (a superset; windows straddling ``start`` are
    removed by the exact filter on ``window_start`` after aggregation). The
    predicate is on the raw timestamp, so it reaches the Parquet scan
    (row-group / partition skipping) instead of aggregating all history.
    """
    from popflow.functions.expressions import ts_as

    ts = F.col("event_ts")
    ts_type = dict(events.dtypes)["event_ts"]
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= ts_as(start, ts_type))
    if end is not None:
        cond = cond & (ts < ts_as(end, ts_type) + F.expr(f"INTERVAL {width}"))
    if after is not None:
        cond = cond & (ts > ts_as(after, ts_type))
    return events.where(cond)


def window_bounds(events: DataFrame, width: str = DEFAULT_WINDOW) -> DataFrame:
    """First and last ``window_start`` of the windowed views (one row), from a
    min/max over the raw event times."""
    from popflow.operators.performance import interval_micros

    us = interval_micros(width)
    epoch = F.lit("1970-01-01 00:00:00").cast(dict(events.dtypes)["event_ts"])

    def start(c):
        steps = F.floor(F.timestamp_diff("MICROSECOND", epoch, F.col(c)) / F.lit(us)).cast("long")
        return F.timestamp_add("MICROSECOND", steps * us, epoch).alias(c)

    return (events.agg(F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi"))
            .select(start("lo"), start("hi")))


VIEWS = {
    "leaderboard": leaderboard,
    "balloon_color_stats": color_stats,
    "realtime_scores": realtime_scores,
    "balloon_colored_pops": colored_pops,
    "color_performance_trends": color_performance,
}


def to_table_types(name: str, df: DataFrame) -> DataFrame:
    """Cast a view's output to its table schema (names, order and types)."""
    from popflow.schemas import TABLE_SCHEMAS

    schema = TABLE_SCHEMAS[name]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
