"""Schemas of the event stream and of the five result tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw event as it arrives on the stream (JSON). ``page_id`` is declared by
# the source but never produced, so it is nullable and normally NULL.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("player", T.StringType(), True),
        T.StructField("balloon_color", T.StringType(), True),
        T.StructField("score", T.IntegerType(), True),
        T.StructField("page_id", T.IntegerType(), True),
        T.StructField("favorite_color_bonus", T.BooleanType(), True),
        T.StructField("event_ts", T.TimestampType(), True),
    ]
)

# Declared schemas of input tables read by path. Declaring them means a read
# plans without first opening file footers to infer the schema (one job per
# read otherwise); a file whose columns do not match fails at scan time.
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "events": T.StructType([
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]),
}

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, False) for n, t in cols])


TABLE_SCHEMAS: dict[str, T.StructType] = {
    "leaderboard": _struct(
        ("player", _S), ("total_score", _L), ("bonus_hits", _L), ("event_ts", _TS)
    ),
    "balloon_color_stats": _struct(
        ("player", _S),
        ("balloon_color", _S),
        ("balloon_pops", _L),
        ("points_by_color", _L),
        ("bonus_hits", _L),
        ("event_ts", _TS),
    ),
    "realtime_scores": _struct(
        ("player", _S), ("total_score", _L), ("window_start", _TS), ("window_end", _TS)
    ),
    "balloon_colored_pops": _struct(
        ("player", _S),
        ("balloon_color", _S),
        ("balloon_pops", _L),
        ("points_by_color", _L),
        ("bonus_hits", _L),
        ("window_start", _TS),
        ("window_end", _TS),
    ),
    "color_performance_trends": _struct(
        ("balloon_color", _S),
        ("avg_score_per_pop", T.DecimalType(28, 10)),
        ("total_pops", _L),
        ("window_start", _TS),
        ("window_end", _TS),
    ),
}

# Primary key of each view / table (the columns an update is keyed on).
TABLE_KEYS: dict[str, tuple[str, ...]] = {
    "leaderboard": ("player",),
    "balloon_color_stats": ("player", "balloon_color"),
    "realtime_scores": ("player", "window_start", "window_end"),
    "balloon_colored_pops": ("player", "balloon_color", "window_start", "window_end"),
    "color_performance_trends": ("balloon_color", "window_start", "window_end"),
}
