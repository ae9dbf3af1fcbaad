"""Registered queries (Spark) and their independent DuckDB oracle SQL.

Every query reads the driver's tables under ``sf_dir`` and runs over all of
their rows. Page queries use 6-hour windows (15-second windows of the test
data hold about one event each); the five views are also registered at the
reference's 15-second width.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import uuid

from popflow.functions.expressions import parse_ts, ts_literal, utc_instant, utc_wall_clock
from popflow.operators import colors, leaderboard as lbp, performance as perf
from popflow.operators import quality, sketches, views
from popflow.operators.ranking import latest_by_key
from popflow.operators.scoring import character_name, config_tables, score_pops
from popflow.operators.scoring import score_pops_with_tables
from popflow.schemas import TABLE_SCHEMAS
from popflow.session import shared_dir
from popflow.sources.events import decode_events, encode_events, game_events, read_table_file
from popflow.sources.tables import TableStore

# Parameters of the registered page queries.
PLAYER = "player_7"
TOP_K = 5
RANGE_START = "2024-01-10 00:00:00"
RANGE_END = "2024-01-15 00:00:00"
RECENT = "1 day"
FRESHNESS_NOW = "2024-02-01 00:00:00"
VIEW_WIDTH = "15 seconds"
PAGE_WIDTH = "6 hours"

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _ge(spark, d):
    return game_events(spark, d)


def _lb(spark, d):
    return views.leaderboard(_ge(spark, d))


def _cs(spark, d):
    return views.color_stats(_ge(spark, d))


def _rs(spark, d, w=PAGE_WIDTH):
    return views.realtime_scores(_ge(spark, d), w)


def _cp(spark, d, w=PAGE_WIDTH):
    return views.colored_pops(_ge(spark, d), w)


def _cpt(spark, d, w=PAGE_WIDTH):
    return views.color_performance(_ge(spark, d), w)


def q_decode_props(spark, d):
    ev = read_table_file(spark, d, "events")
    return ev.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


def q_event_roundtrip(spark, d):
    """Encode game events as JSON payloads and decode them back (A2 + A3)."""
    ge = _ge(spark, d)
    payload = ge.select("player", "balloon_color", "score", "favorite_color_bonus",
                        utc_instant("event_ts").alias("event_ts"))
    dec = decode_events(encode_events(payload, key_col=None), "value").events
    return dec.withColumn("event_ts", utc_wall_clock("event_ts"))


def q_decode_partial_events(spark, d):
    """Events that lack a field (here every third has no colour, every fifth no
    score) still count in the views that do not need it."""
    ge = _ge(spark, d)
    payload = ge.select("player", F.when(F.col("event_id") % 3 != 0, F.col("balloon_color")).alias("balloon_color"),
                        F.when(F.col("event_id") % 5 != 0, F.col("score")).alias("score"),
                        utc_instant("event_ts").alias("event_ts"))
    dec = decode_events(encode_events(payload, key_col=None), "value").events
    return dec.groupBy("player").agg(F.sum("score").alias("total_score"), F.count("balloon_color").alias("colored"),
                                     F.count(F.lit(1)).alias("events"))


def q_score_pops_tables(spark, d):
    color_table, favorites = config_tables(spark)
    pops = _ge(spark, d).select("event_id", character_name("char_id").alias("character"), "balloon_color")
    return score_pops_with_tables(pops, color_table, favorites).select(
        "event_id", "character", "balloon_color", "score", "favorite_color_bonus")


def q_time_parsing(spark, d):
    ev = read_table_file(spark, d, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return ev.select("event_id", utc_wall_clock(parse_ts(F.concat(text, F.lit("Z")))).alias("ts"))


def _positions(df, *order):
    """Numbers an ordered result of a few rows, so that a check sees its order."""
    from pyspark.sql import Window
    return df.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)))


def q_display_maxima(spark, d):
    """Ends of the page scales: largest scoreboard total and colour counts."""
    top = lbp.max_total_score(_lb(spark, d)).select(F.col("max_score").alias("max_total_score"))
    cp = _cp(spark, d)
    return (top.withColumn("max_least_popular", colors.least_popular_colors(cp).agg(F.max("count")).scalar())
            .withColumn("max_most_popular", colors.most_popular_colors(cp).agg(F.max("count")).scalar()))


def q_scores_in_date_time_range(spark, d):
    ev = views.events_for_windows(_ge(spark, d), PAGE_WIDTH, RANGE_START, RANGE_END)
    return lbp.in_date_time_range(views.realtime_scores(ev, PAGE_WIDTH), *RANGE_START.split(), *RANGE_END.split())


def _window_summary(spark, d, width):
    """One windowed aggregation: the bins to fill come from the raw event times."""
    ge = _ge(spark, d)
    return perf.time_window_summary(views.color_performance(ge, width), width, bounds=views.window_bounds(ge, width))


# -- stored tables ------------------------------------------------------------

def _fresh_store(spark, what) -> TableStore:
    """An empty namespace of its own under the shared folder."""
    name = f"{what}_{uuid.uuid4().hex[:12]}"
    store = TableStore(spark, name, location=shared_dir(spark, "stored", name))
    store.create_namespace()
    return store


def _stored_events(spark, d):
    return _ge(spark, d).withColumn("event_ts", utc_instant("event_ts"))


def _stored(spark, d, names=None, width=PAGE_WIDTH) -> TableStore:
    """The views written to their changelog tables through the sink: batch 0
    from the events with an even id, batch 1 from all of them."""
    from popflow.streaming.fanout import fanout_writer

    store = _fresh_store(spark, "stored")
    names = list(names or views.VIEWS)
    store.create_view_tables(names)
    write = fanout_writer(store, names, width, None)
    ev = _stored_events(spark, d)
    for batch, part in enumerate((ev.where("event_id % 2 = 0"), ev)):
        write(views.fan_out(part, width, names), batch)
    return store


def _kept(df, store: TableStore):
    """A result that outlives its tables: kept in the shared checkpoint folder,
    then the tables are dropped."""
    out = df.checkpoint(eager=True)
    store.drop_namespace()
    return out


def _as_stored(df, name):
    """Columns of a stored table with zone-less times, as the views have them."""
    return df.select(*[utc_wall_clock(f.name).alias(f.name) if f.name in ("event_ts", "window_start", "window_end")
                       else F.col(f.name) for f in TABLE_SCHEMAS[name]])


def q_current_leaderboard(spark, d):
    store = _stored(spark, d, ["leaderboard"])
    return _kept(_as_stored(store.read_table("leaderboard"), "leaderboard"), store)


def q_as_of_leaderboard(spark, d):
    store = _stored(spark, d, ["leaderboard"])
    return _kept(_as_stored(store.read_table("leaderboard", as_of_batch=0), "leaderboard"), store)


def q_commit_log(spark, d):
    store = _stored(spark, d, ["leaderboard"])
    log = store.commit_log("leaderboard")
    return _kept(log.select("table_name", "batch_id", "rows", utc_wall_clock("min_ts").alias("min_ts"),
                            utc_wall_clock("max_ts").alias("max_ts")), store)


def q_stored_counts(spark, d):
    """Rows of the whole changelog tables, from what the sink measured."""
    store = _stored(spark, d)
    return _kept(quality.measured_counts({n: store.commits(n) for n in views.VIEWS}), store)


def q_stored_player_lookup(spark, d):
    """One player's windows from the stored table, found by the files' Bloom filters."""
    store = _stored(spark, d, ["balloon_colored_pops"])
    return _kept(_as_stored(store.player_rows("balloon_colored_pops", [PLAYER]), "balloon_colored_pops"), store)


def q_stored_reconcile(spark, d):
    store = _stored(spark, d, ["balloon_color_stats"])
    view = views.color_stats(_stored_events(spark, d))
    return _kept(quality.reconcile(view, store.read_table("balloon_color_stats"), ["player", "balloon_color"],
                                   ["balloon_pops", "points_by_color", "bonus_hits", "event_ts"]), store)


def q_stored_freshness(spark, d):
    names = ["leaderboard", "balloon_color_stats"]
    store = _stored(spark, d, names)
    out = quality.measured_freshness({n: store.commits(n) for n in names}, now=FRESHNESS_NOW)
    return _kept(out.withColumn("latest_ts", utc_wall_clock("latest_ts")), store)


def q_stored_required_nulls(spark, d):
    store = _stored(spark, d)
    return _kept(quality.measured_nulls({n: (store.commits(n), TABLE_SCHEMAS[n]) for n in views.VIEWS}), store)


def _clicks_table(spark, d):
    """A plain table that the events were appended to in two steps."""
    store = _fresh_store(spark, "plain")
    ev = read_table_file(spark, d, "events").select("event_id", "event_type")
    store.create_table("clicks", ev.schema, comment="it's a copy")
    store.append(ev.where("event_id % 2 = 0"), "clicks")
    store.append(ev.where("event_id % 2 = 1"), "clicks")
    return store, ev


def q_lifecycle_append(spark, d):
    store, _ = _clicks_table(spark, d)
    store.add_column("clicks", "note", "STRING", "added later")
    return _kept(store.table("clicks"), store)


def q_lifecycle_overwrite(spark, d):
    store, ev = _clicks_table(spark, d)
    store.overwrite(ev.where("event_type = 'click'"), "clicks")
    return _kept(store.table("clicks"), store)


def q_score_pops(spark, d):
    ge = _ge(spark, d)
    pops = ge.select("event_id", character_name("char_id").alias("character"),
                     "balloon_color", "event_ts")
    return score_pops(pops).select("event_id", "character", "balloon_color", "score",
                                   "favorite_color_bonus")


def q_latest_per_player(spark, d):
    ge = _ge(spark, d).select("player", "event_id", "score", "event_ts")
    return latest_by_key(ge, ["player"], ["event_ts", "event_id"])


def q_scores_recent(spark, d):
    ge = _ge(spark, d)
    now = ge.select(F.max("event_ts")).scalar()
    since = ts_literal(now) - F.expr(f"INTERVAL {RECENT}")
    ev = views.events_for_windows(ge, PAGE_WIDTH, after=since)
    return lbp.since(views.realtime_scores(ev, PAGE_WIDTH), RECENT, now=now)


def _rs_in_range(spark, d):
    """Windowed scores restricted to the page's time range; the range is
    also applied to the raw event time so it reaches the scan."""
    ev = views.events_for_windows(_ge(spark, d), PAGE_WIDTH, RANGE_START, RANGE_END)
    return lbp.in_time_range(views.realtime_scores(ev, PAGE_WIDTH), RANGE_START, RANGE_END)


def q_table_counts(spark, d):
    return quality.view_counts(_ge(spark, d), VIEW_WIDTH)


def q_reconcile_leaderboard(spark, d):
    """Leaderboard view vs the colour-stats table rolled up per player."""
    lb = _lb(spark, d)
    rolled = _cs(spark, d).groupBy("player").agg(
        F.sum("points_by_color").alias("total_score"),
        F.sum("bonus_hits").alias("bonus_hits"))
    return quality.reconcile(lb, rolled, ["player"], ["total_score", "bonus_hits"])


def q_reconcile_changed(spark, d):
    """Colour statistics of all events against those without every 500th event and
    with some colours unknown: by digests, joining only what differs."""
    ge = _ge(spark, d)
    other = ge.where("event_id % 500 <> 0").withColumn("balloon_color", F.when(
        (F.col("event_id") % 1000 == 1) & (F.col("char_id") == 3), F.lit(None)).otherwise(F.col("balloon_color")))
    return quality.reconcile_by_digest(views.color_stats(ge), views.color_stats(other), ["player", "balloon_color"],
                                       ["balloon_pops", "points_by_color", "bonus_hits", "event_ts"])


def q_freshness(spark, d):
    ge = _ge(spark, d)
    return quality.freshness({
        "leaderboard": (views.leaderboard(ge), "event_ts"),
        "balloon_color_stats": (views.color_stats(ge), "event_ts"),
    }, now=FRESHNESS_NOW)


def _stream_current(spark, d, name, width=None, shuffled=False):
    """A view maintained by the streaming path (file stream of the events'
    JSON, update-mode stateful aggregation over several micro-batches,
    changelog sink) and read back as current state; equal to the batch
    view, so it is checked against the same oracle."""
    from popflow.streaming.replay import replay_events

    store = replay_events(_ge(spark, d), names=[name], width=width, shuffled=shuffled)
    return _kept(_as_stored(store.read_table(name, "current"), name), store)


def q_stream_from_latest(spark, d):
    """A leaderboard that starts at the latest offset of an event log: a third of the
    events are older, a third arrive while it runs, a third while it is stopped."""
    from popflow.streaming.replay import follow_log

    ge = _ge(spark, d)
    store = follow_log(*(ge.where(F.col("event_id") % 3 == i) for i in range(3)), names=["leaderboard"])
    return _kept(_as_stored(store.read_table("leaderboard", "current"), "leaderboard"), store)


def q_perf_distribution_daily(spark, d):
    """Box plots per day, merged from the stored sketches of its 6-hour windows."""
    store = _fresh_store(spark, "sketches")
    found = sketches.perf_sketches(_cpt(spark, d))
    store.create_table("window_sketches", found.schema)
    store.append(found, "window_sketches")
    day = F.col("window_start").cast("date").alias("day")
    return _kept(sketches.box_plot(sketches.merge_values(store.table("window_sketches"), day), "day"), store)


def q_stream_color_coverage(spark, d):
    """Distinct colours per player from sketches that a stream keeps, the events dealt at random."""
    from popflow.streaming.replay import stage_events, staged_stream
    from popflow.streaming.sketches import start_color_sketches, stored_sketches

    base = stage_events(_ge(spark, d), shuffled=True)
    store = TableStore(spark, f"sketches_{base.rsplit('/', 1)[-1]}", location=f"{base}/tables")
    stream = staged_stream(spark, base)
    query = start_color_sketches(stream, store, f"{base}/checkpoint", trigger={"availableNow": True})
    query.awaitTermination()
    return _kept(sketches.coverage(stored_sketches(store)), store)


def q_stream_window_summary(spark, d):
    """The window summary with its empty windows, both kept by a stream: the windows
    with events by the view, the stretches without any by a state per series."""
    from popflow.streaming.gaps import start_gaps, stored_stretches
    from popflow.streaming.pipeline import await_all, start_views
    from popflow.streaming.replay import stage_events, staged_stream, state_partition_count

    name = "color_performance_trends"
    held = state_partition_count(spark)
    ge = _ge(spark, d)
    first, last = ge.agg(F.min("event_ts"), F.max("event_ts")).first()
    # the staged slices may come in any order: the delay covers them all
    days = max(366, (last - first).days + 1 if first else 0)
    base = stage_events(ge)
    store = TableStore(spark, f"gaps_{base.rsplit('/', 1)[-1]}", location=f"{base}/tables")
    stream = staged_stream(spark, base)
    await_all({**start_views(stream, store, f"{base}/checkpoints", [name], PAGE_WIDTH, trigger={"availableNow": True},
                             state_partitions=held),
               "gaps": start_gaps(stream, store, f"{base}/checkpoints/gaps", PAGE_WIDTH, lateness=f"{days} days",
                                  trigger={"availableNow": True}, state_partitions=held)})
    out = perf.time_window_summary(store.read_table(name), PAGE_WIDTH, stretches=stored_stretches(store))
    return _kept(out.withColumn("window_start", utc_wall_clock("window_start")), store)


def q_stream_bounded_state(spark, d):
    """The leaderboard with state for active players only, the events dealt at random
    over the micro-batches: an idle player's total leaves the state, and what comes
    later, however late, still counts."""
    from popflow.streaming.bounded import bounded_totals, start_bounded
    from popflow.streaming.replay import stage_events, staged_stream, state_partition_count

    base = stage_events(_ge(spark, d), shuffled=True)
    store = TableStore(spark, f"bounded_{base.rsplit('/', 1)[-1]}", location=f"{base}/tables")
    stream = staged_stream(spark, base)
    query = start_bounded(stream, store, ["player"], f"{base}/checkpoint", idle="1 second", trigger={"availableNow": True},
                          state_partitions=state_partition_count(spark))
    query.awaitTermination()
    return _kept(bounded_totals(store, ["player"]).select(
        "player", "total_score", "bonus_hits", utc_wall_clock("event_ts").alias("event_ts")), store)


def q_stream_one_read(spark, d):
    """All five tables as one query maintains them that reads every event once:
    the rows of each table, tagged with its name (points, pops and bonus hits
    where the table has them)."""
    from popflow.streaming.replay import drain, stage_events

    store = drain(spark, stage_events(_ge(spark, d)), width=PAGE_WIDTH, one_read=True)
    parts = []
    for name in views.VIEWS:
        table = _as_stored(store.read_table(name, "current"), name)
        have = {c: c for c in table.columns} | {c: c2 for c2, c in (
            ("total_score", "points"), ("points_by_color", "points"), ("balloon_pops", "pops"), ("total_pops", "pops"))
            if c2 in table.columns}
        kinds = {"player": "string", "balloon_color": "string", "window_start": "timestamp_ntz", "points": "bigint",
                 "pops": "bigint", "bonus_hits": "bigint", "avg_score_per_pop": "double", "event_ts": "timestamp_ntz"}
        parts.append(table.select(F.lit(name).alias("table_name"), *[
            (F.col(have[c]) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return _kept(out, store)


def q_null_report(spark, d):
    return quality.null_report(read_table_file(spark, d, "events"))


QUERIES: dict[str, Query] = {
    # five views
    "leaderboard": _lb,
    "color_stats": _cs,
    "realtime_scores": lambda s, d: _rs(s, d, VIEW_WIDTH),
    "realtime_scores_6h": lambda s, d: _rs(s, d, PAGE_WIDTH),
    "colored_pops": lambda s, d: _cp(s, d, VIEW_WIDTH),
    "colored_pops_6h": lambda s, d: _cp(s, d, PAGE_WIDTH),
    "color_performance": lambda s, d: _cpt(s, d, VIEW_WIDTH),
    "color_performance_6h": lambda s, d: _cpt(s, d, PAGE_WIDTH),
    # ingestion and scoring
    "decode_props": q_decode_props,
    "event_roundtrip": q_event_roundtrip,
    "decode_partial_events": q_decode_partial_events,
    "time_parsing": q_time_parsing,
    "score_pops": q_score_pops,
    "score_pops_tables": q_score_pops_tables,
    # leaderboard page
    "latest_per_player": q_latest_per_player,
    "leaderboard_sorted": lambda s, d: lbp.leaderboard_sorted(_lb(s, d)),
    "scoreboard": lambda s, d: lbp.scoreboard(_lb(s, d)),
    "scoreboard_top5": lambda s, d: lbp.scoreboard_top(_lb(s, d), TOP_K),
    "scores_top5_players": lambda s, d: lbp.scores_for_top_players(_rs(s, d), _lb(s, d), TOP_K),
    "scores_in_range": _rs_in_range,
    "scores_recent": q_scores_recent,
    "score_trend": lambda s, d: lbp.score_trend(
        _rs_in_range(s, d), lbp.top_players(_lb(s, d), TOP_K), RANGE_START, RANGE_END,
        "minutes"),
    "time_bounds": lambda s, d: lbp.time_bounds(_rs(s, d), _lb(s, d)),
    "display_maxima": q_display_maxima,
    "scores_in_date_time_range": q_scores_in_date_time_range,
    "score_trend_hours": lambda s, d: lbp.score_trend(_rs_in_range(s, d), None, unit="hours"),
    # colour page
    "color_stats_for_player": lambda s, d: colors.for_player(_cs(s, d), PLAYER),
    "color_usage": lambda s, d: colors.color_usage(_cp(s, d)),
    "color_usage_pops": lambda s, d: colors.color_usage(_cp(s, d), weight="pops"),
    "color_popularity": lambda s, d: colors.color_popularity(_cp(s, d)),
    "metric_total": lambda s, d: colors.metric_total(_cp(s, d), "points_by_color"),
    "color_coverage": lambda s, d: colors.color_coverage(_cp(s, d)),
    "favorite_color": lambda s, d: colors.favorite_color(_cp(s, d)),
    "least_popular_colors": lambda s, d: colors.least_popular_colors(_cp(s, d)),
    "most_popular_colors": lambda s, d: colors.most_popular_colors(_cp(s, d)),
    "metric_by_color": lambda s, d: colors.metric_by_color(_cp(s, d)),
    "player_totals": lambda s, d: colors.player_totals(_cp(s, d)),
    "players": lambda s, d: colors.players(_cp(s, d)),
    # performance page
    "performance_summary": lambda s, d: perf.performance_summary(_cpt(s, d)),
    "color_perf_stats": lambda s, d: _positions(perf.color_perf_stats(_cpt(s, d)), F.desc("average_score"), "balloon_color"),
    "time_window_summary": lambda s, d: _window_summary(s, d, VIEW_WIDTH),
    "time_window_summary_6h": lambda s, d: _window_summary(s, d, PAGE_WIDTH),
    "perf_distribution": lambda s, d: perf.perf_distribution(_cpt(s, d, VIEW_WIDTH)),
    "perf_distribution_6h": lambda s, d: perf.perf_distribution(_cpt(s, d)),
    "avg_by_color": lambda s, d: _positions(perf.avg_by_color(_cpt(s, d)), F.desc("avg_score"), "balloon_color"),
    # verification (K1-K4)
    "table_counts": q_table_counts,
    "reconcile_leaderboard": q_reconcile_leaderboard,
    "reconcile_changed": q_reconcile_changed,
    "freshness": q_freshness,
    "null_report": q_null_report,
    # stored tables
    "current_leaderboard": q_current_leaderboard,
    "as_of_leaderboard": q_as_of_leaderboard,
    "commit_log": q_commit_log,
    "stored_counts": q_stored_counts,
    "stored_reconcile": q_stored_reconcile,
    "stored_player_lookup": q_stored_player_lookup,
    "stored_freshness": q_stored_freshness,
    "stored_required_nulls": q_stored_required_nulls,
    "lifecycle_append": q_lifecycle_append,
    "lifecycle_overwrite": q_lifecycle_overwrite,
    # the same views maintained by the streaming path (S1-S4, A5, E1); last,
    # so the bench times the batch queries before any stream has run
    "stream_leaderboard": lambda s, d: _stream_current(s, d, "leaderboard"),
    "stream_colored_pops_6h": lambda s, d: _stream_current(s, d, "balloon_colored_pops",
                                                           PAGE_WIDTH),
    "stream_color_stats": lambda s, d: _stream_current(s, d, "balloon_color_stats"),
    "stream_realtime_scores_6h": lambda s, d: _stream_current(s, d, "realtime_scores", PAGE_WIDTH),
    "stream_color_performance_6h": lambda s, d: _stream_current(s, d, "color_performance_trends", PAGE_WIDTH),
    # the events dealt at random: every micro-batch holds late ones
    "stream_late_events": lambda s, d: _stream_current(s, d, "realtime_scores", PAGE_WIDTH, shuffled=True),
    # a subscriber at "latest" of an event log, stopped and started again
    "stream_from_latest": q_stream_from_latest,
    # five tables from one query and one read of the source
    "stream_one_read": q_stream_one_read,
    # bounded state with corrected late events
    "stream_bounded_state": q_stream_bounded_state,
    # empty windows by event-time timers
    "stream_window_summary": q_stream_window_summary,
    # stored sketches, merged
    "perf_distribution_daily": q_perf_distribution_daily,
    "stream_color_coverage": q_stream_color_coverage,
}


# ---------------------------------------------------------------------------
# DuckDB oracle side
# ---------------------------------------------------------------------------

# The mapping and the game values are written out here once more, so that an
# error in the implementation's tables cannot pass on both sides.
GE = """ge AS (
  SELECT event_id,
         concat('player_', CAST(user_id AS VARCHAR)) AS player,
         CAST(user_id % 18 AS INT) AS char_id,
         CASE event_type WHEN 'click' THEN 'red' WHEN 'view' THEN 'blue' WHEN 'purchase' THEN 'gold'
              WHEN 'signup' THEN 'green' ELSE 'black' END AS balloon_color,
         CAST(floor(value) AS INT) AS score,
         (CAST(json_extract(props, '$.k') AS INT) % 7 = 0) AS favorite_color_bonus,
         ts AS event_ts
  FROM events)"""

LB = """lb AS (
  SELECT player, CAST(sum(score) AS BIGINT) AS total_score,
         count(CASE WHEN favorite_color_bonus THEN 1 END) AS bonus_hits,
         max(event_ts) AS event_ts
  FROM ge GROUP BY player)"""

CS = """cs AS (
  SELECT player, balloon_color, count(*) AS balloon_pops,
         CAST(sum(score) AS BIGINT) AS points_by_color,
         count(CASE WHEN favorite_color_bonus THEN 1 END) AS bonus_hits,
         max(event_ts) AS event_ts
  FROM ge GROUP BY player, balloon_color)"""


def _bucket(w: str, col: str = "event_ts") -> str:
    return f"time_bucket(INTERVAL '{w}', {col})"


def RS(w: str, name: str = "rs") -> str:
    return f"""{name} AS (
  SELECT player, CAST(sum(score) AS BIGINT) AS total_score,
         {_bucket(w)} AS window_start, {_bucket(w)} + INTERVAL '{w}' AS window_end
  FROM ge GROUP BY player, {_bucket(w)})"""


def CP(w: str, name: str = "cp") -> str:
    return f"""{name} AS (
  SELECT player, balloon_color, count(*) AS balloon_pops,
         CAST(sum(score) AS BIGINT) AS points_by_color,
         count(CASE WHEN favorite_color_bonus THEN 1 END) AS bonus_hits,
         {_bucket(w)} AS window_start, {_bucket(w)} + INTERVAL '{w}' AS window_end
  FROM ge GROUP BY player, balloon_color, {_bucket(w)})"""


def CPT(w: str, name: str = "cpt") -> str:
    return f"""{name} AS (
  SELECT balloon_color, avg(score) AS avg_score_per_pop, count(*) AS total_pops,
         {_bucket(w)} AS window_start, {_bucket(w)} + INTERVAL '{w}' AS window_end
  FROM ge GROUP BY balloon_color, {_bucket(w)})"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


W15, W6 = VIEW_WIDTH, PAGE_WIDTH
TRUNC = "CAST(trunc(avg_score_per_pop) AS INT)"
TOP5 = f"SELECT player FROM lb ORDER BY total_score DESC, player ASC LIMIT {TOP_K}"
RANGE = f"window_start BETWEEN TIMESTAMP '{RANGE_START}' AND TIMESTAMP '{RANGE_END}'"


def _colors_values() -> str:
    return ("('red', 100), ('blue', 75), ('green', 60), ('yellow', 50), ('purple', 40), ('brown', 35), "
            "('orange', 45), ('pink', 55), ('gold', 90), ('grey', 70), ('white', 80)")


def _favs_values() -> str:
    return """(0, 'Jerry', ['brown', 'yellow']), (1, 'Tom', ['grey', 'blue']), (2, 'Mickey', ['red', 'black']),
  (3, 'Donald', ['blue', 'white']), (4, 'Bugs_Bunny', ['grey', 'orange']), (5, 'Daffy_Duck', ['black', 'orange']),
  (6, 'SpongeBob', ['yellow', 'brown']), (7, 'Patrick', ['pink', 'green']), (8, 'Pikachu', ['yellow', 'red']),
  (9, 'Mario', ['red', 'blue']), (10, 'Sonic', ['blue', 'gold']), (11, 'Woody', ['brown', 'yellow']),
  (12, 'Buzz', ['green', 'purple']), (13, 'Scooby', ['brown', 'green']), (14, 'Popeye', ['blue', 'red']),
  (15, 'Pink_Panther', ['pink', 'purple']), (16, 'Road_Runner', ['blue', 'purple']),
  (17, 'Tweety', ['yellow', 'orange'])"""


def _title(col: str) -> str:
    return f"upper({col}[1]) || lower({col}[2:])"


def _gapfill_sql(w: str, cpt_w: str) -> str:
    return _with(GE, CPT(cpt_w), f"""d AS (
  SELECT {_bucket(w, 'window_start')} AS bin, {TRUNC} AS v, total_pops FROM cpt)""",
                 f"""bins AS (
  SELECT unnest(generate_series(min(bin), max(bin), INTERVAL '{w}')) AS bin FROM d)""") + """
SELECT bins.bin AS window_start, round_even(avg(v), 1) AS mean_score,
       min(v) AS min_score, max(v) AS max_score, count(v) AS n_colors,
       CAST(coalesce(sum(total_pops), 0) AS BIGINT) AS total_pops
FROM bins LEFT JOIN d ON bins.bin = d.bin GROUP BY bins.bin"""


def _dist_sql(cpt_w: str) -> str:
    return _with(GE, CPT(cpt_w)) + f"""
SELECT window_start, min({TRUNC}) AS "min",
       CAST(quantile_cont({TRUNC}, 0.25) AS DOUBLE) AS q1,
       CAST(quantile_cont({TRUNC}, 0.5) AS DOUBLE) AS median,
       CAST(quantile_cont({TRUNC}, 0.75) AS DOUBLE) AS q3,
       max({TRUNC}) AS "max"
FROM cpt GROUP BY window_start"""


ORACLE: dict[str, str] = {
    "leaderboard": _with(GE, LB) + "SELECT * FROM lb",
    "color_stats": _with(GE, CS) + "SELECT * FROM cs",
    "realtime_scores": _with(GE, RS(W15)) + "SELECT * FROM rs",
    "realtime_scores_6h": _with(GE, RS(W6)) + "SELECT * FROM rs",
    "colored_pops": _with(GE, CP(W15)) + "SELECT * FROM cp",
    "colored_pops_6h": _with(GE, CP(W6)) + "SELECT * FROM cp",
    "color_performance": _with(GE, CPT(W15)) + "SELECT * FROM cpt",
    "color_performance_6h": _with(GE, CPT(W6)) + "SELECT * FROM cpt",
    "stream_leaderboard": _with(GE, LB) + "SELECT * FROM lb",
    "stream_colored_pops_6h": _with(GE, CP(W6)) + "SELECT * FROM cp",
    "decode_props":
        "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events",
    "event_roundtrip": _with(GE) + """
SELECT player, balloon_color, score, CAST(NULL AS INT) AS page_id, favorite_color_bonus,
       event_ts FROM ge""",
    "score_pops": _with(GE, f"colors(balloon_color, points) AS (VALUES {_colors_values()})",
                        f"favs(char_id, character, favorite_colors) AS (VALUES {_favs_values()})")
    + """
SELECT ge.event_id, f.character, ge.balloon_color,
       CAST(CASE WHEN coalesce(list_contains(f.favorite_colors, ge.balloon_color), false)
                 THEN 2 * coalesce(c.points, 0) ELSE coalesce(c.points, 0) END AS INT) AS score,
       coalesce(list_contains(f.favorite_colors, ge.balloon_color), false)
         AS favorite_color_bonus
FROM ge LEFT JOIN favs f ON ge.char_id = f.char_id
        LEFT JOIN colors c ON ge.balloon_color = c.balloon_color""",
    "latest_per_player": _with(GE) + """
SELECT player, event_id, score, event_ts FROM ge
QUALIFY row_number() OVER (PARTITION BY player ORDER BY event_ts DESC, event_id DESC) = 1""",
    "leaderboard_sorted": _with(GE, LB) + """
SELECT row_number() OVER (ORDER BY total_score DESC, bonus_hits DESC, player ASC) AS position,
       player, total_score, bonus_hits FROM lb""",
    "scoreboard": _with(GE, LB) + "SELECT player, total_score, bonus_hits FROM lb",
    "scoreboard_top5": _with(GE, LB) + f"""
SELECT player, total_score, bonus_hits FROM lb
ORDER BY total_score DESC, player ASC LIMIT {TOP_K}""",
    "scores_top5_players": _with(GE, LB, RS(W6)) + f"""
SELECT * FROM rs WHERE player IN ({TOP5})""",
    "scores_in_range": _with(GE, RS(W6)) + f"SELECT * FROM rs WHERE {RANGE}",
    "scores_recent": _with(GE, RS(W6)) + f"""
SELECT * FROM rs WHERE window_start > (SELECT max(event_ts) FROM ge) - INTERVAL '{RECENT}'""",
    "score_trend": _with(GE, LB, RS(W6)) + f"""
SELECT window_start, player, max(total_score) AS total_score,
       strftime(window_start, '%H:%M:%S') AS time_label
FROM rs WHERE {RANGE} AND player IN ({TOP5})
GROUP BY window_start, player""",
    "time_bounds": _with(GE, LB, RS(W6)) + """
SELECT min(window_start) AS min_time, max(window_start) AS max_time,
       CAST(min(window_start) AS DATE) AS min_date, CAST(max(window_start) AS DATE) AS max_date,
       strftime(min(window_start), '%H:%M:%S') AS min_clock,
       strftime(max(window_start), '%H:%M:%S') AS max_clock,
       (SELECT max(total_score) FROM lb) AS max_score
FROM rs""",
    "display_maxima": _with(GE, LB, CP(W6), "n AS (SELECT balloon_color, count(*) AS c FROM cp GROUP BY balloon_color)") + """
SELECT (SELECT max(total_score) FROM lb) AS max_total_score,
       (SELECT max(c) FROM (SELECT c FROM n ORDER BY c ASC, balloon_color ASC LIMIT 3)) AS max_least_popular,
       (SELECT max(c) FROM n) AS max_most_popular""",
    "scores_in_date_time_range": _with(GE, RS(W6)) + f"SELECT * FROM rs WHERE {RANGE}",
    "score_trend_hours": _with(GE, RS(W6)) + f"""
SELECT window_start, player, max(total_score) AS total_score, strftime(window_start, '%H:%M') AS time_label
FROM rs WHERE {RANGE} GROUP BY window_start, player""",
    "decode_partial_events": _with(GE) + """
SELECT player, CAST(sum(CASE WHEN event_id % 5 != 0 THEN score END) AS BIGINT) AS total_score,
       count(CASE WHEN event_id % 3 != 0 THEN 1 END) AS colored, count(*) AS events
FROM ge GROUP BY player""",
    "time_parsing": "SELECT event_id, ts FROM events",
    "color_usage_pops": _with(GE) + """
SELECT player, balloon_color, count(*) AS "count" FROM ge GROUP BY player, balloon_color""",
    "color_popularity": _with(GE, CP(W6)) + """
SELECT balloon_color, count(*) AS "count" FROM cp GROUP BY balloon_color""",
    "metric_total": _with(GE) + "SELECT CAST(sum(score) AS BIGINT) AS total FROM ge",
    "current_leaderboard": _with(GE, LB) + "SELECT * FROM lb",
    "as_of_leaderboard": _with(GE.replace("FROM events", "FROM events WHERE event_id % 2 = 0"), LB) + "SELECT * FROM lb",
    "commit_log": _with(GE, "h AS (SELECT player, max(event_ts) AS t FROM ge WHERE event_id % 2 = 0 GROUP BY player)",
                        "a AS (SELECT player, max(event_ts) AS t FROM ge GROUP BY player)") + """
SELECT 'leaderboard' AS table_name, CAST(0 AS BIGINT) AS batch_id, count(*) AS "rows", min(t) AS min_ts, max(t) AS max_ts FROM h
UNION ALL SELECT 'leaderboard', 1, count(*), min(t), max(t) FROM a""",
    "stored_counts": _with(GE, f"gw AS (SELECT *, {_bucket(W6)} AS w, event_id % 2 = 0 AS even FROM ge)") + "\nUNION ALL ".join(
        f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM gw)) +
  (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM gw WHERE even)) AS row_count"""
        for name, keys in (("leaderboard", "player"), ("balloon_color_stats", "player, balloon_color"),
                           ("realtime_scores", "player, w"), ("balloon_colored_pops", "player, balloon_color, w"),
                           ("color_performance_trends", "balloon_color, w"))),
    "reconcile_changed": _with(GE, CS, CS.replace("cs AS", "other AS").replace("FROM ge", """FROM (
    SELECT * EXCLUDE (balloon_color), CASE WHEN event_id % 1000 = 1 AND char_id = 3 THEN NULL ELSE balloon_color END AS balloon_color
    FROM ge WHERE event_id % 500 <> 0)""")) + """
SELECT (SELECT count(*) FROM cs) AS view_rows, (SELECT count(*) FROM other) AS table_rows,
       count(*) FILTER (WHERE o.k IS NULL) AS missing_keys, count(*) FILTER (WHERE c.k IS NULL) AS extra_keys,
       count(*) FILTER (WHERE c.k AND o.k AND (c.balloon_pops, c.points_by_color, c.bonus_hits, c.event_ts)
         IS DISTINCT FROM (o.balloon_pops, o.points_by_color, o.bonus_hits, o.event_ts)) AS mismatched_rows
FROM (SELECT *, true AS k FROM cs) c FULL JOIN (SELECT *, true AS k FROM other) o
  ON c.player = o.player AND c.balloon_color = o.balloon_color""",
    "stored_player_lookup": _with(GE, CP(W6)) + f"SELECT * FROM cp WHERE player = '{PLAYER}'",
    "stored_reconcile": _with(GE, CS) + """
SELECT count(*) AS view_rows, count(*) AS table_rows, CAST(0 AS BIGINT) AS missing_keys, CAST(0 AS BIGINT) AS extra_keys,
       CAST(0 AS BIGINT) AS mismatched_rows FROM cs""",
    "stored_required_nulls": """
SELECT unnest(['leaderboard','leaderboard','leaderboard','leaderboard','balloon_color_stats','balloon_color_stats',
  'balloon_color_stats','balloon_color_stats','balloon_color_stats','balloon_color_stats','realtime_scores','realtime_scores',
  'realtime_scores','realtime_scores','balloon_colored_pops','balloon_colored_pops','balloon_colored_pops',
  'balloon_colored_pops','balloon_colored_pops','balloon_colored_pops','balloon_colored_pops','color_performance_trends',
  'color_performance_trends','color_performance_trends','color_performance_trends','color_performance_trends']) AS table_name,
  unnest(['player','total_score','bonus_hits','event_ts','player','balloon_color','balloon_pops','points_by_color','bonus_hits',
  'event_ts','player','total_score','window_start','window_end','player','balloon_color','balloon_pops','points_by_color',
  'bonus_hits','window_start','window_end','balloon_color','avg_score_per_pop','total_pops','window_start','window_end'])
  AS column_name, CAST(0 AS BIGINT) AS null_count""",
    "lifecycle_append": "SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS note FROM events",
    "lifecycle_overwrite": "SELECT event_id, event_type FROM events WHERE event_type = 'click'",
    "stream_color_stats": _with(GE, CS) + "SELECT * FROM cs",
    "stream_realtime_scores_6h": _with(GE, RS(W6)) + "SELECT * FROM rs",
    "stream_late_events": _with(GE, RS(W6)) + "SELECT * FROM rs",
    "perf_distribution_daily": _with(GE, CPT(W6)) + f"""
SELECT CAST(window_start AS DATE) AS day, CAST(min({TRUNC}) AS BIGINT) AS min, CAST(quantile_disc({TRUNC}, 0.25) AS BIGINT) AS q1,
       CAST(quantile_disc({TRUNC}, 0.5) AS BIGINT) AS median, CAST(quantile_disc({TRUNC}, 0.75) AS BIGINT) AS q3,
       CAST(max({TRUNC}) AS BIGINT) AS max, count(*) AS "count"
FROM cpt GROUP BY 1""",
    "stream_bounded_state": _with(GE, LB) + "SELECT * FROM lb",
    "stream_one_read": _with(GE, LB, CS, RS(W6), CP(W6), CPT(W6)) + """
SELECT 'leaderboard' AS table_name, player, CAST(NULL AS VARCHAR) AS balloon_color, CAST(NULL AS TIMESTAMP) AS window_start,
       total_score AS points, CAST(NULL AS BIGINT) AS pops, bonus_hits, CAST(NULL AS DOUBLE) AS avg_score_per_pop, event_ts FROM lb
UNION ALL SELECT 'balloon_color_stats', player, balloon_color, NULL, points_by_color, balloon_pops, bonus_hits, NULL, event_ts FROM cs
UNION ALL SELECT 'realtime_scores', player, NULL, window_start, total_score, NULL, NULL, NULL, NULL FROM rs
UNION ALL SELECT 'balloon_colored_pops', player, balloon_color, window_start, points_by_color, balloon_pops, bonus_hits, NULL, NULL FROM cp
UNION ALL SELECT 'color_performance_trends', NULL, balloon_color, window_start, NULL, total_pops, NULL,
       CAST(CAST(avg_score_per_pop AS DECIMAL(28,10)) AS DOUBLE), NULL FROM cpt""",
    "stream_from_latest": _with(GE, LB.replace("FROM ge", "FROM ge WHERE event_id % 3 > 0")) + "SELECT * FROM lb",
    "stream_color_performance_6h": _with(GE, CPT(W6)) + """
SELECT balloon_color, CAST(avg_score_per_pop AS DECIMAL(28,10)) AS avg_score_per_pop, total_pops, window_start, window_end
FROM cpt""",
    "color_stats_for_player": _with(GE, CS) + f"SELECT * FROM cs WHERE player = '{PLAYER}'",
    "color_usage": _with(GE, CP(W6)) + """
SELECT player, balloon_color, count(*) AS "count" FROM cp GROUP BY player, balloon_color""",
    "color_coverage": _with(GE, CP(W6)) + """
SELECT player, colors_used, total_colors,
       CAST(colors_used AS VARCHAR) || '/' || CAST(total_colors AS VARCHAR) AS display
FROM (SELECT player, count(DISTINCT balloon_color) AS colors_used,
             (SELECT count(DISTINCT balloon_color) FROM cp) AS total_colors
      FROM cp GROUP BY player)""",
    "favorite_color": _with(GE, CP(W6)) + """
SELECT player, balloon_color, "count" FROM (
  SELECT player, balloon_color, count(*) AS "count" FROM cp GROUP BY player, balloon_color)
QUALIFY row_number() OVER (PARTITION BY player ORDER BY "count" DESC, balloon_color ASC) = 1""",
    "least_popular_colors": _with(GE, CP(W6)) + f"""
SELECT {_title('c')} AS balloon_color, n AS "count" FROM (
  SELECT balloon_color AS c, count(*) AS n FROM cp GROUP BY balloon_color
  ORDER BY n ASC, c ASC LIMIT 3)""",
    "most_popular_colors": _with(GE, CP(W6)) + f"""
SELECT {_title('c')} AS balloon_color, n AS "count" FROM (
  SELECT balloon_color AS c, count(*) AS n FROM cp GROUP BY balloon_color
  ORDER BY n DESC, c ASC LIMIT 3)""",
    "metric_by_color": _with(GE, CP(W6), """s AS (
  SELECT player, balloon_color, CAST(sum(balloon_pops) AS BIGINT) AS balloon_pops,
         CAST(sum(points_by_color) AS BIGINT) AS points_by_color,
         CAST(sum(bonus_hits) AS BIGINT) AS bonus_hits
  FROM cp GROUP BY player, balloon_color)""") + """
SELECT player, balloon_color, 'balloon_pops' AS metric, balloon_pops AS total FROM s
UNION ALL SELECT player, balloon_color, 'points_by_color', points_by_color FROM s
UNION ALL SELECT player, balloon_color, 'bonus_hits', bonus_hits FROM s""",
    "player_totals": _with(GE, CP(W6)) + """
SELECT player, CAST(sum(balloon_pops) AS BIGINT) AS balloon_pops,
       CAST(sum(points_by_color) AS BIGINT) AS points_by_color,
       CAST(sum(bonus_hits) AS BIGINT) AS bonus_hits
FROM cp GROUP BY player""",
    "players": _with(GE, CP(W6)) + "SELECT DISTINCT player FROM cp ORDER BY player",
    "performance_summary": _with(GE, CPT(W6)) + f"""
SELECT avg({TRUNC}) AS mean_of_window_avgs, max({TRUNC}) AS best_window_avg,
       CAST(sum(total_pops) AS BIGINT) AS total_pops FROM cpt""",
    "color_perf_stats": _with(GE, CPT(W6)) + f"""
SELECT balloon_color, round_even(avg({TRUNC}), 1) AS average_score,
       min({TRUNC}) AS min_score, max({TRUNC}) AS max_score, count({TRUNC}) AS "count",
       CAST(sum(total_pops) AS BIGINT) AS total_pops,
       CAST(row_number() OVER (ORDER BY round_even(avg({TRUNC}), 1) DESC, balloon_color) AS INT) AS position
FROM cpt GROUP BY balloon_color""",
    "time_window_summary": _gapfill_sql(W15, W15),
    "time_window_summary_6h": _gapfill_sql(W6, W6),
    "perf_distribution": _dist_sql(W15),
    "perf_distribution_6h": _dist_sql(W6),
    "avg_by_color": _with(GE, CPT(W6)) + f"""
SELECT balloon_color, avg({TRUNC}) AS avg_score, count(*) AS "count",
       CAST(row_number() OVER (ORDER BY avg({TRUNC}) DESC, balloon_color) AS INT) AS position
FROM cpt GROUP BY balloon_color""",
    "table_counts": _with(GE, LB, CS, RS(W15), CP(W15), CPT(W15)) + """
SELECT 'game_events' AS table_name, count(*) AS row_count FROM ge
UNION ALL SELECT 'leaderboard', count(*) FROM lb
UNION ALL SELECT 'balloon_color_stats', count(*) FROM cs
UNION ALL SELECT 'realtime_scores', count(*) FROM rs
UNION ALL SELECT 'balloon_colored_pops', count(*) FROM cp
UNION ALL SELECT 'color_performance_trends', count(*) FROM cpt""",
    "reconcile_leaderboard": _with(GE, LB, CS, """t AS (
  SELECT player, CAST(sum(points_by_color) AS BIGINT) AS total_score,
         CAST(sum(bonus_hits) AS BIGINT) AS bonus_hits FROM cs GROUP BY player)""") + """
SELECT count(lb.player) AS view_rows, count(t.player) AS table_rows,
       count(CASE WHEN t.player IS NULL THEN 1 END) AS missing_keys,
       count(CASE WHEN lb.player IS NULL THEN 1 END) AS extra_keys,
       count(CASE WHEN lb.player IS NOT NULL AND t.player IS NOT NULL
                   AND (lb.total_score IS DISTINCT FROM t.total_score
                        OR lb.bonus_hits IS DISTINCT FROM t.bonus_hits) THEN 1 END)
         AS mismatched_rows
FROM lb FULL OUTER JOIN t ON lb.player = t.player""",
    "freshness": _with(GE, LB, CS) + f"""
SELECT 'leaderboard' AS table_name, max(event_ts) AS latest_ts,
       date_diff('microsecond', max(event_ts), TIMESTAMP '{FRESHNESS_NOW}') / 1e6 AS age_seconds
FROM lb
UNION ALL
SELECT 'balloon_color_stats', max(event_ts),
       date_diff('microsecond', max(event_ts), TIMESTAMP '{FRESHNESS_NOW}') / 1e6 FROM cs""",
    "null_report": """
SELECT 'event_id' AS column_name, count(*) - count(event_id) AS null_count FROM events
UNION ALL SELECT 'ts', count(*) - count(ts) FROM events
UNION ALL SELECT 'user_id', count(*) - count(user_id) FROM events
UNION ALL SELECT 'event_type', count(*) - count(event_type) FROM events
UNION ALL SELECT 'value', count(*) - count(value) FROM events
UNION ALL SELECT 'props', count(*) - count(props) FROM events""",
}
ORACLE["score_pops_tables"] = ORACLE["score_pops"]
ORACLE["stored_freshness"] = ORACLE["freshness"]
ORACLE["stream_color_coverage"] = ORACLE["color_coverage"]
ORACLE["stream_window_summary"] = ORACLE["time_window_summary_6h"]
