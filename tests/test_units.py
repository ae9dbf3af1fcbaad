"""t0: operators on hand-made rows (edge cases the test data lacks)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from popflow.operators import colors, leaderboard as lbp, performance as perf, quality, views
from popflow.operators.ranking import global_rank, latest_by_key, top_k
from popflow.operators.scoring import config_tables, score_pops, score_pops_with_tables
from popflow.schemas import TABLE_SCHEMAS
from popflow.sources.events import decode_events, encode_events

EV = "player string, balloon_color string, score int, favorite_color_bonus boolean, event_ts timestamp"


def ts(s):
    return dt.datetime.fromisoformat(s)


def events(spark, rows):
    return spark.createDataFrame(rows, EV)


# -- scoring -------------------------------------------------------------------

GOLDEN = [
    ("Tom", "blue", 150, True),
    ("Mickey", "blue", 75, False),
    ("Mickey", "black", 0, True),
    ("Jerry", "black", 0, False),
    ("Nobody", "red", 100, False),
    ("Patrick", "pink", 110, True),
    ("Jerry", "pink", 55, False),      # sample event: pink, no bonus
    ("Sonic", "blue", 150, True),      # sample event: blue 75 x 2
    ("Tom", None, 0, False),
]


def test_score_pops_golden(spark):
    pops = spark.createDataFrame([(c, col) for c, col, _, _ in GOLDEN],
                                 "character string, balloon_color string")
    got = [(r.character, r.balloon_color, r.score, r.favorite_color_bonus)
           for r in score_pops(pops).collect()]
    assert got == GOLDEN


def test_score_pops_with_tables_matches_literals(spark):
    pops = spark.createDataFrame([(c, col) for c, col, _, _ in GOLDEN],
                                 "character string, balloon_color string")
    colors_df, favs = config_tables(spark)
    a = sorted(score_pops(pops).collect(), key=str)
    b = sorted(score_pops_with_tables(pops, colors_df, favs).collect(), key=str)
    assert a == b


# -- views ---------------------------------------------------------------------

def test_views_window_edges_nulls_and_black(spark):
    df = events(spark, [
        ("p1", "red", 100, False, ts("2024-01-01 00:00:14.999999")),
        ("p1", "red", 100, True, ts("2024-01-01 00:00:15")),      # next window
        ("p1", "black", 0, None, ts("2024-01-01 00:00:16")),       # NULL bonus
        ("p1", None, 10, False, ts("2024-01-01 00:00:17")),        # NULL colour
        ("p2", "blue", 75, True, None),                            # NULL ts
    ])
    lb = {r.player: r for r in views.leaderboard(df).collect()}
    assert lb["p1"].total_score == 210 and lb["p1"].bonus_hits == 1
    assert lb["p2"].total_score == 75 and lb["p2"].event_ts is None
    rs = sorted((r.player, r.window_start, r.total_score)
                for r in views.realtime_scores(df).collect())
    # NULL timestamps do not belong to any window
    assert rs == [("p1", ts("2024-01-01 00:00:00"), 100), ("p1", ts("2024-01-01 00:00:15"), 110)]
    cp = {(r.balloon_color, r.window_start): r for r in views.colored_pops(df).collect()}
    assert cp[(None, ts("2024-01-01 00:00:15"))].balloon_pops == 1
    assert cp[("black", ts("2024-01-01 00:00:15"))].bonus_hits == 0
    cpt = {(r.balloon_color, r.window_start): r for r in views.color_performance(df).collect()}
    assert cpt[("red", ts("2024-01-01 00:00:00"))].avg_score_per_pop == 100.0
    out = views.to_table_types("color_performance_trends", views.color_performance(df))
    assert out.schema["avg_score_per_pop"].dataType.simpleString() == "decimal(28,10)"
    assert out.columns == [f.name for f in TABLE_SCHEMAS["color_performance_trends"]]


def test_require_rows_empty(spark):
    empty = events(spark, [])
    with pytest.raises(ValueError):
        lbp.require_rows(empty)
    assert views.leaderboard(empty).count() == 0


# -- ordering ------------------------------------------------------------------

def test_latest_by_key_and_scoreboard(spark):
    lb = spark.createDataFrame([
        ("a", 10, 1, ts("2024-01-01 00:00:01"), 0),
        ("a", 30, 2, ts("2024-01-01 00:00:05"), 1),
        ("a", 25, 2, ts("2024-01-01 00:00:05"), 2),   # same ts, lower total: older
        ("b", 5, 0, ts("2024-01-01 00:00:02"), 0),
        ("b", 7, 1, ts("2024-01-01 00:00:02"), 3),
    ], "player string, total_score long, bonus_hits long, event_ts timestamp, batch_id long")
    sb = {r.player: (r.total_score, r.bonus_hits) for r in lbp.scoreboard(lb).collect()}
    assert sb == {"a": (30, 2), "b": (7, 1)}
    cur = latest_by_key(lb, ["player"], ["batch_id"]).collect()
    assert {r.player: r.total_score for r in cur} == {"a": 25, "b": 7}


def test_global_rank_matches_sort(spark):
    rnd = random.Random(7)
    rows = [(f"p{i:04d}", rnd.randint(0, 50), rnd.randint(0, 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "player string, total_score long, bonus_hits long") \
        .repartition(7)
    ranked = lbp.leaderboard_sorted(df).collect()
    expect = sorted(rows, key=lambda r: (-r[1], -r[2], r[0]))
    got = sorted(ranked, key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, len(rows) + 1))
    assert [(r.player, r.total_score, r.bonus_hits) for r in got] == expect


def test_global_rank_hot_score_is_split(spark):
    # a third of all rows share one (score, bonus): the unique player column
    # in the order still lets range bounds split them over several tasks
    rnd = random.Random(11)
    rows = [(f"p{i:05d}", 42 if i % 3 == 0 else rnd.randint(0, 1000), 1) for i in range(6000)]
    df = spark.createDataFrame(rows, "player string, total_score long, bonus_hits long") \
        .repartition(5)
    ranked = global_rank(df, lbp.LEADERBOARD_ORDER, num_partitions=8)
    got = sorted(ranked.collect(), key=lambda r: r.position)
    expect = sorted(rows, key=lambda r: (-r[1], -r[2], r[0]))
    assert [(r.player, r.total_score, r.bonus_hits) for r in got] == expect
    assert [r.position for r in got] == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_global_rank_with_payload_and_without_exchange_reuse(spark, reuse):
    n = 400_000
    df = spark.range(n).select(
        F.format_string("p%07d", "id").alias("player"),
        F.when(F.col("id") % 3 == 0, 42).otherwise(F.xxhash64("id") % 1000).cast("long").alias("total_score"),
        (F.col("id") % 4).alias("bonus_hits"), F.repeat(F.lit("x"), 20).alias("payload")).repartition(7)
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = global_rank(df, lbp.LEADERBOARD_ORDER).toPandas().sort_values("position")
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    assert got["position"].tolist() == list(range(1, n + 1))
    want = got.sort_values(["total_score", "bonus_hits", "player"], ascending=[False, False, True])
    assert want["position"].tolist() == list(range(1, n + 1))


def test_top_k_ties_deterministic(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)],
                               "player string, total_score long")
    got = [r.player for r in top_k(df, 2, [F.desc("total_score"), F.asc("player")]).collect()]
    assert got == ["c", "a"]


# -- colours -------------------------------------------------------------------

CP = ("player string, balloon_color string, balloon_pops long, points_by_color long, "
      "bonus_hits long, window_start timestamp, window_end timestamp")


def test_colour_page(spark):
    w0, w1, w2 = ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:15"), ts("2024-01-01 00:00:30")
    cp = spark.createDataFrame([
        ("a", "red", 3, 300, 1, w0, w1),
        ("a", "blue", 1, 75, 0, w0, w1),
        ("a", "blue", 1, 75, 1, w1, w2),
        ("a", "red", 1, 100, 0, w1, w2),
        ("b", "gold", 2, 180, 0, w0, w1),
    ], CP)
    fav = {r.player: (r.balloon_color, r["count"]) for r in colors.favorite_color(cp).collect()}
    assert fav == {"a": ("blue", 2), "b": ("gold", 1)}          # tie -> name asc
    fav_pops = {r.player: r.balloon_color
                for r in colors.favorite_color(cp, weight="pops").collect()}
    assert fav_pops["a"] == "red"
    cov = {r.player: (r.colors_used, r.total_colors, r.display)
           for r in colors.color_coverage(cp).collect()}
    assert cov == {"a": (2, 3, "2/3"), "b": (1, 3, "1/3")}
    least = [(r.balloon_color, r["count"]) for r in colors.least_popular_colors(cp).collect()]
    assert least == [("Gold", 1), ("Blue", 2), ("Red", 2)]
    most = [(r.balloon_color, r["count"]) for r in colors.most_popular_colors(cp).collect()]
    assert most == [("Blue", 2), ("Red", 2), ("Gold", 1)]
    m = {(r.player, r.balloon_color, r.metric): r.total
         for r in colors.metric_by_color(cp, "a").collect()}
    assert m[("a", "red", "points_by_color")] == 400 and len(m) == 6
    tot = colors.player_totals(cp, "a").collect()[0]
    assert (tot.balloon_pops, tot.points_by_color, tot.bonus_hits) == (6, 550, 2)
    assert [r.player for r in colors.players(cp).collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        colors.metric_by_color(cp, metrics=["nope"])


# -- performance ------------------------------------------------------------------

CPT = ("balloon_color string, avg_score_per_pop double, total_pops long, "
       "window_start timestamp, window_end timestamp")


def test_perf_stats_half_even_and_truncation(spark):
    w = ts("2024-01-01 00:00:00")
    cpt = spark.createDataFrame([
        ("red", 2.9, 1, w, w), ("red", 2.0, 2, w, w), ("red", 2.5, 1, w, w), ("red", 3.1, 1, w, w),
    ], CPT)
    r = perf.color_perf_stats(cpt).collect()[0]
    # truncated values 2,2,2,3 -> mean 2.25 -> half-even 2.2 (half-up would be 2.3)
    assert (r.average_score, r.min_score, r.max_score, r["count"], r.total_pops) == \
        (2.2, 2, 3, 4, 5)
    exact = perf.color_perf_stats(cpt, truncate=False).collect()[0]
    assert exact.average_score == 2.6


def test_time_window_summary_gap_fill(spark):
    cpt = spark.createDataFrame([
        ("red", 100.0, 2, ts("2024-01-01 00:00:00"), None),
        ("blue", 50.0, 1, ts("2024-01-01 00:00:00"), None),
        ("red", 80.0, 4, ts("2024-01-01 00:01:00"), None),
    ], CPT)
    rows = sorted(perf.time_window_summary(cpt, "15 seconds").collect())
    assert [r.window_start for r in rows] == [
        ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:15"), ts("2024-01-01 00:00:30"),
        ts("2024-01-01 00:00:45"), ts("2024-01-01 00:01:00")]
    assert (rows[0].mean_score, rows[0].n_colors, rows[0].total_pops) == (75.0, 2, 3)
    assert (rows[1].mean_score, rows[1].min_score, rows[1].n_colors, rows[1].total_pops) == \
        (None, None, 0, 0)


def test_time_window_summary_many_chunks(spark):
    # a range spanning several generation chunks stays contiguous and complete
    n = perf.BIN_CHUNK * 3 + 17
    start = ts("2024-01-01 00:00:00")
    cpt = spark.createDataFrame([
        ("red", 1.0, 1, start, None),
        ("red", 2.0, 1, start + dt.timedelta(seconds=(n - 1)), None),
    ], CPT)
    out = perf.time_window_summary(cpt, "1 second")
    agg = out.agg(F.count("*"), F.min("window_start"), F.max("window_start"),
                  F.sum("total_pops")).collect()[0]
    assert tuple(agg) == (n, start, start + dt.timedelta(seconds=n - 1), 2)


def test_perf_distribution_quartiles(spark):
    w = ts("2024-01-01 00:00:00")
    cpt = spark.createDataFrame([(c, float(v), 1, w, w) for c, v in
                                 [("a", 1), ("b", 2), ("c", 3), ("d", 4)]], CPT)
    r = perf.perf_distribution(cpt).collect()[0]
    assert (r["min"], r.q1, r.median, r.q3, r["max"]) == (1, 1.75, 2.5, 3.25, 4)
    approx = perf.perf_distribution(cpt, exact=False).collect()[0]
    assert approx["min"] == 1 and approx["max"] == 4


def test_performance_summary(spark):
    w = ts("2024-01-01 00:00:00")
    cpt = spark.createDataFrame([("a", 10.9, 2, w, w), ("b", 20.0, 3, w, w)], CPT)
    r = perf.performance_summary(cpt).collect()[0]
    assert (r.mean_of_window_avgs, r.best_window_avg, r.total_pops) == (15.0, 20, 5)


# -- filters ---------------------------------------------------------------------

def test_time_filters(spark):
    rs = spark.createDataFrame([
        ("a", 1, ts("2024-01-10 00:00:00")), ("a", 2, ts("2024-01-15 00:00:00")),
        ("a", 3, ts("2024-01-15 00:00:01")), ("b", 4, ts("2024-01-09 23:59:59")),
    ], "player string, total_score long, window_start timestamp")
    got = sorted(r.total_score for r in
                 lbp.in_time_range(rs, "2024-01-10T00:00:00Z", "2024-01-15 00:00:00").collect())
    assert got == [1, 2]
    got = sorted(r.total_score for r in lbp.in_date_time_range(
        rs, dt.date(2024, 1, 10), dt.time(0, 0), dt.date(2024, 1, 15), dt.time(0, 0)).collect())
    assert got == [1, 2]
    recent = lbp.since(rs, "1 day", now="2024-01-16 00:00:00").collect()
    assert sorted(r.total_score for r in recent) == [3]   # strict: > now - 1 day
    assert lbp.for_players(rs, ["b"]).count() == 1
    assert lbp.for_players(rs, spark.createDataFrame([("b",)], "p string")).count() == 1
    tr = lbp.score_trend(rs, ["a"], unit="hours").collect()
    assert {r.time_label for r in tr} == {"00:00"}
    lb = spark.createDataFrame([("a", 6), ("b", 4)], "player string, total_score long").withColumn(
        "event_ts", F.current_timestamp())
    tb = lbp.time_bounds(rs, lb).collect()[0]
    assert (tb.min_date, tb.max_clock, tb.max_score) == (dt.date(2024, 1, 9), "00:00:01", 6)


# -- JSON ---------------------------------------------------------------------------

def test_decode_rejects_and_roundtrip(spark):
    payloads = spark.createDataFrame([
        ('{"player":"Cosmic Phoenix","balloon_color":"pink","score":55,'
         '"favorite_color_bonus":false,"event_ts":"2025-02-17T13:59:00.430087Z"}',),
        ('{"player":"Cosmic Phoenix","balloon_color":"blue","score":150,'
         '"favorite_color_bonus":true,"event_ts":"2025-02-17T13:59:04.453717Z"}',),
        ('{not json',),
        ('{"player":"x","balloon_color":"red","event_ts":"2025-02-17T13:59:04Z"}',),
    ], "value string")
    dec = decode_events(payloads)
    ok = dec.events.collect()
    assert [r.score for r in ok] == [55, 150, None]    # an absent field is NULL, not a reject
    assert ok[0].page_id is None
    assert ok[0].event_ts == dt.datetime(2025, 2, 17, 13, 59, 0, 430087)
    rej = {r.reason for r in dec.rejects.collect()}
    assert rej == {"malformed"}
    strict = decode_events(payloads, required=("player", "score"))
    assert {r.reason for r in strict.rejects.collect()} == {"malformed", "score"}
    from popflow.operators.views import leaderboard
    assert {r.player: r.total_score for r in leaderboard(dec.events).collect()} == {"Cosmic Phoenix": 205, "x": None}
    again = decode_events(encode_events(dec.events)).events.collect()
    assert again == ok


# -- quality ----------------------------------------------------------------------------

def test_quality_checks(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("z", None)], "player string, v long")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("w", 0)], "player string, v long")
    r = quality.reconcile(a, b, ["player"], ["v"]).collect()[0]
    assert (r.view_rows, r.table_rows, r.missing_keys, r.extra_keys, r.mismatched_rows) == \
        (3, 3, 1, 1, 1)
    nr = {x.column_name: x.null_count for x in quality.null_report(a).collect()}
    assert nr == {"player": 0, "v": 1}
    tc = {x.table_name: x.row_count for x in quality.table_counts({"a": a, "b": b}).collect()}
    assert tc == {"a": 3, "b": 3}
    t = spark.createDataFrame([(ts("2024-01-31 23:59:00"),)], "event_ts timestamp")
    f = quality.freshness({"t": (t, "event_ts")}, now="2024-02-01 00:00:00").collect()[0]
    assert f.age_seconds == 60.0
    assert quality.schema_diff(a, a) == []
    diff = quality.schema_diff(a, b.withColumn("extra", F.lit(1)))
    assert diff == [{"column": "extra", "issue": "missing", "expected": "int"}]
    assert quality.sample(a, 2).count() == 2
    req = quality.required_violations(a.withColumnRenamed("v", "total_score"),
                                      TABLE_SCHEMAS["leaderboard"]).collect()
    assert {x.column_name: x.null_count for x in req} == {"player": 0, "total_score": 1}


def test_trend_and_bounds_on_changelog_equal_current(spark):
    # windows updated over several batches: totals only grow (scores >= 0)
    w0, w1 = ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:15")
    e0, e1 = ts("2024-01-01 00:00:15"), ts("2024-01-01 00:00:30")
    log = spark.createDataFrame([
        ("a", 10, w0, e0, 0), ("a", 25, w0, e0, 1), ("a", 40, w0, e0, 3),
        ("b", 5, w0, e0, 0), ("b", 5, w1, e1, 2), ("b", 90, w1, e1, 3),
        ("a", 0, w1, e1, 2),
    ], "player string, total_score long, window_start timestamp, window_end timestamp, "
       "batch_id long")
    cur = latest_by_key(log, ["player", "window_start", "window_end"], ["batch_id"])
    assert cur.count() == 4 and log.count() == 7
    trend = lambda df: sorted(tuple(r) for r in lbp.score_trend(df, ["a", "b"]).collect())
    assert trend(log) == trend(cur)
    lb = cur.groupBy("player").agg(F.sum("total_score").alias("total_score")).withColumn(
        "event_ts", F.lit("2024-01-01").cast("timestamp"))
    assert lbp.time_bounds(log, lb).collect() == lbp.time_bounds(cur, lb).collect()


def test_utc_helpers_ignore_session_zone(spark):
    from popflow.functions.expressions import utc_instant, utc_wall_clock

    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, 5, 59, 59, 123456),)],
                               "t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = df.select(F.unix_micros(utc_instant("t")).alias("us"),
                          utc_wall_clock(utc_instant("t")).alias("back")).first()
            assert r.us == 1704866399123456           # 2024-01-10T05:59:59.123456Z
            assert r.back == dt.datetime(2024, 1, 10, 5, 59, 59, 123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_bounds_read_as_utc_in_any_session_zone(spark):
    from popflow.functions.expressions import utc_instant

    ntz = spark.createDataFrame([(dt.datetime(2024, 1, 10, 0, 0),), (dt.datetime(2024, 1, 10, 8, 0),)],
                                "window_start timestamp_ntz")
    ltz = ntz.select(utc_instant("window_start").alias("window_start"))   # 00:00Z, 08:00Z
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        for df in (ntz, ltz):
            got = lbp.in_time_range(df, "2024-01-10 00:00:00", "2024-01-10 01:00:00")
            assert got.count() == 1
            assert lbp.in_time_range(df, "2024-01-10 07:00:00", "2024-01-10 09:00:00").count() == 1
            assert lbp.since(df, "1 hour", now="2024-01-10 08:30:00").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_to_utc_reads_a_zone(spark):
    """Summer and winter time, a half-hour zone; the session's zone plays no part."""
    from popflow.functions.expressions import to_utc

    rows = [("2024-01-10 00:30:00",), ("2024-07-10 00:30:00",), (None,)]
    df = spark.createDataFrame(rows, "s string").withColumn("t", F.col("s").cast("timestamp_ntz"))
    want = {"America/New_York": ["2024-01-10 05:30:00", "2024-07-10 04:30:00", None],
            "Asia/Kolkata": ["2024-01-09 19:00:00", "2024-07-09 19:00:00", None], "UTC": [r[0] for r in rows]}
    before = spark.conf.get("spark.sql.session.timeZone")
    for session in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", session)
        try:
            for zone, times in want.items():
                assert [r.u for r in df.select(to_utc("t", zone).cast("string").alias("u")).collect()] == times
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
    windows = df.where("t is not null").select(F.col("t").alias("window_start"))
    assert lbp.in_date_time_range(windows, "2024-01-09", "19:30:00", "2024-01-09", "19:30:00", tz="America/New_York").count() == 1
    assert lbp.in_date_time_range(windows, "2024-01-10", "00:00:00", "2024-01-10", "01:00:00").count() == 1


def test_window_summary_bounds_and_range(spark):
    from popflow.operators import views

    ev = spark.createDataFrame([("a", "red", 10, ts("2024-01-01 00:00:07")), ("a", "red", 20, ts("2024-01-01 00:02:01"))],
                               "player string, balloon_color string, score int, event_ts timestamp")
    cpt = views.color_performance(ev, "15 seconds")
    full = sorted(tuple(r) for r in perf.time_window_summary(cpt, "15 seconds").collect())
    assert len(full) == 9
    bounds = views.window_bounds(ev, "15 seconds")
    assert sorted(tuple(r) for r in perf.time_window_summary(cpt, "15 seconds", bounds=bounds).collect()) == full
    part = perf.time_window_summary(cpt, "15 seconds", start="2024-01-01 00:01:00", end="2024-01-01 00:01:45").collect()
    assert len(part) == 4 and not any(r.total_pops for r in part)
