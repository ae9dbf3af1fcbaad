"""t3 stream = batch, t4 restart / replay (sf0.001 events replayed as JSON)."""

import pytest
from pyspark.sql import functions as F

from popflow.operators import views
from popflow.sources.events import StreamConfig, encode_events, game_events, read_events_stream
from popflow.sources.tables import LAYOUTS, TableStore
from popflow.streaming.pipeline import await_all, changelog_writer, list_pipeline, start_views
from tests.conftest import SF001

N_FILES = 6


def _events(spark):
    return game_events(spark, SF001).select(
        "player", "balloon_color", "score", "favorite_color_bonus",
        F.col("event_ts").cast("timestamp").alias("event_ts"))


def _write_files(spark, path, files):
    """Write the events as JSON lines, split into N_FILES random parts, rows
    in random order; only the parts listed in ``files`` are written."""
    ev = _events(spark).withColumn("_part", (F.rand(11) * N_FILES).cast("int"))
    for p in files:
        part = ev.where(F.col("_part") == p).drop("_part").orderBy(F.rand(p))
        encode_events(part, key_col=None).coalesce(1).write.mode("overwrite").text(
            f"{path}/part={p}")


def _batch_view(name, ev):
    fn = views.VIEWS[name]
    return views.to_table_types(name, fn(ev))


def _current(store, name):
    return store.read_table(name, "current").drop(LAYOUTS[name].time_part)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _run(spark, src, store, ck, names=None):
    stream = read_events_stream(spark, StreamConfig(format="json", path=f"{src}/*",
                                                    max_files_per_trigger=1))
    qs = start_views(stream.events, store, checkpoint_root=ck, names=names,
                     trigger={"availableNow": True})
    await_all(qs, 600)
    return qs


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stream")
    src, ck = str(base / "src"), str(base / "ck")
    store = TableStore(spark, "stream_t3", location=str(base / "wh"))
    _write_files(spark, src, range(N_FILES))
    _run(spark, src, store, ck)
    return store


@pytest.mark.parametrize("name", list(views.VIEWS))
def test_stream_equals_batch(spark, replay, name):
    expect = _rows(_batch_view(name, _events(spark)))
    got = _rows(_current(replay, name))
    assert got == expect
    log = replay.read_table(name, "changelog")
    assert log.select("batch_id").distinct().count() == N_FILES
    assert log.count() >= len(expect)


def test_commit_log_and_as_of(spark, replay):
    cl = replay.commit_log("leaderboard").orderBy("batch_id").collect()
    assert [r.batch_id for r in cl] == list(range(N_FILES))
    first = replay.read_table("leaderboard", "current", as_of_batch=0)
    assert first.count() == cl[0].rows
    assert replay.read_table("leaderboard", "current", as_of_batch=N_FILES - 1).count() == \
        replay.read_table("leaderboard").count()


def test_list_pipeline(spark, replay):
    info = list_pipeline(spark, replay)
    assert set(info["tables"]) == set(views.VIEWS)


def test_restart_and_batch_replay(spark, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    store = TableStore(spark, "stream_t4", location=str(tmp_path / "wh"))
    _write_files(spark, src, range(3))
    _run(spark, src, store, ck)
    n_first = store.read_table("leaderboard", "changelog").count()
    # more data arrives; the restarted queries resume from their checkpoints
    _write_files(spark, src, range(3, N_FILES))
    _run(spark, src, store, ck)
    for name in views.VIEWS:
        assert _rows(_current(store, name)) == _rows(_batch_view(name, _events(spark)))
        batches = store.read_table(name, "changelog").select("batch_id").distinct().count()
        assert batches == N_FILES
    assert store.read_table("leaderboard", "changelog").count() > n_first
    # a micro-batch retried after a crash rewrites its own partition: no duplicates
    log = store.read_table("leaderboard", "changelog")
    before = log.count()
    batch2 = log.where("batch_id = 2").drop("batch_id", "event_day")
    rows = batch2.collect()
    replayed = spark.createDataFrame(rows, batch2.schema)
    changelog_writer(store, "leaderboard")(replayed, 2)
    assert store.read_table("leaderboard", "changelog").count() == before


def test_compaction_keeps_state(spark, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    store = TableStore(spark, "stream_compact", location=str(tmp_path / "wh"))
    _write_files(spark, src, range(N_FILES))
    _run(spark, src, store, ck, names=["leaderboard", "realtime_scores"])
    for name in ("leaderboard", "realtime_scores"):
        cur = _rows(_current(store, name))
        at3 = _rows(store.read_table(name, "current", as_of_batch=3))
        log_before = store.read_table(name, "changelog").count()
        assert store.compact(name, 3) == 3
        if name == "leaderboard":
            assert store.batches(name) == [3, 4, 5]
        else:  # hours that one batch wrote stay in it, no hour is left in two of the folded batches
            hours = [p["window_hour"] for p in store.partitions(name) if int(p["batch_id"]) <= 3]
            assert store.batches(name) == list(range(N_FILES)) and len(hours) == len(set(hours))
        assert _rows(_current(store, name)) == cur
        assert _rows(store.read_table(name, "current", as_of_batch=3)) == at3
        log_after = store.read_table(name, "changelog").count()
        # 15 s windows hold ~1 event each here, so only the leaderboard has
        # superseded rows to fold away
        assert log_after < log_before if name == "leaderboard" else log_after <= log_before
        # compaction is idempotent
        assert store.compact(name, 3) == 0
        assert _rows(_current(store, name)) == cur


def test_dashboard_pages_on_stored_tables(spark, replay):
    from popflow.plans.pages import Dashboard
    from popflow.operators import leaderboard as lbp

    dash = Dashboard(replay)
    p1 = dash.leaderboard_page()
    expect = lbp.scoreboard_top(views.leaderboard(_events(spark)), 5).collect()
    assert p1["scoreboard"].collect() == expect
    assert p1["trend"].count() > 0
    # trend and bounds read the changelog; equal to computing them on current state
    cur = replay.read_table("realtime_scores", "current")
    assert _rows(p1["trend"]) == _rows(lbp.score_trend(cur, lbp.top_players(
        replay.read_table("leaderboard"), 5)))
    assert _rows(p1["bounds"]) == _rows(lbp.time_bounds(cur, replay.read_table("leaderboard")))
    p2 = dash.color_page("player_1", "points_by_color")
    assert p2["totals"].count() == 1 and p2["by_metric"].count() > 0
    p3 = dash.performance_page()
    assert p3["summary"].collect()[0].total_pops == _events(spark).count()


def test_sink_compaction_policy(spark, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    store = TableStore(spark, "stream_autocompact", location=str(tmp_path / "wh"))
    _write_files(spark, src, range(N_FILES))
    names = ["leaderboard", "realtime_scores"]
    stream = read_events_stream(spark, StreamConfig(format="json", path=f"{src}/*",
                                                    max_files_per_trigger=1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    qs = start_views(stream.events, store, checkpoint_root=ck, names=names,
                     trigger={"availableNow": True}, compact_every=2, state_partitions=3)
    await_all(qs, 600)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    for q in qs.values():
        assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    for name in names:
        # batches 0-1 were folded into 1 at batch 2, then 1-3 into 3 at batch 4;
        # of the windowed table the hours that only one of them wrote stay there
        if name == "leaderboard":
            assert store.batches(name) == [3, 4, 5]
        hours = [p[LAYOUTS[name].time_part] for p in store.partitions(name) if int(p["batch_id"]) <= 3]
        assert name == "leaderboard" or len(hours) == len(set(hours))
        assert _rows(_current(store, name)) == _rows(_batch_view(name, _events(spark)))
    store.drop_namespace()


def test_ingest_once_then_views(spark, tmp_path):
    from popflow.sources.events import read_raw_stream
    from popflow.streaming.ingest import read_ingested, read_ingested_table, start_ingest

    src, table = str(tmp_path / "src"), str(tmp_path / "events")
    _write_files(spark, src, range(N_FILES))
    spark.createDataFrame([("{not json",), ('{"player": "x", "score": 1}',)], "value string") \
        .coalesce(1).write.text(f"{src}/part=bad")
    raw = read_raw_stream(spark, StreamConfig(format="json", path=f"{src}/*",
                                              max_files_per_trigger=2))
    ingest = start_ingest(raw, table, str(tmp_path / "ck_ingest"),
                          trigger={"availableNow": True})
    await_all({"ingest": ingest}, 600)
    stored = read_ingested_table(spark, table)
    assert _rows(stored.events.where("event_ts is not null")) == _rows(_events(spark).select(
        "player", "balloon_color", "score", F.lit(None).cast("int").alias("page_id"),
        "favorite_color_bonus", "event_ts"))
    assert [tuple(r) for r in stored.events.where("event_ts is null").collect()] == [
        ("x", None, 1, None, None, None)]
    assert [r.reason for r in stored.rejects.collect()] == ["malformed"]
    # the views stream the typed table: no JSON parsing downstream
    events = read_ingested(spark, table, max_files_per_trigger=3)
    store = TableStore(spark, "stream_ingest", location=str(tmp_path / "wh"))
    names = ["leaderboard", "balloon_colored_pops"]
    qs = start_views(events.events, store, checkpoint_root=str(tmp_path / "ck"), names=names,
                     trigger={"availableNow": True})
    await_all(qs, 600)
    plan = qs["leaderboard"].lastProgress["sources"][0]["description"]
    assert "FileStreamSource" in plan
    for name in names:
        assert _rows(_current(store, name)) == _rows(_batch_view(name, _events(spark)))
    # the event without a time gives a leaderboard row without one: set aside, not lost
    aside = store.read_rejects("leaderboard").collect()
    assert [(r.missing, "\"player\":\"x\"" in r.row) for r in aside] == [("event_ts", True)]
    store.drop_namespace()


def test_list_running_pipeline(spark, tmp_path):
    import time

    from popflow.sources.events import read_raw_stream
    from popflow.streaming.ingest import read_ingested, start_ingest

    src, table = str(tmp_path / "src"), str(tmp_path / "events")
    _write_files(spark, src, range(2))
    raw = read_raw_stream(spark, StreamConfig(format="json", path=f"{src}/*"))
    ingest = start_ingest(raw, table, str(tmp_path / "ck_ingest"),
                          trigger={"processingTime": "1 second"})
    store = TableStore(spark, "stream_live", location=str(tmp_path / "wh"))
    try:
        deadline = time.time() + 120
        while ingest.lastProgress is None and time.time() < deadline:
            time.sleep(0.5)
        qs = start_views(read_ingested(spark, table).events, store,
                         checkpoint_root=str(tmp_path / "ck"), names=["leaderboard"],
                         trigger={"processingTime": "1 second"})
        while qs["leaderboard"].lastProgress is None and time.time() < deadline:
            time.sleep(0.5)
        info = list_pipeline(spark, store)
        assert {q["name"] for q in info["queries"]} == {"popflow.ingest",
                                                         "stream_live.leaderboard"}
        assert all(q["active"] for q in info["queries"])
        assert info["tables"] == ["leaderboard"]
    finally:
        for q in spark.streams.active:
            q.stop()
    store.drop_namespace()
