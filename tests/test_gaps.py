"""Empty windows on the stream: between events, by timers, and beside late events."""

import datetime as dt
import json

from pyspark.sql import functions as F

from popflow.operators import views
from popflow.operators.performance import time_window_summary
from popflow.plans.registry import QUERIES
from popflow.sources.events import StreamConfig, game_events, read_events_stream
from popflow.sources.tables import TableStore
from popflow.streaming.gaps import start_gaps, stored_stretches
from popflow.streaming.replay import _wire_events, stage_events
from tests.conftest import SF001

HOUR = 473352  # hours from 1970 to 2024


def event(hour, minute=0, color="red"):
    return {"player": "a", "balloon_color": color, "score": 1,
            "event_ts": f"2024-01-{1 + hour // 24:02d}T{hour % 24:02d}:{minute:02d}:00.000000Z"}


def drained(spark, tmp_path, files, **kw):
    src = tmp_path / "src"
    src.mkdir(exist_ok=True)
    for name, events in files.items():
        (src / name).write_text("".join(json.dumps(e) + "\n" for e in events))
    store = TableStore(spark, f"gaps_{tmp_path.name}", location=str(tmp_path / "t"))
    stream = read_events_stream(spark, StreamConfig(format="json", path=str(src), max_files_per_trigger=1)).events
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        q = start_gaps(stream, store, str(tmp_path / "ck"), "1 hour", trigger={"availableNow": True}, **kw)
        assert q.awaitTermination(100)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert q.exception() is None
    return store


def stretches(store, series="all"):
    return sorted((r.first - HOUR, r.last - HOUR) for r in stored_stretches(store, series).collect())


def test_stretches_between_events_late_events_and_restart(spark, tmp_path):
    store = drained(spark, tmp_path, {"a.json": [event(5), event(5, 30), event(6), event(9)]}, lateness="2 days")
    assert stretches(store) == [(7, 8)]
    # late: one before all others, one inside the empty stretch (the read takes its data); then far ahead
    store = drained(spark, tmp_path, {"b.json": [event(2), event(7)], "c.json": [event(9, 59), event(20)]}, lateness="2 days")
    assert stretches(store) == [(3, 4), (7, 8), (10, 19)]
    cpt = spark.createDataFrame([("red", 4.0, 2, h) for h in (2, 5, 6, 7, 9, 20)], "c string, avg_score_per_pop double, total_pops long, h long")
    cpt = cpt.withColumn("window_start", F.timestamp_seconds((F.col("h") + HOUR) * 3600))
    got = time_window_summary(cpt, "1 hour", stretches=stored_stretches(store)).orderBy("window_start").collect()
    assert [r.n_colors for r in got] == [int(h in (2, 5, 6, 7, 9, 20)) for h in range(2, 21)]
    store.drop_namespace()


def test_timers_close_the_windows_of_a_silent_series(spark, tmp_path):
    files = {"a.json": [event(0), event(0, color="blue")], "b.json": [event(3)], "c.json": [event(6, 30)]}
    store = drained(spark, tmp_path, files, series="balloon_color", lateness="0 seconds")
    assert stretches(store, "red") == [(1, 2), (4, 5)]
    # blue is silent from the start: the watermark, moved by red, has passed windows 1 to 5
    blue = stretches(store, "blue")
    assert [h for a, b in blue for h in range(a, b + 1)] == [1, 2, 3, 4, 5]
    store.drop_namespace()


def test_drained_stream_equals_the_summary(spark, tmp_path):
    ge = game_events(spark, SF001)
    base = stage_events(ge, 4, str(tmp_path))
    store = TableStore(spark, "gaps_drain", location=f"{base}/t")
    stream = read_events_stream(spark, StreamConfig(format="json", path=f"{base}/src", max_files_per_trigger=1)).events
    # the slices may come in any order: the delay covers all of them
    q = start_gaps(stream, store, f"{base}/ck", "1 hour", lateness="60 days", trigger={"availableNow": True})
    assert q.awaitTermination(100) and q.exception() is None
    cpt = views.color_performance(_wire_events(ge), "1 hour")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(time_window_summary(cpt, "1 hour", stretches=stored_stretches(store))) == rows(time_window_summary(cpt, "1 hour"))
    store.drop_namespace()


def test_the_state_partitions_run_side_by_side(spark, tmp_path):
    """Beside the deduplication the state function too has a task per state partition; one file a batch."""
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text("".join(json.dumps(event(h)) + "\n" for h in (0, 3, 9)))
    store = TableStore(spark, "gaps_tasks", location=str(tmp_path / "t"))
    stream = read_events_stream(spark, StreamConfig(format="json", path=str(src))).events
    q = start_gaps(stream, store, str(tmp_path / "ck"), "1 hour", lateness="2 days", trigger={"availableNow": True},
                   state_partitions=3)
    assert q.awaitTermination(100) and q.exception() is None
    assert stretches(store) == [(1, 2), (4, 8)]
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(str(q.runId)) for s in tracker.getJobInfo(job).stageIds]
    tasks = [info.numTasks for info in map(tracker.getStageInfo, stages) if info]
    assert tasks.count(3) >= 2, tasks
    assert len(store.table("empty_windows").inputFiles()) == 1
    store.drop_namespace()


def test_events_of_many_years_are_one_summary(spark, tmp_path):
    """The query's delay covers the span of the events, whichever slice comes first."""
    rows = [(i, dt.datetime(2015 + i, 1, 1, 5), i, "click", 10.0 + i, '{"k": 7}') for i in range(8)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["stream_window_summary"](spark, str(tmp_path))
    want = QUERIES["time_window_summary_6h"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 4 * (dt.date(2022, 1, 1) - dt.date(2015, 1, 1)).days + 1
