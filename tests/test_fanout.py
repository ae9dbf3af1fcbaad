"""One query for all views: equal to the views, one read of the source; and the sink's own measures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from popflow.operators import quality, views
from popflow.schemas import TABLE_SCHEMAS
from popflow.sources.events import StreamConfig, game_events, read_events_stream
from popflow.sources.tables import LAYOUTS, TableStore
from popflow.streaming.fanout import fanout_writer, start_fanout
from popflow.streaming.replay import _wire_events, drain, stage_events
from tests.conftest import SF001

WIDTH = "6 hours"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def view_rows(name, events):
    fn = views.VIEWS[name]
    view = fn(events, WIDTH) if "window_start" in views.FAN_USES[name] else fn(events)
    return rows(views.to_table_types(name, view))


def current(store, name):
    return rows(store.read_table(name).drop(LAYOUTS[name].time_part))


@pytest.fixture(scope="module")
def odd_events(spark):
    """Nulls in every column, times before 1970, a score missing throughout a player."""
    t = [None, *(dt.datetime(y, 1, 1, h, 59, 59, 999_999) for y in (1969, 2024) for h in (0, 5, 6))]
    data = [(p, c, s, b, t[(i + j) % len(t)]) for i, p in enumerate(["ann", "bob", None]) for j, (c, s, b) in enumerate(
        [("red", 5, True), (None, 7, False), ("blue", None, None), ("red", -3, True), ("red", 0, None)])]
    data += [("zoe", "red", None, True, t[1])]
    return spark.createDataFrame(data * 2, "player string, balloon_color string, score int, favorite_color_bonus boolean, event_ts timestamp")


@pytest.mark.parametrize("name", list(views.VIEWS))
def test_each_view_comes_out_of_the_fan(spark, odd_events, name):
    assert set(views.FAN_USES) == set(views.VIEWS)
    for events in (odd_events, odd_events.limit(0)):
        got = views.to_table_types(name, views.from_fan(name, views.fan_out(events, WIDTH), WIDTH))
        assert rows(got) == view_rows(name, events)
    zone_free = odd_events.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))
    plain = views.fan_out(zone_free, WIDTH, [name])
    assert plain.select("view").distinct().collect() == [(name,)]
    assert dict(plain.dtypes)["window_start"] == "timestamp_ntz"


def test_counts_of_all_views_in_one_scan(spark, odd_events):
    for events in (odd_events, odd_events.limit(0)):
        want = {n: len(view_rows(n, events)) for n in views.VIEWS} | {"game_events": events.count()}
        got = quality.view_counts(events, WIDTH)
        assert {r.table_name: r.row_count for r in got.collect()} == want
    plan = quality.view_counts(game_events(spark, SF001), WIDTH)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_pages_refuse_empty_tables(spark, odd_events, tmp_path):
    from popflow.plans.pages import Dashboard

    store = TableStore(spark, "fan_guard", location=str(tmp_path / "t"))
    store.create_view_tables()
    for page in (Dashboard(store, guard=True).leaderboard_page, Dashboard(store, guard=True).performance_page):
        with pytest.raises(ValueError, match="No data available"):
            page()
    assert Dashboard(store).performance_page()["summary"].count() == 1
    fanout_writer(store, list(views.VIEWS), WIDTH, None)(views.fan_out(odd_events, WIDTH), 0)
    assert Dashboard(store, WIDTH, guard=True).leaderboard_page()["scoreboard"].count() > 0
    store.drop_namespace()


def test_stream_reads_every_event_once(spark, tmp_path):
    ge = game_events(spark, SF001)
    base = stage_events(ge, 6, str(tmp_path), shuffled=True)  # every batch holds late events
    store = TableStore(spark, "fan_stream", location=f"{base}/tables")
    stream = read_events_stream(spark, StreamConfig(format="json", path=f"{base}/src", max_files_per_trigger=2)).events

    def run():
        q = start_fanout(stream, store, f"{base}/checkpoints", width=WIDTH, trigger={"availableNow": True},
                         compact_every=None, state_partitions=2)
        q.awaitTermination(300)
        assert q.exception() is None
        return [p for p in q.recentProgress if p["numInputRows"]]

    progress = run()
    assert len(progress) == 3 and all(len(p["sources"]) == 1 and len(p["stateOperators"]) == 1 for p in progress)
    assert sum(p["numInputRows"] for p in progress) == ge.count()
    wire = _wire_events(ge)
    for name in views.VIEWS:
        assert current(store, name) == view_rows(name, wire)
        assert store.batches(name) == [0, 1, 2]
    assert run() == []  # a restart finds nothing new
    store.drop_namespace()


def test_retried_batch_and_compaction(spark, odd_events, tmp_path):
    store = TableStore(spark, "fan_retry", location=str(tmp_path / "t"))
    store.create_view_tables()
    events = odd_events.where("event_ts is not null and player is not null and balloon_color is not null and score is not null")
    write = fanout_writer(store, list(views.VIEWS), WIDTH, 2)
    write(views.fan_out(events.limit(4), WIDTH), 0)
    for _ in range(2):  # the second time as after a crash
        write(views.fan_out(events, WIDTH), 1)
    before = {n: current(store, n) for n in views.VIEWS}
    assert before == {n: view_rows(n, events) for n in views.VIEWS}
    write(views.fan_out(events, WIDTH), 2)  # folds batches 0 and 1
    assert all(store.batches(n) == [1, 2] for n in views.VIEWS)
    assert {n: current(store, n) for n in views.VIEWS} == before
    for n in views.VIEWS:
        assert {r.batch_id for r in store.commits(n).collect()} == {1, 2}
    store.drop_namespace()


def test_measures_of_the_sink_equal_scans(spark, odd_events, tmp_path):
    store = TableStore(spark, "fan_measured", location=str(tmp_path / "t"))
    store.create_view_tables()
    write = fanout_writer(store, list(views.VIEWS), WIDTH, None)
    for batch, part in enumerate((odd_events.where("score > 0"), odd_events, odd_events.limit(0))):
        write(views.fan_out(part, WIDTH), batch)
    names = list(views.VIEWS)
    commits = {n: store.commits(n) for n in names}
    assert rows(quality.measured_counts(commits)) == rows(quality.table_counts({n: store.table(n) for n in names}))
    now = "2024-02-01 00:00:00"
    scans = quality.freshness({n: (store.table(n), LAYOUTS[n].time_col) for n in names}, now)
    assert rows(quality.measured_freshness(commits, now)) == rows(scans)
    for n in names:
        scan = quality.required_violations(store.table(n), TABLE_SCHEMAS[n]).select(F.lit(n), "column_name", "null_count")
        measured = quality.measured_nulls({n: (commits[n], TABLE_SCHEMAS[n])})
        assert rows(measured) == rows(scan) and not any(f"/{n}/" in f for f in measured.inputFiles())
        time = LAYOUTS[n].time_col
        scan = store.table(n).groupBy("batch_id").agg(F.count("*"), F.min(time), F.max(time)).select(F.lit(n), "*")
        assert rows(store.commit_log(n)) == rows(scan)
        aside = store.read_rejects(n)
        assert sum(r.rejected for r in commits[n].collect()) == (aside.count() if aside else 0)
    assert sum(r.rejected for n in names for r in commits[n].collect()) > 0
    store.drop_namespace()


def test_drain_with_one_read_equals_a_query_per_view(spark, tmp_path):
    ge = game_events(spark, SF001)
    stores = [drain(spark, stage_events(ge, 2, str(tmp_path)), names=["leaderboard", "realtime_scores"], width=WIDTH,
                    one_read=one) for one in (True, False)]
    for name in ("leaderboard", "realtime_scores"):
        assert current(stores[0], name) == current(stores[1], name)
    for store in stores:
        store.drop_namespace()
