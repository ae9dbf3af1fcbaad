"""The event log: offsets, segments, starts at the latest offset, restarts."""

import json

import pytest
from pyspark.sql import functions as F

from popflow.sources import eventlog
from popflow.sources.eventlog import append_log, end_offsets, read_log, segments, slices, start_offsets, stream_log
from popflow.streaming.replay import follow_log
from popflow.sources.events import game_events
from tests.conftest import SF001


def payloads(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("k"), F.col("id") % 7).alias("key"), F.col("id").cast("string").alias("value"))


def test_append_gives_dense_offsets_and_keeps_keys_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(eventlog, "BATCH_ROWS", 16)
    path = str(tmp_path / "log")
    append_log(payloads(spark, 0, 300), path, 3)
    append_log(payloads(spark, 300, 400), f"file://{path}", 3)
    rows = read_log(spark, path).collect()
    assert sorted(int(r.value) for r in rows) == list(range(400))
    ends = end_offsets(path)
    for p, end in ends.items():
        assert sorted(r.offset for r in rows if r.partition == int(p)) == list(range(end))
    assert sum(ends.values()) == 400
    where = {}
    for r in rows:
        where.setdefault(int(r.value) % 7, set()).add(r.partition)
    assert all(len(v) == 1 for v in where.values())
    assert not list((tmp_path / "log" / eventlog.STAGED).iterdir())


def test_slices_are_the_parts_between_two_offsets(spark, tmp_path):
    path = str(tmp_path / "log")
    for low in (0, 50, 100):
        append_log(payloads(spark, low, low + 50), path, 1)
    assert [(s.skip, s.take) for s in slices(path, {"0": 30}, {"0": 120})] == [(30, 20), (0, 50), (0, 20)]
    assert slices(path, {"0": 150}, {"0": 150}) == [] and len(segments(path)[0]) == 3
    got = [r for s in slices(path, {"0": 30}, {"0": 120}) for b in eventlog.read_slice(path, s) for r in b.to_pylist()]
    assert [r["offset"] for r in got] == list(range(30, 120))


def test_empty_log_and_payloads_with_any_text(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_log(spark, path).count() == 0 and end_offsets(path) == {}
    append_log(payloads(spark, 0, 0), path, 2)
    assert read_log(spark, path).count() == 0
    odd = spark.createDataFrame([("a", "two\nlines"), (None, None), ("b", "")], "key string, value string")
    append_log(odd, path, 2)
    assert {r.value for r in read_log(spark, path).collect()} == {"two\nlines", None, ""}


def test_start_offsets_are_kept_by_the_start_file(spark, tmp_path):
    path, kept = str(tmp_path / "log"), str(tmp_path / "state" / "start.json")
    append_log(payloads(spark, 0, 10), path, 1)
    assert start_offsets(path, "latest", kept) == {"0": 10}
    append_log(payloads(spark, 10, 20), path, 1)
    assert start_offsets(path, "latest", kept) == {"0": 10} and start_offsets(path, "latest") == {"0": 20}
    assert start_offsets(path, "earliest") == {} and start_offsets(path, json.dumps({"0": 4})) == {"0": 4}


@pytest.mark.parametrize("starting,first", [("earliest", 0), ("latest", 40), ('{"0": 15}', 15)])
def test_stream_starts_where_told_and_resumes(spark, tmp_path, starting, first):
    path = str(tmp_path / "log")
    append_log(payloads(spark, 0, 40), path, 1)
    seen = []

    def run(rows):
        stream = stream_log(spark, path, starting, str(tmp_path / "start.json"))
        if rows:
            append_log(payloads(spark, *rows), path, 1)
        q = (stream.writeStream.option("checkpointLocation", str(tmp_path / "ck"))
             .foreachBatch(lambda df, i: seen.extend(r.offset for r in df.collect())).start())
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    run(None)          # at "latest" there is nothing: no micro-batch, no offsets in the checkpoint
    append_log(payloads(spark, 40, 50), path, 1)
    run((50, 60))
    run(None)
    assert sorted(seen) == list(range(first, 60))


def test_a_subscriber_at_latest_sees_later_events_only(spark, tmp_path):
    ge = game_events(spark, SF001)
    parts = [ge.where(F.col("event_id") % 3 == i) for i in range(3)]
    store = follow_log(*parts, names=["leaderboard"], base=str(tmp_path))
    got = {r.player: r.total_score for r in store.read_table("leaderboard").collect()}
    want = ge.where("event_id % 3 > 0").groupBy("player").agg(F.sum("score").alias("s")).collect()
    assert got == {r.player: r.s for r in want}
    batches = store.table("leaderboard").select("batch_id").distinct().count()
    assert batches >= 2  # one while it ran, one behind the restart
    store.drop_namespace()
