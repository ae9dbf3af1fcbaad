"""Bounded state: idle keys leave it, late events still count, state rows stay flat."""

import datetime as dt
import json
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from popflow.operators import views
from popflow.sources.events import StreamConfig, game_events, read_events_stream
from popflow.sources.tables import TableStore
from popflow.streaming import bounded
from popflow.streaming.bounded import NO_TIME, TABLE, _add, bounded_totals, start_bounded
from popflow.streaming.replay import _wire_events, stage_events
from tests.conftest import SF001


def drained(spark, base, store, idle, salts=2, files=1):
    stream = read_events_stream(spark, StreamConfig(format="json", path=f"{base}/src", max_files_per_trigger=files)).events
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        q = start_bounded(stream, store, ["player"], f"{base}/ck", idle, salts, {"availableNow": True})
        assert q.awaitTermination(100)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert q.exception() is None
    return q.recentProgress


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("idle", ["1 hour", "1 second"])
def test_totals_equal_the_view_however_late_the_events(spark, tmp_path, idle):
    """The events dealt at random over six batches; with a short time some keys have several lives."""
    ge = game_events(spark, SF001)
    base = stage_events(ge, 6, str(tmp_path), shuffled=True)
    store = TableStore(spark, f"bounded_{idle[2:]}", location=f"{base}/t")
    drained(spark, base, store, idle)
    got = bounded_totals(store, ["player"]).select("player", "total_score", "bonus_hits", "event_ts")
    assert rows(got) == rows(views.leaderboard(_wire_events(ge)))
    store.drop_namespace()


def write(folder, name, events):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in events))


def event(player, score, day=1, **more):
    return {"player": player, "balloon_color": "red", "score": score, "event_ts": f"2024-01-{day:02d}T00:00:00.000000Z", **more}


def test_an_idle_key_leaves_and_a_late_event_corrects(spark, tmp_path):
    base, src = str(tmp_path), tmp_path / "src"
    store = TableStore(spark, "bounded_life", location=f"{base}/t")
    write(src, "a.json", [event("ann", 5, 3, favorite_color_bonus=True), event("bob", 1, 3)])
    write(src, "b.json", [event("ann", 7, 1)])  # late, within the time: the same life
    first = drained(spark, base, store, "5 seconds", 1)
    lives = store.table(TABLE).where("player = 'ann'").orderBy("batch_id").collect()
    assert [r.points for r in lives] == [5, 12] and len({r.life for r in lives}) == 1
    held = first[-1]["stateOperators"][0]["numRowsTotal"]
    assert held >= 2
    time.sleep(5.5)
    write(src, "c.json", [event("cid", 2)])
    drained(spark, base, store, "5 seconds", 1)  # both idle keys leave
    write(src, "d.json", [event("ann", 100, 2)])  # later still: the next life
    last = drained(spark, base, store, "5 seconds", 1)
    assert last[-1]["stateOperators"][0]["numRowsTotal"] <= held
    assert store.table(TABLE).where("player = 'ann'").select("life").distinct().count() == 2
    got = {r.player: (r.total_score, r.pops, r.bonus_hits, r.event_ts) for r in bounded_totals(store, ["player"]).collect()}
    day = lambda d: dt.datetime(2024, 1, d)
    assert got == {"ann": (112, 3, 1, day(3)), "bob": (1, 1, 0, day(3)), "cid": (2, 1, 0, day(1))}
    store.drop_namespace()


def test_nulls_and_salted_hot_key(spark, tmp_path):
    base, src = str(tmp_path), tmp_path / "src"
    store = TableStore(spark, "bounded_odd", location=f"{base}/t")
    write(src, "a.json", [event("hot", i, 1 + i % 9) for i in range(500)] + [{"player": None, "score": None}, {"player": "x"}])
    drained(spark, base, store, "1 hour", 8)
    assert store.table(TABLE).where("player = 'hot'").select("salt").distinct().count() == 8
    got = {r.player: (r.total_score, r.pops, r.event_ts) for r in bounded_totals(store, ["player"]).collect()}
    assert got["hot"][:2] == (sum(range(500)), 500) and got[None] == (None, 1, None) == got["x"]
    store.drop_namespace()


def test_state_stays_flat_over_fifty_batches(spark, tmp_path):
    """Every batch brings new keys; the state holds those of the last while, the table all."""
    base, src = str(tmp_path), tmp_path / "src"
    store = TableStore(spark, "bounded_flat", location=f"{base}/t")
    for b in range(50):
        write(src, f"{b:03d}.json", [event(f"p{b}_{i}", 1) for i in range(40)])
    progress = [p for p in drained(spark, base, store, "1 second", 1) if p["numInputRows"]]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert len(held) == 50 or len(held) == len(spark.streams.active) + 50
    half = max(held[:25])
    assert max(held[25:]) <= 2 * half and held[-1] < 40 * 50
    assert bounded_totals(store, ["player"]).agg(F.sum("total_score")).first()[0] == 2000
    store.drop_namespace()


def test_keys_share_state_rows_and_calls(spark, tmp_path):
    """3,000 keys, one of them null: a bounded number of state rows, so of calls, holds the lives of all."""
    base, src = str(tmp_path), tmp_path / "src"
    store = TableStore(spark, "bounded_shared", location=f"{base}/t")
    names = [None, *(f"p{i}" for i in range(2999))]
    for file in ("a.json", "b.json"):
        write(src, file, [event(p, i, favorite_color_bonus=i % 2 == 0) for i, p in enumerate(names)])
    progress = drained(spark, base, store, "1 hour", 1)
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in progress) <= 1024
    got = {r.player: (r.total_score, r.pops, r.bonus_hits) for r in bounded_totals(store, ["player"]).collect()}
    assert got == {p: (2 * i, 2, 2 * (i % 2 == 0)) for i, p in enumerate(names)}
    assert store.table(TABLE).where("player = 'p7'").select("life").distinct().count() == 1
    store.drop_namespace()


class Bucket:
    """The state of one bucket between calls, at a time that the test sets."""

    exists, hasTimedOut, passed, timeout = False, False, 0, None

    def getCurrentWatermarkMs(self):
        return self.passed

    def update(self, value):
        self.exists, self.get = True, value

    def remove(self):
        self.exists = False

    def setTimeoutTimestamp(self, ms):
        assert ms >= self.passed
        self.timeout = ms


def test_each_key_of_a_bucket_has_its_own_time():
    state, run = Bucket(), _add(["player"], 100)

    def call(at, passed, *players, part=2):
        state.passed, state.hasTimedOut = passed, not players
        rows = pd.DataFrame({"player": players, "salt": 0, "points": 3, "scored": 1, "bonus_hits": 0, "last_us": NO_TIME,
                             "arrived": at})
        found = run((0,), iter([rows[i:i + part] for i in range(0, len(rows), part)]), state)
        return sorted((r.player, r.life, r.points, r.pops) for part in found for r in part.itertuples())

    assert call(1000, 0, "ann", "bob", "ann") == [("ann", 1000, 6, 2), ("bob", 1000, 3, 1)]
    assert call(1050, 1000, "bob") == [("bob", 1000, 6, 2)] and state.timeout == 1100
    # ann is idle, and leaves beside an event of another key; bob and cid stay
    assert call(1120, 1101, "cid") == [("cid", 1120, 3, 1)] and sorted(state.get[0]) == ["bob", "cid"]
    assert state.timeout == 1150
    # a key's data come before its timeout, as in a state of its own
    assert call(1200, 1160, "bob", "ann") == [("ann", 1200, 3, 1), ("bob", 1000, 9, 3)]
    assert call(None, 1221) == [] and sorted(state.get[0]) == ["ann", "bob"]
    assert call(None, 1301) == [] and not state.exists


def test_rows_of_a_large_bucket_are_added_up_in_between(monkeypatch):
    monkeypatch.setattr(bounded, "ROWS_HELD", 10)
    state = Bucket()
    parts = [pd.DataFrame({"player": [f"p{(i + j) % 9}" for i in range(7)], "salt": 0, "points": 1, "scored": 1,
                           "bonus_hits": 1, "last_us": j, "arrived": 5}) for j in range(20)]
    out = next(_add(["player"], 100)((0,), iter(parts), state))
    assert len(out) == 9 and out["points"].sum() == out["pops"].sum() == 140
    assert dict(zip(out["player"], out["last_us"])) == {f"p{k}": max(j for j in range(20) if (k - j) % 9 < 7) for k in range(9)}


def test_whole_number_keys_beside_a_null(spark, tmp_path):
    base, src = str(tmp_path), tmp_path / "src"
    store = TableStore(spark, "bounded_numbers", location=f"{base}/t")
    write(src, "a.json", [event("a", 1, page_id=7), event("b", 2, page_id=None), event("c", 4, page_id=7)])
    stream = read_events_stream(spark, StreamConfig(format="json", path=f"{base}/src")).events
    q = start_bounded(stream, store, ["page_id"], f"{base}/ck", "1 hour", trigger={"availableNow": True}, state_partitions=2)
    assert q.awaitTermination(100) and q.exception() is None
    assert q.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == 2
    assert rows(bounded_totals(store, ["page_id"]).select("page_id", "total_score", "pops")) == [(7, 5, 2), (None, 2, 1)]
    store.drop_namespace()
