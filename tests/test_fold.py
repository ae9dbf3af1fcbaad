"""Folds rewrite only what several batches share, and keep the sink's measures true."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from popflow.operators import quality, views
from popflow.sources.tables import LAYOUTS, TableStore, fold_writes


def events(spark, rows):
    return spark.createDataFrame([(p, c, s, True, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for p, c, s, h in rows],
                                 "player string, balloon_color string, score int, favorite_color_bonus boolean, event_ts timestamp")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def measures_are_true(store, name):
    time = LAYOUTS[name].time_col
    scan = store.table(name).groupBy("batch_id").agg(F.count("*"), F.min(time), F.max(time)).select(F.lit(name), "*")
    assert rows(store.commit_log(name)) == rows(scan)
    assert quality.measured_counts({name: store.commits(name)}).first().row_count == store.table(name).count()


def files(store, name):
    return set(store.table(name).inputFiles())


@pytest.mark.parametrize("layout", ["scalable", "faithful"])
def test_fold_touches_the_hours_that_changed(spark, tmp_path, layout):
    name = "balloon_colored_pops"
    store = TableStore(spark, f"fold_{layout}", location=str(tmp_path / "t"), layout=layout)
    store.create_view_tables([name])
    seen = []
    for batch, hours in enumerate([range(0, 60), (3, 4), (4, 70), (70, 71)]):
        seen += [(p, "red", 1 + batch, h) for h in hours for p in ("it's", "b b")]
        touched = events(spark, [r for r in seen if r[3] in set(hours)])
        store.write_batch(name, views.colored_pops(touched, "1 hour"), batch)
    before, state = files(store, name), rows(store.read_table(name))
    assert store.compact(name, 2) == 2   # hours 3 and 4: from batches 0 and 1; hour 4 from 2 too
    kept = {f for f in before if not any(f"hour={473352 + h}" in f for h in (3, 4))}
    assert kept <= files(store, name)    # every other file is as it was
    rewritten = store.table(name).where(F.col("batch_id") == 2).where(F.col("window_hour").isin(473355, 473356))
    assert rewritten.count() == 4 and store.table(name).where("window_hour in (473355, 473356) and batch_id != 2").count() == 0
    assert rows(store.read_table(name)) == state and store.compact(name, 2) == 0
    measures_are_true(store, name)
    assert store.compact(name, 3) == 1 and rows(store.read_table(name)) == state  # hour 70
    measures_are_true(store, name)
    store.drop_namespace()


def test_rows_written_by_folds_grow_slowly_with_the_batches(spark, tmp_path):
    """A large first batch stays where it is; of many small ones each row is rewritten a few times."""
    name = "leaderboard"
    store = TableStore(spark, "fold_tiers", location=str(tmp_path / "t"))
    store.create_view_tables([name])
    store.write_batch(name, views.leaderboard(events(spark, [(f"p{i}", "red", 1, 0) for i in range(400)])), 0)
    base, rewritten = files(store, name), 0
    total = {f"p{i}": 1 for i in range(400)}
    for batch in range(1, 13):
        changed = {f"p{(7 * batch + i) % 400}" for i in range(4)}
        total |= {p: batch + 1 for p in changed}
        store.write_batch(name, views.leaderboard(events(spark, [(p, "red", batch + 1, batch) for p in changed])), batch)
        if store.compact(name, batch - 1) and batch > 1:
            rewritten += store.table(name).where(F.col("batch_id") == batch - 1).count()
        assert base <= files(store, name)
    assert {r.player: r.total_score for r in store.read_table(name).collect()} == total
    assert rewritten <= 4 * 12 * 6 and len(store.batches(name)) <= 6
    measures_are_true(store, name)
    store.drop_namespace()


def test_a_fold_that_stopped_half_way_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    name = "realtime_scores"
    store = TableStore(spark, "fold_crash", location=str(tmp_path / "t"))
    store.create_view_tables([name])
    for batch in range(3):
        store.write_batch(name, views.realtime_scores(events(spark, [("a", "red", batch + 1, 1), ("b", "red", 1, batch)])), batch)
    state = rows(store.read_table(name))

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_recommit", stop)
        with pytest.raises(RuntimeError):
            store.compact(name, 2)
    assert rows(store.read_table(name)) == state
    store.compact(name, 2)
    assert rows(store.read_table(name)) == state
    measures_are_true(store, name)
    store.drop_namespace()


def test_a_fold_keeps_its_overwrite_mode_beside_another(spark):
    """Two queries fold at once: neither writes in the other's mode, and the session's is as before."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before, seen, inside = spark.conf.get(key), [], threading.Event()

    def second():
        inside.wait(20)
        with fold_writes(spark, dynamic=False):
            seen.append(spark.conf.get(key))

    other = threading.Thread(target=second)
    other.start()
    with fold_writes(spark, dynamic=True):
        inside.set()
        other.join(1)
        seen.append(spark.conf.get(key))
    other.join(20)
    assert [v.lower() for v in seen] == ["dynamic", before.lower()] and spark.conf.get(key) == before
