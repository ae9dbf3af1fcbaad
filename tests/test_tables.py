"""t5: table lifecycle (namespace, create, append, evolve, overwrite, drop)."""

from pyspark.sql import types as T

from popflow.operators.quality import required_violations, schema_diff
from popflow.sources.tables import TableStore

FRUITS = T.StructType([T.StructField("id", T.LongType(), False),
                       T.StructField("name", T.StringType(), True)])


def test_fruits_lifecycle(spark, tmp_path):
    store = TableStore(spark, "demo_db", location=str(tmp_path / "demo_db.db"))
    store.create_namespace()
    store.create_table("fruits", FRUITS, comment="demo table",
                       properties={"purpose": "lifecycle-test"})
    assert store.list_tables() == ["fruits"]
    store.append(spark.createDataFrame([(1, "mango"), (2, "banana"), (3, "orange")],
                                       "id long, name string"), "fruits")
    assert sorted(tuple(r) for r in store.table("fruits").collect()) == \
        [(1, "mango"), (2, "banana"), (3, "orange")]
    # schema evolution: a new nullable column reads as NULL for old rows
    store.add_column("fruits", "season", "STRING", "fruit season")
    rows = store.table("fruits").collect()
    assert [r.season for r in rows] == [None, None, None]
    desc = {r.col_name: r for r in store.describe("fruits").collect()}
    assert desc["season"].comment == "fruit season"
    store.overwrite(spark.createDataFrame(
        [(1, "mango", "summer"), (2, "banana", "all"), (3, "orange", "winter")],
        "id long, name string, season string"), "fruits")
    assert sorted(tuple(r) for r in store.table("fruits").collect()) == \
        [(1, "mango", "summer"), (2, "banana", "all"), (3, "orange", "winter")]
    # declared NOT NULL is checked explicitly (file tables do not enforce it)
    viol = {r.column_name: r.null_count
            for r in required_violations(store.table("fruits"), FRUITS).collect()}
    assert viol == {"id": 0}
    assert [d["column"] for d in schema_diff(store.table("fruits"), FRUITS)] == ["season"]
    props = {r.col_name: r.data_type for r in store.describe("fruits").collect()}
    assert "purpose" in props.get("Table Properties", "")
    store.drop_namespace()
    assert not spark.catalog.databaseExists("demo_db")


def test_view_tables_layouts(spark, tmp_path):
    s1 = TableStore(spark, "layout_scalable", location=str(tmp_path / "a"))
    s1.create_view_tables()
    assert set(s1.list_tables()) == {"leaderboard", "balloon_color_stats", "realtime_scores",
                                     "balloon_colored_pops", "color_performance_trends"}
    assert s1.partition_cols("balloon_colored_pops") == ["batch_id", "window_hour"]
    s2 = TableStore(spark, "layout_faithful", location=str(tmp_path / "b"), layout="faithful")
    assert s2.partition_cols("balloon_color_stats") == \
        ["batch_id", "event_day", "balloon_color", "player"]
    s1.drop_namespace()


def _files_per_partition(root):
    import os
    out = {}
    for d, _, files in os.walk(root):
        n = sum(1 for f in files if f.endswith(".parquet"))
        if n:
            out[d] = n
    return out


def test_batch_write_clusters_partitions_and_splits_hot_hour(spark, tmp_path, monkeypatch):
    import popflow.sources.tables as tables
    from pyspark.sql import functions as F

    store = TableStore(spark, "write_layout", location=str(tmp_path / "wh"))
    store.create_view_tables(["realtime_scores"])
    # a backfill batch over 48 hours, 40 players: one file per hour directory
    spread = spark.range(48 * 40).select(
        F.concat(F.lit("p"), (F.col("id") % 40).cast("string")).alias("player"),
        F.col("id").alias("total_score"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp")
         + F.make_dt_interval(hours=(F.col("id") / 40).cast("int"))).alias("window_start"))
    spread = spread.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 15 SECONDS"))
    store.write_batch("realtime_scores", spread, 0)
    files = _files_per_partition(tmp_path / "wh" / "realtime_scores" / "batch_id=0")
    assert len(files) == 48 and set(files.values()) == {1}
    # a live batch: every row in one hour. With a small per-file target the
    # hour is split over several writers instead of one task.
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 100)
    hot = spread.withColumn("window_start", F.lit("2024-01-03 10:00:00").cast("timestamp")
                            + F.make_dt_interval(secs=F.col("total_score") % 3600))
    store.write_batch("realtime_scores", hot, 1)
    files = _files_per_partition(tmp_path / "wh" / "realtime_scores" / "batch_id=1")
    assert len(files) == 1 and list(files.values())[0] > 4
    # rows are sorted by (player, window_start) inside each file
    one = next(iter(files))
    f = next(p for p in __import__("os").listdir(one) if p.endswith(".parquet"))
    rows = [(r.player, r.window_start) for r in
            spark.read.parquet(f"{one}/{f}").select("player", "window_start").collect()]
    assert rows == sorted(rows)
    assert store.read_table("realtime_scores", "changelog").count() == 2 * 48 * 40
    store.drop_namespace()


def test_quoted_values_survive_compaction(spark, tmp_path):
    from pyspark.sql import functions as F

    store = TableStore(spark, "quoted", location=str(tmp_path / "wh"), layout="faithful")
    store.create_view_tables(["leaderboard"])
    rows = spark.createDataFrame([("O'Neil", 1, 0), ("a", 2, 0)], "player string, total_score long, bonus_hits long").withColumn(
        "event_ts", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    for batch in range(3):
        store.write_batch("leaderboard", rows.withColumn("total_score", F.col("total_score") + batch), batch)
    assert store.compact("leaderboard", 2) == 2 and store.batches("leaderboard") == [2]
    assert {r.player: r.total_score for r in store.read_table("leaderboard").collect()} == {"O'Neil": 3, "a": 4}
    store.drop_namespace()


def test_iceberg_ddl_leaves_the_schemas_alone(spark, monkeypatch):
    from popflow.schemas import TABLE_SCHEMAS

    before = {k: list(v.names) for k, v in TABLE_SCHEMAS.items()}
    store = TableStore(spark, "ice", fmt="iceberg")
    ddl = []
    monkeypatch.setattr(store, "create_namespace", lambda: None)
    monkeypatch.setattr(store, "create_table", lambda name, schema, *a, **k: ddl.append((name, schema.names)))
    store.create_view_tables()
    store.create_view_tables()
    assert {k: list(v.names) for k, v in TABLE_SCHEMAS.items()} == before
    assert all(names == [*before[n], "batch_id"] for n, names in ddl) and len(ddl) == 10


def test_time_ranges_of_stored_tables_hold_in_any_session_zone(spark, tmp_path):
    import datetime as dt

    from popflow.functions.expressions import utc_instant
    from popflow.operators.leaderboard import in_time_range

    times = [(f"p{i}", i, dt.datetime(2024, 1, 10, 10, 0) + dt.timedelta(minutes=15 * i)) for i in range(12)]
    before = spark.conf.get("spark.sql.session.timeZone")
    store = TableStore(spark, "zones", location=str(tmp_path / "wh"))
    store.create_view_tables(["realtime_scores"])
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = spark.createDataFrame(times, "player string, total_score long, t timestamp_ntz").withColumn(
            "window_start", utc_instant("t")).withColumn("window_end", utc_instant("t"))
        store.write_batch("realtime_scores", df, 0)
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            cur = store.read_table("realtime_scores")
            for hour_col in (None, "window_hour"):
                assert in_time_range(cur, "2024-01-10 10:45:00", "2024-01-10 12:00:00", hour_col=hour_col).count() == 6
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    store.drop_namespace()
