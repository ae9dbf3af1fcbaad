"""Result tables: namespace / create / append / overwrite / evolve / drop,
the idempotent changelog sink, current-state and as-of reads, commit log.

Each view lands in one *changelog* table: every micro-batch's updated rows
with their ``batch_id``. A micro-batch is written with ``INSERT OVERWRITE
... PARTITION (batch_id=N, ...)``, which replaces exactly that batch's
output, so a retried batch never duplicates rows (exactly-once on plain
Parquet). ``current`` = latest row per key; ``as_of_batch=N`` = latest row
per key among batches <= N (time travel by batch).

Layout. Time partitions are derived columns (``event_day`` or
``window_hour``) because file tables cannot use hidden transforms. The
``scalable`` layout partitions by batch and time only and leaves colour and
player to the in-file sort order: identity partitioning by player explodes
the directory count at scale, and colour multiplies the files every
micro-batch writes (x12) for no page query, which filter by time or player,
never by colour. ``faithful`` adds the reference's colour / player
partitions. With ``fmt="iceberg"`` (needs the Iceberg runtime on the
classpath) the DDL uses hidden ``days()``/``hours()`` transforms instead.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from threading import RLock
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popflow.functions.expressions import utc_day, utc_hour
from popflow.operators.ranking import latest_by_key
from popflow.operators.views import to_table_types
from popflow.schemas import TABLE_KEYS, TABLE_SCHEMAS
from popflow.sources.events import sql_string

#: What the sink records of each batch and time partition.
COMMIT_SCHEMA = T.StructType([
    T.StructField("part", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("rejected", T.LongType()),
    T.StructField("min_ts", T.TimestampType()), T.StructField("max_ts", T.TimestampType()),
    T.StructField("nulls", T.MapType(T.StringType(), T.LongType())), T.StructField("batch_id", T.LongType())])

# Target rows per written file of a changelog partition (a few tens of MB of
# Parquet for these narrow rows).
ROWS_PER_FILE = 2_000_000
#: Distinct players a file's Bloom filter is sized for, at most.
PLAYERS_PER_FILE = 100_000


_FOLDS = RLock()


@contextmanager
def fold_writes(spark: SparkSession, dynamic: bool) -> Iterator[None]:
    """Writes of a fold, under a partition overwrite mode that no other fold changes meanwhile.

    The mode is the session's, and the queries of several views fold their tables
    side by side: in the other's mode a fold would drop partitions that stay, or
    keep some that go.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    with _FOLDS:
        before = spark.conf.get(key)
        if dynamic:
            spark.conf.set(key, "dynamic")
        try:
            yield
        finally:
            spark.conf.set(key, before)


@dataclass(frozen=True)
class Layout:
    time_col: str            # column the time partition is derived from
    time_part: str           # derived partition column name
    time_grain: str          # "day" | "hour"
    faithful_parts: tuple[str, ...]     # the reference's other partitions
    sort: tuple[tuple[str, str], ...]   # (column, "asc"|"desc") within files


LAYOUTS: dict[str, Layout] = {
    "leaderboard": Layout("event_ts", "event_day", "day", ("player",),
                          (("total_score", "desc"), ("bonus_hits", "desc"))),
    "balloon_color_stats": Layout("event_ts", "event_day", "day", ("balloon_color", "player"),
                                  (("points_by_color", "desc"), ("balloon_pops", "desc"))),
    "realtime_scores": Layout("window_start", "window_hour", "hour", (),
                              (("player", "asc"), ("window_start", "asc"))),
    "balloon_colored_pops": Layout("window_start", "window_hour", "hour", ("player",),
                                   (("balloon_color", "asc"),)),
    "color_performance_trends": Layout("window_start", "window_hour", "hour",
                                       ("balloon_color",),
                                       (("balloon_color", "asc"), ("window_start", "asc"))),
}


def _time_part_expr(layout: Layout) -> Column:
    """UTC day (DATE) or hour (BIGINT hours since 1970): neither depends on the
    session time zone of the writer or of a reader parsing the path."""
    return utc_day(layout.time_col) if layout.time_grain == "day" else utc_hour(layout.time_col)


def _time_part_type(layout: Layout) -> T.DataType:
    return T.DateType() if layout.time_grain == "day" else T.LongType()


class TableStore:
    """Catalog namespace holding the five changelog tables (and any other
    table created through it)."""

    def __init__(self, spark: SparkSession, namespace: str = "balloon_pops",
                 location: str | None = None, layout: str = "scalable",
                 fmt: str = "parquet"):
        if layout not in ("scalable", "faithful"):
            raise ValueError("layout must be 'scalable' or 'faithful'")
        self.spark = spark
        self.namespace = namespace
        self.location = location
        self.layout = layout
        self.fmt = fmt

    # -- naming ---------------------------------------------------------------
    def qualified(self, name: str) -> str:
        return f"`{self.namespace}`.`{name}`"

    def partition_cols(self, name: str) -> list[str]:
        lay = LAYOUTS[name]
        cols = [lay.time_part]
        if self.layout == "faithful":
            cols += list(lay.faithful_parts)
        return ["batch_id", *cols]

    # -- namespace (A6, A13, A14) -----------------------------------------------
    def create_namespace(self) -> None:
        loc = f" LOCATION {sql_string(self.location)}" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}`{loc}")

    def list_tables(self) -> list[str]:
        if not self.spark.catalog.databaseExists(self.namespace):
            return []
        return sorted(t.name for t in self.spark.catalog.listTables(self.namespace))

    def drop_namespace(self) -> None:
        """Drop every table of the namespace, then the namespace."""
        for t in self.list_tables():
            self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(t)}")
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.namespace}` CASCADE")

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.namespace}.{name}")

    # -- generic tables (A7-A11) ------------------------------------------------
    def create_table(self, name: str, schema: T.StructType,
                     partition_cols: Sequence[str] = (), comment: str | None = None,
                     properties: dict[str, str] | None = None,
                     partition_exprs: Sequence[str] | None = None,
                     options: dict[str, str] | None = None) -> None:
        """``CREATE TABLE IF NOT EXISTS`` with schema, partitioning and
        properties. Plain Parquet tables have no NOT NULL (Spark would not
        enforce it): the schema's required columns are checked by the sink and
        by :func:`popflow.operators.quality.required_violations`."""
        cols = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            + ("" if f.nullable or self.fmt == "parquet" else " NOT NULL")
            + (f" COMMENT {sql_string(f.metadata['comment'])}" if f.metadata.get("comment") else "")
            for f in schema)
        ddl = f"CREATE TABLE IF NOT EXISTS {self.qualified(name)} ({cols}) USING {self.fmt}"
        if options:
            ddl += " OPTIONS (" + ", ".join(f"{sql_string(k)} {sql_string(v)}" for k, v in options.items()) + ")"
        parts = list(partition_exprs or partition_cols)
        if parts:
            ddl += " PARTITIONED BY (" + ", ".join(parts) + ")"
        if comment:
            ddl += f" COMMENT {sql_string(comment)}"
        if properties:
            ddl += " TBLPROPERTIES (" + ", ".join(
                f"{sql_string(k)}={sql_string(v)}" for k, v in properties.items()) + ")"
        self.spark.sql(ddl)

    def append(self, df: DataFrame, name: str) -> None:
        """Append rows (columns matched by name to the table's order)."""
        cols = self.spark.table(self.qualified(name)).columns
        df.select(*cols).write.insertInto(f"{self.namespace}.{name}", overwrite=False)

    def overwrite(self, df: DataFrame, name: str) -> None:
        """Replace the table's whole contents."""
        cols = self.spark.table(self.qualified(name)).columns
        df.select(*cols).write.insertInto(f"{self.namespace}.{name}", overwrite=True)

    def add_column(self, name: str, column: str, dtype: str,
                   comment: str | None = None) -> None:
        """Add a nullable column; existing rows read it as NULL."""
        c = f" COMMENT {sql_string(comment)}" if comment else ""
        self.spark.sql(f"ALTER TABLE {self.qualified(name)} ADD COLUMNS (`{column}` {dtype}{c})")

    def describe(self, name: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.qualified(name)}")

    def table(self, name: str) -> DataFrame:
        """Full table scan (lazy: later filters and projections are pushed)."""
        return self.spark.table(self.qualified(name))

    # -- the five view tables (A5, A7) -----------------------------------------------
    def changelog_schema(self, name: str) -> T.StructType:
        lay = LAYOUTS[name]
        fields = list(TABLE_SCHEMAS[name].fields) + [
            T.StructField("batch_id", T.LongType(), False),
            T.StructField(lay.time_part, _time_part_type(lay), False)]
        return T.StructType(fields)

    def create_view_tables(self, names: Sequence[str] | None = None) -> None:
        self.create_namespace()
        for name in names or TABLE_SCHEMAS:
            lay = LAYOUTS[name]
            if self.fmt == "iceberg":
                grain = "days" if lay.time_grain == "day" else "hours"
                parts = ["batch_id", f"{grain}({lay.time_col})"]
                if self.layout == "faithful":
                    parts += list(lay.faithful_parts)
                schema = T.StructType([*TABLE_SCHEMAS[name].fields,
                                       T.StructField("batch_id", T.LongType(), False)])
                self.create_table(name, schema, partition_exprs=parts,
                                  properties={"format-version": "2",
                                              "write.distribution-mode": "hash",
                                              **self._sort_property(name)})
            else:
                self.create_table(name, self.changelog_schema(name), self.partition_cols(name),
                                  properties=self._sort_property(name), options=self._bloom_options(name))

    def _bloom_options(self, name: str) -> dict[str, str]:
        """Bloom filters on the player, in the files of every batch.

        No partition and no leading sort column serves a player's rows; a filter
        lets a read skip the row groups that do not hold the player. It is sized
        by the distinct players it may see in a file, and adapts below that.
        """
        if "player" not in TABLE_SCHEMAS[name].names or "player" in self.partition_cols(name):
            return {}
        return {"parquet.bloom.filter.enabled#player": "true", "parquet.bloom.filter.adaptive.enabled": "true",
                "parquet.bloom.filter.expected.ndv#player": str(PLAYERS_PER_FILE)}

    def player_rows(self, name: str, players: Sequence[str], mode: str = "current") -> DataFrame:
        """Stored rows of some players: the equality reaches the scan and its filters."""
        return self.read_table(name, mode).where(F.col("player").isin(list(players)))

    def _sort_property(self, name: str) -> dict[str, str]:
        """The table's sort order, stored with it (the sink sorts files by it)."""
        return {"popflow.sort-order": ", ".join(f"{c} {d}" for c, d in LAYOUTS[name].sort)}

    def prepare_batch(self, name: str, df: DataFrame, batch_id: int) -> DataFrame:
        """View output -> table row shape: table types, ``batch_id`` and the
        derived partition column."""
        lay = LAYOUTS[name]
        out = to_table_types(name, df).withColumn("batch_id", F.lit(batch_id).cast("long"))
        if self.fmt != "iceberg":
            out = out.withColumn(lay.time_part, _time_part_expr(lay))
        return out

    def _sort_order(self, name: str) -> list[Column]:
        return [F.col(c).desc() if d == "desc" else F.col(c).asc()
                for c, d in LAYOUTS[name].sort]

    def rejects_table(self, name: str) -> str:
        return f"{name}_rejects"

    def _set_aside(self, name: str, out: DataFrame, batch_id: int) -> None:
        """Keep result rows without a required value (as JSON, with the names
        of the missing columns) in ``<name>_rejects``, per batch."""
        table = self.rejects_table(name)
        schema = T.StructType([T.StructField("row", T.StringType()),
                               T.StructField("missing", T.StringType()),
                               T.StructField("batch_id", T.LongType())])
        self.create_table(table, schema, ["batch_id"])
        required = [f.name for f in TABLE_SCHEMAS[name] if not f.nullable]
        missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
        rows = out.select(F.to_json(F.struct(*[f.name for f in TABLE_SCHEMAS[name]])).alias("row"),
                          missing.alias("missing"))
        view = f"_popflow_rejects_{self.namespace}_{name}"
        rows.createOrReplaceTempView(view)
        out.sparkSession.sql(f"INSERT OVERWRITE TABLE {self.qualified(table)} "
                             f"PARTITION (batch_id={int(batch_id)}) SELECT row, missing FROM `{view}`")
        out.sparkSession.catalog.dropTempView(view)

    def read_rejects(self, name: str) -> DataFrame | None:
        """Result rows set aside by the sink, or None if there were none."""
        table = self.rejects_table(name)
        return self.table(table) if self.exists(table) else None

    def cluster_for_write(self, name: str, out: DataFrame, rows: int, parts: int) -> DataFrame:
        """Shuffle a batch so each partition directory is written by few
        tasks, then sort rows within files by the table's sort order (min/max
        statistics then skip row groups).

        Without it every task writes a file into every partition it holds
        rows for: a backfill batch spanning 720 hours from 16 tasks writes
        ~11k tiny files. Clustering by the partition columns alone would put
        a live stream's whole micro-batch (all rows in the current hour) on
        one writer, so each partition is split into ``buckets`` by a hash of
        the table key, sized from the batch's counted rows and estimated
        partitions. AQE's rebalance would do this at runtime, but AQE is off
        inside ``foreachBatch``.
        """
        dyn = self.partition_cols(name)[1:]
        if not rows:
            return out
        buckets = max(1, math.ceil(rows / max(parts, 1) / ROWS_PER_FILE))
        cap = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if cap < 1:
            cap = self.spark.sparkContext.defaultParallelism
        salt = F.pmod(F.xxhash64(*[F.col(k) for k in TABLE_KEYS[name]]), F.lit(buckets))
        # The writer needs rows grouped by partition directory; leading with
        # the partition columns keeps the table's order inside each file
        # (otherwise the planner replaces this sort with its own).
        return (out.repartition(max(1, min(parts * buckets, cap)),
                                *[F.col(c) for c in dyn], salt)
                .sortWithinPartitions(*[F.col(c) for c in dyn], *self._sort_order(name)))

    def commits_table(self, name: str) -> str:
        return f"{name}_commits"

    def _commit(self, name: str, batch_id: int, measures: list[dict]) -> None:
        """Record what was measured of a stored batch, in that batch's own partition."""
        if not self.exists(self.commits_table(name)):
            self.create_table(self.commits_table(name), COMMIT_SCHEMA, ["batch_id"])
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.qualified(self.commits_table(name))} PARTITION (batch_id={int(batch_id)}) "
            "SELECT part, rows, rejected, timestamp_micros(min_us), timestamp_micros(max_us), nulls FROM "
            "(SELECT inline(from_json(:measures, 'array<struct<part: string, rows: bigint, rejected: bigint, "
            "min_us: bigint, max_us: bigint, nulls: map<string, bigint>>>')))", args={"measures": json.dumps(measures)})

    def commits(self, name: str) -> DataFrame:
        """One row per stored batch and time partition: part, rows, rejected, min_ts,
        max_ts (of the table's time column), nulls per column, batch_id. Written with
        the batch; reading it reads no data file."""
        return self.table(self.commits_table(name))

    def write_batch(self, name: str, df: DataFrame, batch_id: int, persist: bool = True,
                    beside: Sequence[dict] = ()) -> None:
        """Idempotently store one micro-batch of view updates, and what it measured.

        ``persist=False`` for a batch that the caller has persisted already;
        ``beside`` holds the measures of partitions of the batch that stay.
        """
        out = self.prepare_batch(name, df, batch_id)
        if self.fmt == "iceberg":
            # Iceberg clusters by partition itself ('write.distribution-mode').
            (out.sortWithinPartitions(*self._sort_order(name))
             .writeTo(f"{self.namespace}.{name}").overwrite(F.col("batch_id") == batch_id))
            return
        spark = df.sparkSession
        # The batch is used by two actions (sizing, write): compute it once.
        cached = out.persist(StorageLevel.MEMORY_AND_DISK) if persist else out
        try:
            # One small job over the persisted batch, one row per partition it
            # touches: rows, rows that lack a required value, and the measures
            # of the others that are kept with the batch.
            columns = [f.name for f in TABLE_SCHEMAS[name]]
            lacks = [F.col(f.name).isNull() for f in TABLE_SCHEMAS[name] if not f.nullable]
            bad = reduce(lambda x, y: x | y, lacks, F.lit(False))
            time = F.unix_micros(F.when(~bad, F.col(LAYOUTS[name].time_col)))
            found = cached.groupBy(*self.partition_cols(name)[1:]).agg(
                F.count(F.lit(1)).alias("_rows"), F.count_if(bad).alias("_bad"), F.min(time).alias("_min"),
                F.max(time).alias("_max"),
                *[F.count_if(~bad & F.col(c).isNull()).alias(f"_null_{c}") for c in columns]).collect()
            rows, n_bad = sum(r["_rows"] for r in found), sum(r["_bad"] for r in found)
            touched = sum(r["_rows"] > r["_bad"] for r in found)
            good = cached
            if n_bad:
                self._set_aside(name, cached.where(bad), batch_id)
                good = cached.where(~bad)
            out = self.cluster_for_write(name, good, rows - n_bad, touched)
            view = f"_popflow_batch_{self.namespace}_{name}"
            table_cols = spark.table(self.qualified(name)).columns
            parts = self.partition_cols(name)
            data_cols = [c for c in table_cols if c not in parts]
            out.select(*data_cols, *parts[1:]).createOrReplaceTempView(view)
            spec = ", ".join([f"batch_id={int(batch_id)}", *parts[1:]])
            spark.sql(f"INSERT OVERWRITE TABLE {self.qualified(name)} PARTITION ({spec}) "
                      f"SELECT {', '.join('`%s`' % c for c in data_cols + parts[1:])} "
                      f"FROM `{view}`")
            spark.catalog.dropTempView(view)
            part = LAYOUTS[name].time_part
            self._commit(name, batch_id, [*beside, *(
                {"part": None if r[part] is None else str(r[part]), "rows": r["_rows"] - r["_bad"], "rejected": r["_bad"],
                 "min_us": r["_min"], "max_us": r["_max"], "nulls": {c: r[f"_null_{c}"] for c in columns}} for r in found)])
        finally:
            if persist:
                cached.unpersist()

    # -- reads (A4, A12, A15) ---------------------------------------------------
    def read_table(self, name: str, mode: str = "current",
                   as_of_batch: int | None = None) -> DataFrame:
        """``changelog``: every stored update; ``current``: latest row per key
        (optionally as of a batch). The time partition column stays in the
        current view so time filters keep pruning partitions."""
        log = self.table(name)
        canon = [f.name for f in TABLE_SCHEMAS[name]]
        log = log.select(*canon, *[c for c in log.columns if c not in canon])
        if as_of_batch is not None:
            log = log.where(F.col("batch_id") <= F.lit(as_of_batch))
        if mode == "changelog":
            return log
        if mode != "current":
            raise ValueError("mode must be 'current' or 'changelog'")
        lay = LAYOUTS[name]
        keys = list(TABLE_KEYS[name])
        # The derived time partition is a function of a key column only for the
        # window tables; there it joins the key so time filters on it still
        # reach the scan. Elsewhere (event_ts is a value) it is carried along.
        if lay.time_col in keys and lay.time_part in log.columns:
            keys.append(lay.time_part)
        cur = latest_by_key(log, keys, ["batch_id"])
        return cur.select(*[c for c in log.columns if c != "batch_id"])

    def partitions(self, name: str) -> list[dict[str, str]]:
        """Partition specs of a table, from catalog metadata (no data scan)."""
        out = []
        for r in self.spark.sql(f"SHOW PARTITIONS {self.qualified(name)}").collect():
            spec = {}
            for kv in r[0].split("/"):
                k, _, v = kv.partition("=")
                spec[unquote(k)] = unquote(v)
            out.append(spec)
        return out

    def batches(self, name: str) -> list[int]:
        """Stored batch ids."""
        return sorted({int(p["batch_id"]) for p in self.partitions(name)})

    def compact(self, name: str, upto_batch: int) -> int:
        """Fold batches ``<= upto_batch``, rewriting only what they share.

        The latest row per key is rewritten into ``batch_id=upto_batch`` and the
        partitions it came from are dropped, so ``current`` and as-of reads at or
        after ``upto_batch`` are unchanged. As-of reads before ``upto_batch`` are
        no longer possible (history expiry). Only compact batches the stream has
        already committed.

        Where the time partition follows from the key (the windowed tables), a
        fold touches the hours that more than one batch wrote; an hour that one
        batch wrote stays where it is. In the other tables a key moves between
        days: batches are folded from the newest back, up to one that is more
        than twice as large as those together, so a row is rewritten a
        logarithmic number of times. Both are read off the sink's measures.

        Crash-safe: if the job stops after the rewrite but before the drops,
        the rewritten rows carry the highest batch id among the old ones, so
        every read still returns the same state; re-running finishes it.
        Returns the number of batches whose partitions were dropped.
        """
        if self.fmt == "iceberg":
            raise NotImplementedError("use Iceberg's rewrite_data_files / expire_snapshots")
        log = self.commits(name).where(F.col("batch_id") <= upto_batch).where("rows > 0")
        lay = LAYOUTS[name]
        snap = self.read_table(name, "changelog", as_of_batch=upto_batch)
        if lay.time_col in TABLE_KEYS[name]:
            shared = log.groupBy("part").agg(F.count_distinct("batch_id").alias("n")).where("n > 1").select("part")
            old = [(r.batch_id, r.part) for r in log.join(shared, "part").where(F.col("batch_id") < upto_batch)
                   .select("batch_id", "part").distinct().collect()]
            parts = sorted({p for _, p in old})
            snap = snap.where(F.col(lay.time_part).isin([int(p) if lay.time_grain == "hour" else p for p in parts]))
        else:
            sizes = sorted(((r.batch_id, r.n) for r in log.groupBy("batch_id").agg(F.sum("rows").alias("n")).collect()),
                           reverse=True)
            together, first = 0, None
            for batch, n in sizes:
                if first is not None and n > 2 * together:
                    break
                together, first = together + n, batch
            old = [(r.batch_id, r.part) for r in log.where((F.col("batch_id") >= F.lit(first)) & (F.col("batch_id") < upto_batch))
                   .select("batch_id", "part").distinct().collect()] if sizes else []
            snap = snap.where(F.col("batch_id") >= F.lit(first))
        if not old:
            return 0  # already folded (e.g. a retried micro-batch)
        # Materialise (reliable checkpoint in the shared checkpoint folder) so
        # the overwrite does not read the partitions it replaces.
        columns = [f.name for f in TABLE_SCHEMAS[name]]
        keys = list(TABLE_KEYS[name])
        folded = latest_by_key(snap.select(*columns, "batch_id"), keys, ["batch_id"]).select(*columns).checkpoint(eager=True)
        kept = self.commits(name).join(
            self.spark.createDataFrame(old, "batch_id bigint, part string"), ["batch_id", "part"], "left_anti")
        kept = kept.where(F.col("batch_id").isin(sorted({b for b, _ in old}))).checkpoint(eager=True)
        if lay.time_col in TABLE_KEYS[name]:
            # The batch keeps the hours that were not folded, and their measures.
            beside = [r.asDict() for r in self.commits(name).where(F.col("batch_id") == upto_batch)
                      .where(F.col("part").isNull() | ~F.col("part").isin(parts))
                      .select("part", "rows", "rejected", F.unix_micros("min_ts").alias("min_us"),
                              F.unix_micros("max_ts").alias("max_us"), "nulls").collect()]
            with fold_writes(self.spark, dynamic=True):
                self.write_batch(name, folded, upto_batch, beside=beside)
        else:
            with fold_writes(self.spark, dynamic=False):
                self.write_batch(name, folded, upto_batch)
        specs = [{"batch_id": str(b), lay.time_part: p} for b, p in old]
        if self.layout == "faithful":  # a drop names every partition column
            specs = [p for p in self.partitions(name) if (int(p["batch_id"]), p[lay.time_part]) in set(old)]
        for i in range(0, len(specs), 200):
            self.spark.sql(f"ALTER TABLE {self.qualified(name)} DROP IF EXISTS " + ", ".join(
                "PARTITION (" + ", ".join(f"`{k}` = {sql_string(v)}" for k, v in p.items()) + ")"
                for p in specs[i:i + 200]))
        self._recommit(name, kept, sorted({b for b, _ in old}))
        return len({b for b, _ in old})

    def _recommit(self, name: str, measures: DataFrame, batches: list[int]) -> None:
        """Replace the measures of a fold's batches; those without any left go."""
        commits = self.commits_table(name)
        left = {r.batch_id for r in measures.select("batch_id").distinct().collect()}
        measures.coalesce(1).createOrReplaceTempView(f"_popflow_commits_{name}")
        columns = ", ".join(f.name for f in COMMIT_SCHEMA)
        with fold_writes(self.spark, dynamic=True):
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.qualified(commits)} PARTITION (batch_id) "
                           f"SELECT {columns} FROM `_popflow_commits_{name}`")
        self.spark.catalog.dropTempView(f"_popflow_commits_{name}")
        gone = [b for b in batches if b not in left]
        if gone:
            self.spark.sql(f"ALTER TABLE {self.qualified(commits)} DROP IF EXISTS "
                           + ", ".join(f"PARTITION (batch_id = {b})" for b in gone))

    def commit_log(self, name: str) -> DataFrame:
        """One row per stored micro-batch: rows written and their time span.

        From the measures kept with each batch; a table written without them
        (another format) is scanned.
        """
        if self.exists(self.commits_table(name)):
            log = self.commits(name).groupBy("batch_id").agg(
                F.sum("rows").alias("rows"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))
        else:
            time = LAYOUTS[name].time_col
            log = self.table(name).groupBy("batch_id").agg(
                F.count(F.lit(1)).alias("rows"), F.min(time).alias("min_ts"), F.max(time).alias("max_ts"))
        # A batch without rows leaves nothing in the table.
        return log.where("rows > 0").select(F.lit(name).alias("table_name"), "batch_id", "rows", "min_ts", "max_ts")
