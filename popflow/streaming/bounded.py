"""Totals per key with bounded state, in which no late event is lost.

The views keep a state row for every key for ever, or, with a watermark, drop
what comes later than it. Here a key that has been idle for some time leaves the
state, and its total so far stays in the table as one of the key's *lives*. An
event that arrives within that time corrects the life it belongs to; a later one
starts the key's next life. The lives of a key add up (sums, counts and the
latest time are mergeable), so reads are exact however late an event is, and the
state holds the keys of the last while only.

A hot key is dealt over several salts, each with lives of its own: its events
need not meet in one task.

A call of the state function costs some milliseconds whatever it adds up, so the
keys are dealt by a hash into buckets: one call, and one state row, holds the
lives of a bucket's keys, each with its own idle time, and adds a micro-batch to
all of them at once. Some thousands of active keys a bucket keep a state row small.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from popflow.operators.performance import interval_micros
from popflow.operators.ranking import latest_by_key
from popflow.sources.tables import TableStore
from popflow.streaming.pipeline import state_partitions_of

#: A bucket's lives, a column each: totals, when each life began and when its key came last (ms).
LIVES = ("salt", "points", "scored", "pops", "bonus_hits", "last_us", "life", "arrived")
SUMS, LATEST = ["points", "scored", "pops", "bonus_hits"], ["last_us", "arrived"]
TOTALS = T.StructType([T.StructField(c, T.LongType()) for c in
                       ("life", "points", "scored", "pops", "bonus_hits", "last_us")])
TABLE = "bounded_totals"
#: Stands for the time of an event without one.
NO_TIME = -(1 << 63)
#: State rows that the keys are dealt over, fixed for a checkpoint.
BUCKETS = 1024
#: Rows of a bucket that are held before they are added up.
ROWS_HELD = 100_000


def _add(keys: list[str], idle_ms: int):
    """Adds a micro-batch's events to the lives of a bucket's keys; the timeout ends idle ones."""
    by = [*keys, "salt"]
    columns = [*keys, *LIVES]

    def added(rows: list[pd.DataFrame]) -> pd.DataFrame:
        groups = pd.concat(rows).groupby(by, sort=False, dropna=False)
        out = groups[SUMS].sum()
        out[LATEST] = groups[LATEST].max().to_numpy()  # the groups come in one order
        out["life"] = groups["life"].min().to_numpy()
        return out.reset_index()

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = [pd.DataFrame(dict(zip(columns, state.get)))] if state.exists else []
        now, most = None, ROWS_HELD
        for part in [] if state.hasTimedOut else parts:
            # whole numbers without nulls, but for the keys
            now = max(now or 0, int(part["arrived"].max()))
            rows.append(part.assign(pops=1, life=part["arrived"])[columns])
            if sum(map(len, rows)) > most:
                rows = [added(rows)]
                most = max(ROWS_HELD, 2 * len(rows[0]))
        held = rows[0] if now is None else added(rows)
        # idle keys leave: their last row is in the table already
        stays = held["arrived"].to_numpy() + idle_ms >= state.getCurrentWatermarkMs()
        if not stays.any():
            state.remove()
            return
        held = held if stays.all() else held[stays]
        names = {k: [None if v is None or v != v else v for v in held[k]] for k in keys}
        state.update(tuple(names[c] if c in names else held[c].tolist() for c in columns))
        state.setTimeoutTimestamp(int(held["arrived"].min()) + idle_ms)
        if now is not None:
            last = held["last_us"].to_numpy()
            out = pd.DataFrame({**names, **{c: held[c] for c in ("salt", *TOTALS.names)},
                                "last_us": pd.arrays.IntegerArray(last, last == NO_TIME)})
            new = held["arrived"].to_numpy() == now
            yield out if new.all() else out[new]

    return run


def lives(events: DataFrame, keys: list[str], idle: str, salts: int = 4, buckets: int = BUCKETS) -> DataFrame:
    """Updated lives per (keys, salt): a stream of ``TOTALS`` rows.

    Time here is the events' arrival, one instant per micro-batch: the watermark
    follows it, so it ends idle lives and no event is ever behind it.
    """
    # The function travels to the workers by value: they need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    # Keys are kept as text, which holds a null beside whole numbers.
    fed = events.select(*[F.col(k).cast("string").alias(k) for k in keys],
                        F.pmod(F.xxhash64("event_ts", "score"), F.lit(salts)).cast("int").alias("salt"),
                        F.coalesce("score", F.lit(0)).cast("long").alias("points"),
                        F.col("score").isNotNull().cast("long").alias("scored"),
                        F.coalesce("favorite_color_bonus", F.lit(False)).cast("long").alias("bonus_hits"),
                        F.coalesce(F.unix_micros("event_ts"), F.lit(NO_TIME)).alias("last_us"),
                        F.current_timestamp().alias("at")).withWatermark("at", "0 seconds")
    fed = fed.withColumn("arrived", F.unix_millis("at")).withColumn(
        "bucket", F.pmod(F.xxhash64(*keys, "salt"), F.lit(buckets)).cast("int"))
    schema = T.StructType([*[fed.schema[k] for k in keys], fed.schema["salt"], *TOTALS.fields])
    state = T.StructType([*[T.StructField(k, T.ArrayType(T.StringType())) for k in keys],
                          *[T.StructField(c, T.ArrayType(T.LongType())) for c in LIVES]])
    out = fed.groupBy("bucket").applyInPandasWithState(
        _add(keys, interval_micros(idle) // 1000), schema, state, "update", GroupStateTimeout.EventTimeTimeout)
    return out.select(*[F.col(k).cast(events.schema[k].dataType).alias(k) for k in keys], "salt", *TOTALS.names)


def start_bounded(events: DataFrame, store: TableStore, keys: list[str], checkpoint: str, idle: str = "1 day",
                  salts: int = 4, trigger: dict | None = None, buckets: int = BUCKETS,
                  state_partitions: int | None = None) -> StreamingQuery:
    """Maintain the totals per ``keys`` in the store's changelog of lives.

    ``idle`` counts from a key's last arrival; its time runs out in the first
    micro-batch behind it. A micro-batch that is retried replaces its own rows.
    ``buckets`` is sized to the keys that are active at a time and stays with the
    checkpoint; ``state_partitions`` as for :func:`popflow.streaming.pipeline.start_views`.
    """
    out = lives(events, keys, idle, salts, buckets)
    store.create_namespace()
    schema = T.StructType([*out.schema.fields, T.StructField("batch_id", T.LongType())])
    store.create_table(TABLE, schema, ["batch_id"])
    view = f"_popflow_bounded_{store.namespace}"
    columns = ", ".join(f"`{c}`" for c in out.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.createOrReplaceTempView(view)
        batch.sparkSession.sql(f"INSERT OVERWRITE TABLE {store.qualified(TABLE)} PARTITION (batch_id={int(batch_id)}) "
                               f"SELECT {columns} FROM `{view}`")
        batch.sparkSession.catalog.dropTempView(view)

    w = (out.writeStream.queryName(f"{store.namespace}.bounded").outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(write))
    if trigger:
        w = w.trigger(**trigger)
    with state_partitions_of(events.sparkSession, state_partitions):
        return w.start()


def bounded_totals(store: TableStore, keys: list[str]) -> DataFrame:
    """keys, total_score, pops, bonus_hits, event_ts: every key's lives added up."""
    last = latest_by_key(store.table(TABLE), [*keys, "salt", "life"], ["batch_id"])
    return last.groupBy(*keys).agg(
        # without any score there is no total, as in the views
        F.when(F.sum("scored") > 0, F.sum("points")).alias("total_score"), F.sum("pops").alias("pops"),
        F.sum("bonus_hits").alias("bonus_hits"), F.timestamp_micros(F.max("last_us")).alias("event_ts"))
