"""Empty windows of an event stream, emitted as time passes them by.

The views emit a window when it has events. A panel of fixed bins also needs the
others: this query watches which windows of a series have events and emits the
stretches between them that have none; an event-time timer closes the windows
that the watermark has passed while the series was silent (other series' events
move it on). A stretch is one row, however long.

State is two window numbers per series. Only the first event of a window within
the watermark's delay reaches it, so its input grows with time, not with the
events. An event that comes later than its window was emitted is no conflict:
reads take a stretch as zeros that any data outweigh.

An event behind the watermark opens no window here: the delay (``lateness``) has
to cover the disorder of the source.
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

from popflow.config import DEFAULT_WINDOW
from popflow.operators.performance import interval_micros
from popflow.sources.tables import TableStore
from popflow.streaming.pipeline import state_partitions_of

TABLE = "empty_windows"
#: A stretch without events: first and last window number since 1970.
STRETCH = T.StructType([T.StructField("series", T.StringType()), T.StructField("first", T.LongType()),
                        T.StructField("last", T.LongType())])
STATE = "low long, high long"


def _watch(width_us: int):
    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        low, high = state.get if state.exists else (None, None)
        found: list[tuple[int, int]] = []
        passed = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            closed = passed * 1000 // width_us - 1  # the last window that is over
            if closed > high:
                found.append((high + 1, closed))
                high = closed
        else:
            for w in sorted({int(w) for part in parts for w in part["window"]}):
                if low is None:
                    low = high = w
                elif w > high:
                    if w > high + 1:
                        found.append((high + 1, w - 1))
                    high = w
                elif w < low:
                    if w < low - 1:
                        found.append((w + 1, low - 1))
                    low = w
        state.update((low, high))
        # when the window behind the last known one is over
        state.setTimeoutTimestamp(max(-(-(high + 2) * width_us // 1000), passed + 1))
        if found:
            yield pd.DataFrame({"series": [key[0]] * len(found), "first": [a for a, _ in found], "last": [b for _, b in found]})

    return run


def empty_stretches(events: DataFrame, width: str = DEFAULT_WINDOW, series: str | None = None,
                    lateness: str = "1 hour") -> DataFrame:
    """A stream of ``STRETCH`` rows per series (a column, or all events as one)."""
    # The function travels to the workers by value: they need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    width_us = interval_micros(width)
    window = F.floor(F.unix_micros("event_ts") / F.lit(width_us)).cast("long")
    seen = (events.where("event_ts is not null").withWatermark("event_ts", lateness)
            .select((F.col(series).cast("string") if series else F.lit("all")).alias("series"), window.alias("window"), "event_ts")
            .dropDuplicatesWithinWatermark(["series", "window"]))
    return seen.groupBy("series").applyInPandasWithState(
        _watch(width_us), STRETCH, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def start_gaps(events: DataFrame, store: TableStore, checkpoint: str, width: str = DEFAULT_WINDOW, series: str | None = None,
               lateness: str = "1 hour", trigger: dict | None = None,
               state_partitions: int | None = None) -> StreamingQuery:
    """Keep the empty stretches in the store; a retried micro-batch replaces its own.

    ``state_partitions`` as for :func:`popflow.streaming.pipeline.start_views`.
    """
    store.create_namespace()
    store.create_table(TABLE, T.StructType([*STRETCH.fields, T.StructField("batch_id", T.LongType())]), ["batch_id"])
    view = f"_popflow_gaps_{store.namespace}"

    def write(batch: DataFrame, batch_id: int) -> None:
        # One file a batch, behind a shuffle: a coalesce would run the state partitions one after another in one task.
        batch.repartition(1).createOrReplaceTempView(view)
        batch.sparkSession.sql(f"INSERT OVERWRITE TABLE {store.qualified(TABLE)} PARTITION (batch_id={int(batch_id)}) "
                               f"SELECT series, first, last FROM `{view}`")
        batch.sparkSession.catalog.dropTempView(view)

    w = (empty_stretches(events, width, series, lateness).writeStream.queryName(f"{store.namespace}.gaps")
         .outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write))
    if trigger:
        w = w.trigger(**trigger)
    with state_partitions_of(events.sparkSession, state_partitions):
        return w.start()


def stored_stretches(store: TableStore, series: str = "all") -> DataFrame:
    """first, last of a series' stretches."""
    return store.table(TABLE).where(F.col("series") == series).select("first", "last")
