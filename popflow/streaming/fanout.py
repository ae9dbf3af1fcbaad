"""One maintained source for all views.

``start_views`` runs a query per view, and each reads (and, without the ingest
stage, decodes) every event. Here one query reads each micro-batch once, keeps
one state store for the rows of all views, and its sink deals the updated rows
to the views' changelog tables. Update mode sees one key, (view, keys of that
view), so one query can serve views of different keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from popflow.config import DEFAULT_WINDOW
from popflow.operators import views as V
from popflow.session import shared_dir
from popflow.sources.tables import TableStore
from popflow.streaming.pipeline import COMPACT_EVERY


def fanout_writer(store: TableStore, names: Sequence[str], width: str, compact_every: int | None):
    """``foreachBatch`` function: the batch is computed once, then routed per view.

    Every table's write replaces that batch's own rows, so a batch that is
    retried after some of the tables were written repeats them all alike.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            def write_one(name: str) -> None:
                store.write_batch(name, V.from_fan(name, rows, width), batch_id, persist=False)

            # Small writes are bound by commits: the tables' jobs run side by side.
            with ThreadPoolExecutor(len(names)) as pool:
                for done in [pool.submit(inheritable_thread_target(batch.sparkSession)(write_one), name) for name in names]:
                    done.result()
            if compact_every and batch_id > 0 and batch_id % compact_every == 0:
                for name in names:
                    store.compact(name, batch_id - 1)
        finally:
            rows.unpersist()

    return write


def start_fanout(events: DataFrame, store: TableStore, checkpoint_root: str | None = None,
                 names: Sequence[str] | None = None, width: str = DEFAULT_WINDOW, trigger: dict | None = None,
                 compact_every: int | None = COMPACT_EVERY, state_partitions: int | None = None) -> StreamingQuery:
    """Start the one query that maintains all views (or ``names``).

    Options as for :func:`popflow.streaming.pipeline.start_views`. State is kept
    for every key, so late events correct their windows; the state partitions
    hold the rows of all views together.
    """
    spark = events.sparkSession
    names = list(names or V.VIEWS)
    store.create_view_tables(names)
    root = (checkpoint_root or shared_dir(spark, "streams", store.namespace)).rstrip("/")
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if state_partitions:
        spark.conf.set(key, str(state_partitions))  # a query takes a copy when it starts
    try:
        w = (V.fan_out(events, width, names).writeStream.queryName(f"{store.namespace}.views")
             .outputMode("update").option("checkpointLocation", f"{root}/views")
             .foreachBatch(fanout_writer(store, names, width, compact_every)))
        if trigger:
            w = w.trigger(**trigger)
        return w.start()
    finally:
        spark.conf.set(key, before)
