"""Continuous path: event stream -> five stateful aggregates -> changelog
tables.

Each view is its own ``StreamingQuery`` (update mode cannot share one query
across different keys), with its own checkpoint under the cluster's shared
checkpoint folder. Without a watermark, state is kept for every key and a
late event re-emits its window with the corrected value, as the reference's
materialized views do; pass ``watermark=`` to bound state in production.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from popflow.config import DEFAULT_WINDOW
from popflow.operators import views as V
from popflow.session import shared_dir
from popflow.sources.tables import TableStore

# Micro-batches between two folds of a changelog.
COMPACT_EVERY = 100

WINDOWED = ("realtime_scores", "balloon_colored_pops", "color_performance_trends")


def view_frame(name: str, events: DataFrame, width: str = DEFAULT_WINDOW,
               watermark: str | None = None) -> DataFrame:
    fn = V.VIEWS[name]
    return fn(events, width, watermark) if name in WINDOWED else fn(events)


@contextmanager
def state_partitions_of(spark: SparkSession, n: int | None) -> Iterator[None]:
    """Queries started inside keep their state in ``n`` partitions (None: as the session has it)."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if n:
        # A query takes a copy of the session conf when it starts.
        spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def changelog_writer(store: TableStore, name: str, compact_every: int | None = None):
    """``foreachBatch`` function appending one micro-batch idempotently.

    With ``compact_every=K``, every K-th batch N also folds the batches
    before it (all committed: N starts after N-1 is done) into batch N-1, so
    the changelog stays about one row per key plus the last K batches of
    updates, and current-state reads scan that instead of all history.
    Compaction is idempotent and crash-safe (see ``TableStore.compact``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(name, batch, batch_id)
        if compact_every and batch_id > 0 and batch_id % compact_every == 0:
            store.compact(name, batch_id - 1)

    return write


def start_views(events: DataFrame, store: TableStore,
                checkpoint_root: str | None = None,
                names: Sequence[str] | None = None,
                width: str = DEFAULT_WINDOW, watermark: str | None = None,
                trigger: dict | None = None,
                compact_every: int | None = COMPACT_EVERY,
                state_partitions: int | None = None) -> dict[str, StreamingQuery]:
    """Start one update-mode query per view, each sinking to its changelog
    table. ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"processingTime": "5 seconds"}`` or ``{"availableNow": True}``);
    ``compact_every`` is the sink's compaction policy: it bounds the batch
    partitions of a table, at the price of as-of reads before the last fold;
    ``None`` keeps every batch for ever.

    ``state_partitions`` sets the number of state-store partitions of a new
    query (default: ``spark.sql.shuffle.partitions``). Every micro-batch
    commits each state partition, so for a low-volume live stream fewer
    partitions means lower latency; size it to the state and cluster for
    high volume. A restarted query keeps the count in its checkpoint.
    """
    spark: SparkSession = events.sparkSession
    store.create_view_tables(names)
    root = checkpoint_root or shared_dir(spark, "streams", store.namespace)
    out = {}
    with state_partitions_of(spark, state_partitions):
        for name in names or list(V.VIEWS):
            w = (view_frame(name, events, width, watermark).writeStream
                 .queryName(f"{store.namespace}.{name}")
                 .outputMode("update")
                 .option("checkpointLocation", f"{root.rstrip('/')}/{name}")
                 .foreachBatch(changelog_writer(store, name, compact_every)))
            if trigger:
                w = w.trigger(**trigger)
            out[name] = w.start()
    return out


def start_rejects(rejects: DataFrame, path: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Append rejected payloads (with their reason) to Parquet files at
    ``path``: the direct topology's counterpart of the ingest table, which
    keeps them beside the events."""
    w = (rejects.writeStream.format("parquet").queryName("popflow.rejects")
         .option("path", path).option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def await_all(queries: dict[str, StreamingQuery], timeout: float | None = None) -> None:
    for q in queries.values():
        q.awaitTermination(timeout)
        if q.exception():
            raise q.exception()


def list_pipeline(spark: SparkSession, store: TableStore,
                  ingest_name: str = "popflow.ingest") -> dict[str, list]:
    """Sources, running ingest and view queries and sink tables of the
    pipeline."""
    active = [q for q in spark.streams.active
              if (q.name or "").startswith(f"{store.namespace}.") or q.name == ingest_name]
    return {
        "queries": [{"name": q.name, "id": str(q.id), "active": q.isActive,
                     "status": q.status.get("message")} for q in active],
        "sources": sorted({s.get("description", "") for q in active
                           for s in (q.lastProgress or {}).get("sources", [])}),
        "tables": [t for t in store.list_tables() if not t.endswith(("_commits", "_rejects"))],
    }
