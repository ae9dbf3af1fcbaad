"""Replay a table of events through the streaming views.

The events are encoded as JSON lines (the stream's wire format) into files
sized from the data, each a contiguous slice of event time as a live stream
would deliver them (or, shuffled, with late events in every slice), and drained
with ``availableNow`` in a few micro-batches into changelog tables. Used to run the continuous path end to
end on the driver's data (registered stream queries, bench).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popflow.functions.expressions import utc_instant
from popflow.session import shared_dir
from popflow.sources.events import StreamConfig, encode_events, read_events_stream
from popflow.sources.events import read_raw_stream, write_events
from popflow.sources.tables import TableStore
from popflow.streaming.fanout import start_fanout
from popflow.streaming.pipeline import await_all, start_rejects, start_views

EVENT_COLUMNS = ("player", "balloon_color", "score", "favorite_color_bonus", "event_ts")


# Events per staged file, and time slices (micro-batches) of a replay.
EVENTS_PER_FILE = 500_000
SLICES = 4


def _wire_events(events: DataFrame) -> DataFrame:
    """The event columns with instants; zone-less event times are UTC wall clock."""
    ts = F.col("event_ts")
    if dict(events.dtypes)["event_ts"] == "timestamp_ntz":
        ts = utc_instant(ts)
    return events.select(*[c for c in EVENT_COLUMNS if c != "event_ts"], ts.alias("event_ts"))


def stage_events(events: DataFrame, n_files: int | None = None, base: str | None = None,
                 shuffled: bool = False) -> str:
    """Write ``events`` as JSON-line files in event-time order; returns the
    run folder (``base`` defaults to a fresh folder under the cluster's shared
    checkpoint location). Without ``n_files`` the counted rows set it: SLICES
    slices of as many files as hold EVENTS_PER_FILE events each. ``shuffled``
    deals the events by a hash instead, so later files hold late events."""
    spark = events.sparkSession
    base = (base or shared_dir(spark, "replay")).rstrip("/") + f"/{uuid.uuid4().hex[:12]}"
    ev = _wire_events(events)
    if n_files is None:
        n_files = SLICES * max(1, -(-events.count() // (SLICES * EVENTS_PER_FILE)))
    dealt = (ev.repartition(n_files, F.xxhash64(*ev.columns)) if shuffled
             else ev.repartitionByRange(n_files, "event_ts").sortWithinPartitions("event_ts"))
    encode_events(dealt, key_col=None).write.text(f"{base}/src")
    return base


def staged_stream(spark: SparkSession, base: str, slices: int = SLICES) -> DataFrame:
    """The accepted events of the staged files as a stream of about ``slices`` micro-batches."""
    files = len(spark.read.text(f"{base}/src").inputFiles())
    return read_events_stream(spark, StreamConfig(format="json", path=f"{base}/src",
                                                  max_files_per_trigger=max(1, -(-files // slices)))).events


def state_partition_count(spark: SparkSession) -> int:
    """No more state partitions than cores: one wave of commits per batch."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def drain(spark: SparkSession, base: str, names=None, width: str | None = None,
          compact_every: int | None = None,
          state_partitions: int | None = None,
          ingest: bool = False, timings: dict | None = None,
          slices: int = SLICES, one_read: bool = False) -> TableStore:
    """Run the views over the staged files as a stream until drained;
    returns the store with their changelogs.

    Directly (each view query decodes the JSON, ``slices`` micro-batches;
    rejected payloads go to ``<base>/rejects``), or with ``ingest=True`` through the ingest stage: one query decodes the
    files into a typed events table, then the views stream that table in
    about as many micro-batches. With ``one_read=True`` one query maintains all
    views. ``timings`` receives seconds per stage.
    """
    import time

    from popflow.streaming.ingest import read_ingested, start_ingest

    timings = {} if timings is None else timings
    if state_partitions is None:
        state_partitions = state_partition_count(spark)
    run = base.rstrip("/").rsplit("/", 1)[-1]
    store = TableStore(spark, f"replay_{run}", location=f"{base}/tables")
    n_src = len(spark.read.text(f"{base}/src").inputFiles())
    per_batch = max(1, -(-n_src // slices))
    t0 = time.perf_counter()
    if ingest:
        raw = read_raw_stream(spark, StreamConfig(format="json", path=f"{base}/src",
                                                  max_files_per_trigger=per_batch))
        await_all({"ingest": start_ingest(raw, f"{base}/events", f"{base}/checkpoints/ingest",
                                          trigger={"availableNow": True})})
        timings["ingest_sec"] = time.perf_counter() - t0
        n_out = len(spark.read.parquet(f"{base}/events").inputFiles())
        stream = read_ingested(spark, f"{base}/events",
                               max_files_per_trigger=max(1, -(-n_out // slices)))
    else:
        stream = read_events_stream(spark, StreamConfig(format="json", path=f"{base}/src",
                                                        max_files_per_trigger=per_batch))
        await_all({"rejects": start_rejects(stream.rejects, f"{base}/rejects",
                                            f"{base}/checkpoints/rejects",
                                            trigger={"availableNow": True})})
    t1 = time.perf_counter()
    kwargs = {"width": width} if width else {}
    start = start_fanout if one_read else start_views
    queries = start(stream.events, store, checkpoint_root=f"{base}/checkpoints",
                    names=names, trigger={"availableNow": True},
                    compact_every=compact_every, state_partitions=state_partitions,
                    **kwargs)
    await_all({"views": queries} if one_read else queries)
    timings["views_sec"] = time.perf_counter() - t1
    return store


def replay_events(events: DataFrame, names=None, n_files: int | None = None,
                  base: str | None = None, width: str | None = None,
                  compact_every: int | None = None, shuffled: bool = False) -> TableStore:
    """Stage ``events`` as JSON files and drain them through the views."""
    return drain(events.sparkSession, stage_events(events, n_files, base, shuffled), names, width,
                 compact_every)


def follow_log(before: DataFrame, live: DataFrame, missed: DataFrame, names, base: str | None = None,
               partitions: int = 4, width: str | None = None) -> TableStore:
    """Views started at the latest offset of an event log, stopped and started again.

    ``before`` is in the log already when the queries first start, ``live``
    arrives while they run, ``missed`` while they are stopped; then they are
    started again from their checkpoints until nothing is left. The tables hold
    what a subscriber at "latest" sees: ``live`` and ``missed``.
    """
    spark = live.sparkSession
    base = (base or shared_dir(spark, "follow")).rstrip("/") + f"/{uuid.uuid4().hex[:12]}"
    cfg = StreamConfig(format="log", path=f"{base}/log", starting_offsets="latest",
                       start_file=f"{base}/checkpoints/start.json", partitions=partitions)
    store = TableStore(spark, f"follow_{base.rsplit('/', 1)[-1]}", location=f"{base}/tables")
    state = state_partition_count(spark)
    kwargs = {"width": width} if width else {}

    def run(while_running: DataFrame | None) -> None:
        queries = start_views(read_events_stream(spark, cfg).events, store, f"{base}/checkpoints", names,
                              compact_every=None, state_partitions=state, **kwargs)
        try:
            if while_running is not None:
                write_events(_wire_events(while_running), cfg)
            for query in queries.values():
                query.processAllAvailable()
        finally:
            for query in queries.values():
                query.stop()

    write_events(_wire_events(before), cfg)
    run(live)
    write_events(_wire_events(missed), cfg)
    run(None)
    return store
