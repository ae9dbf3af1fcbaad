"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full (``noop`` sink: the whole plan runs, nothing
is collected), warm JVM, median of $BENCH_REPEATS runs. Then, unless
BENCH_STREAM=0, the same events are replayed as JSON files through the five
streaming views into their changelog tables (``availableNow``, four
micro-batches), directly and through the ingest stage, and each drained
replay is reported as rows/s. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from popflow.plans.registry import QUERIES  # noqa: E402
from popflow.session import get_session  # noqa: E402

STREAM_FILES = 4


def stream_replay(spark, sf_dir: str) -> dict:
    """Drain the sf's events through the five views; rows/s end to end
    (JSON decode, stateful aggregation, changelog writes). The JSON files are
    staged before the clock starts."""
    from popflow.sources.events import game_events
    from popflow.streaming.replay import drain, stage_events

    ev = game_events(spark, sf_dir)
    rows = ev.count()
    out = {"rows": rows, "micro_batches": STREAM_FILES, "views": 5}
    # warm-up (state store libraries, stateful codegen, file sink) so neither
    # mode pays it
    drain(spark, stage_events(ev.limit(2000), 2)).drop_namespace()
    # direct: every view query decodes the JSON; ingest: decode once into a
    # typed table, views stream from it; one_read: one query maintains all views
    for mode in ("direct", "ingest", "one_read"):
        base = stage_events(ev, STREAM_FILES)
        timings: dict = {}
        t0 = time.perf_counter()
        # one state partition per core: a single wave of state commits per batch
        store = drain(spark, base, state_partitions=spark.sparkContext.defaultParallelism,
                      ingest=mode == "ingest", one_read=mode == "one_read", timings=timings)
        sec = time.perf_counter() - t0
        store.drop_namespace()
        out[mode] = {"sec": round(sec, 4), "rows_per_sec": round(rows / sec, 1),
                     **{k: round(v, 4) for k, v in timings.items()}}
    return out


def stream_latency(spark, sf_dir: str, events_per_batch: int = 20, batches: int = 6) -> dict:
    """Per-micro-batch latency of a live-sized stream: small batches through
    the leaderboard view into its changelog (median after the first)."""
    from popflow.session import shared_dir
    from popflow.sources.events import StreamConfig, game_events, read_events_stream
    from popflow.sources.tables import TableStore
    from popflow.streaming.pipeline import await_all, start_views
    from popflow.streaming.replay import stage_events

    # a live batch is small by definition: the probe takes that many events
    ev = game_events(spark, sf_dir).limit(events_per_batch * batches)
    base = stage_events(ev, batches, base=shared_dir(spark, "bench-latency"))
    store = TableStore(spark, "bench_latency_" + base.rsplit("/", 1)[-1],
                       location=f"{base}/tables")
    stream = read_events_stream(spark, StreamConfig(format="json", path=f"{base}/src",
                                                    max_files_per_trigger=1))
    qs = start_views(stream.events, store, checkpoint_root=f"{base}/checkpoints",
                     names=["leaderboard"], trigger={"availableNow": True},
                     state_partitions=spark.sparkContext.defaultParallelism)
    await_all(qs)
    ms = [p["durationMs"]["triggerExecution"] for p in qs["leaderboard"].recentProgress]
    store.drop_namespace()
    return {"events_per_batch": events_per_batch, "batches": len(ms),
            "median_batch_ms": statistics.median(ms[1:] or ms), "first_batch_ms": ms[0]}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [a for a in sys.argv[1:]]
    spark = get_session(f"local[{cpus}]", "popflow-bench", {
        "spark.sql.shuffle.partitions": str(max(2 * cpus, 8)),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    qs = dict(QUERIES)
    names = only or list(qs)

    # warm-up: JVM, code caches, file metadata
    for name in names[:3]:
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    results: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 4)
    stream = None
    if os.environ.get("BENCH_STREAM", "1") != "0" and not only:
        try:
            stream = stream_replay(spark, sf_dir)
        except Exception as e:  # noqa: BLE001  (keep the batch numbers)
            stream = {"error": f"{type(e).__name__}: {str(e)[:300]}"}
    latency = None
    if os.environ.get("BENCH_STREAM", "1") != "0" and not only:
        try:
            latency = stream_latency(spark, sf_dir)
        except Exception as e:  # noqa: BLE001
            latency = {"error": f"{type(e).__name__}: {str(e)[:300]}"}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    out = {
        "metric": "total_median_query_seconds",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }
    if stream:
        out["stream_replay"] = stream
    if latency:
        out["stream_latency"] = latency
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
