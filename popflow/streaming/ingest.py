"""Ingest once, fan out: decode the raw stream into a typed events table.

Five view queries reading the raw topic would each parse every JSON payload
(the most expensive per-row step of the pipeline) and each re-read the
topic. Instead one query decodes each payload once and appends the typed
rows, rejected payloads included (with their reason), to a Parquet table
through the file sink, whose metadata log makes it exactly-once; the views
then stream from that table, reading only committed files and only the
columns they use. The table also serves batch backfills and replays
without the topic's retention limits.

    raw = read_raw_stream(spark, StreamConfig(format="kafka", ...))
    ingest = start_ingest(raw, f"{base}/events")
    events = read_ingested(spark, f"{base}/events")
    views = start_views(events.events, store)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from popflow.functions.expressions import utc_day
from popflow.session import shared_dir
from popflow.sources.events import TAGGED_SCHEMA, Decoded, split_tagged, tag_events

# Partition column of the events table: the UTC day of the event (NULL for a
# payload without a usable timestamp).
INGEST_DAY = "event_day"
INGESTED_SCHEMA = T.StructType(list(TAGGED_SCHEMA.fields)
                               + [T.StructField(INGEST_DAY, T.DateType(), True)])


def start_ingest(raw: DataFrame, path: str, checkpoint: str | None = None,
                 value_col: str = "value", trigger: dict | None = None,
                 name: str = "popflow.ingest") -> StreamingQuery:
    """Decode ``raw`` payloads once and append them to the events table at
    ``path`` (Parquet, partitioned by event day)."""
    spark = raw.sparkSession
    ck = checkpoint or shared_dir(spark, "streams", "ingest", name)
    tagged = tag_events(raw, value_col).withColumn(INGEST_DAY, utc_day("event_ts"))
    w = (tagged.writeStream.format("parquet")
         .queryName(name)
         .outputMode("append")
         .partitionBy(INGEST_DAY)
         .option("path", path)
         .option("checkpointLocation", ck))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_ingested(spark: SparkSession, path: str,
                  max_files_per_trigger: int | None = None) -> Decoded:
    """The events table as a stream of accepted events (and of rejects)."""
    reader = spark.readStream.schema(INGESTED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return split_tagged(reader.parquet(path))


def read_ingested_table(spark: SparkSession, path: str) -> Decoded:
    """The events table as a batch (committed files only); filters on
    ``event_ts`` can add ``event_day`` bounds to prune partitions."""
    return split_tagged(spark.read.schema(INGESTED_SCHEMA).parquet(path))
