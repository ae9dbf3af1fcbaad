"""Event sources: the testdata adapter, JSON decode/encode, stream readers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popflow.config import DEFAULT_CONFIG, GameConfig
from popflow.schemas import EVENT_SCHEMA, SOURCE_SCHEMAS
from popflow.sources.eventlog import append_log, stream_log

# ISO-8601 with microseconds and a zone suffix ("Z" for UTC). The default
# JSON timestamp format keeps milliseconds only.
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Adapter from the driver's generic ``events`` table to game events.
# event_type -> balloon colour.
EVENT_TYPE_COLORS = {
    "click": "red",
    "view": "blue",
    "purchase": "gold",
    "signup": "green",
}
OTHER_EVENT_COLOR = "black"


def read_table_file(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet input table ``<sf_dir>/<name>.parquet``; tables with a
    declared schema are read with it (no schema-inference job)."""
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sql_string(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def event_color_sql(col: str = "event_type") -> str:
    """``CASE`` mapping an event type to its balloon colour."""
    whens = " ".join(f"WHEN {sql_string(k)} THEN {sql_string(v)}"
                     for k, v in EVENT_TYPE_COLORS.items())
    return f"CASE {col} {whens} ELSE {sql_string(OTHER_EVENT_COLOR)} END"


def game_events(spark: SparkSession, sf_dir: str,
                config: GameConfig = DEFAULT_CONFIG) -> DataFrame:
    """``game_events``: the driver's ``events`` table seen as balloon pops.

    Columns: event_id, player, char_id, balloon_color, score,
    favorite_color_bonus, event_ts (timestamp_ntz, as stored). A pure
    projection: Catalyst prunes the scan to the source columns a query uses
    (the JSON in ``props`` is only parsed when the bonus flag is needed) and
    pushes any later filter on ``event_ts`` into the Parquet reader.

    Written as SQL expressions: one analyzer call instead of a JVM round trip
    per Column node, which is most of the time it takes to build a query.
    """
    ev = read_table_file(spark, sf_dir, "events")
    n_chars = len(config.characters)
    return ev.selectExpr(
        "event_id",
        "concat('player_', CAST(user_id AS STRING)) AS player",
        f"CAST(user_id % {n_chars} AS INT) AS char_id",
        f"{event_color_sql('event_type')} AS balloon_color",
        "CAST(floor(value) AS INT) AS score",
        "(CAST(get_json_object(props, '$.k') AS INT) % 7 = 0) AS favorite_color_bonus",
        "ts AS event_ts",
    )


# --------------------------------------------------------------------------
# JSON decode / encode (the stream's wire format)
# --------------------------------------------------------------------------

_CORRUPT = "_corrupt_record"


@dataclass
class Decoded:
    """Result of :func:`decode_events`: typed rows and rejected payloads."""

    events: DataFrame
    rejects: DataFrame


# A decoded payload: the event fields, plus why it was rejected (NULL when
# accepted) and the raw payload (kept for rejects only).
REJECT_REASON = "reject_reason"
PAYLOAD = "payload"
TAGGED_SCHEMA = T.StructType(list(EVENT_SCHEMA.fields) + [
    T.StructField(REJECT_REASON, T.StringType(), True),
    T.StructField(PAYLOAD, T.StringType(), True),
])


def tag_events(df: DataFrame, value_col: str = "value", schema=EVENT_SCHEMA,
               required=()) -> DataFrame:
    """Parse JSON payloads into typed rows (absent fields NULL), one row per
    payload, with ``reject_reason`` set for malformed payloads (or for missing
    fields named in ``required``; by default no field is, since each view uses
    other fields). Batch and streaming alike."""
    raw = F.col(value_col).cast("string")
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(_CORRUPT, T.StringType())])
    parsed_struct = F.from_json(
        raw, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # Parse exactly once per payload. A plain projection would let the
    # optimizer push an accept/reject filter below it and inline from_json
    # into the predicate once per referenced field; filters on a generator's
    # output stay above the generator, so the one-element ``inline`` pins the
    # parse to a single evaluation.
    parsed = df.select(F.inline(F.array(F.struct(raw.alias("_raw"),
                                                 parsed_struct.alias("_e")))))
    missing = [F.when(F.col(f"_e.{c}").isNull(), F.lit(c)) for c in required]
    reason = (F.when(F.col("_e").isNull() | F.col(f"_e.{_CORRUPT}").isNotNull(),
                     F.lit("malformed"))
              .otherwise(F.nullif(F.concat_ws(",", *missing), F.lit(""))))
    return parsed.select(*[F.col(f"_e.{f.name}").alias(f.name) for f in schema.fields],
                         reason.alias(REJECT_REASON),
                         F.when(reason.isNotNull(), F.col("_raw")).alias(PAYLOAD))


def split_tagged(tagged: DataFrame, schema=EVENT_SCHEMA) -> Decoded:
    """Accepted events and rejected payloads of a tagged frame."""
    ok = tagged.where(F.col(REJECT_REASON).isNull()).select(*[f.name for f in schema.fields])
    bad = tagged.where(F.col(REJECT_REASON).isNotNull()).select(
        PAYLOAD, F.col(REJECT_REASON).alias("reason"))
    return Decoded(ok, bad)


def decode_events(df: DataFrame, value_col: str = "value", schema=EVENT_SCHEMA,
                  required=()) -> Decoded:
    """Parse JSON payloads into typed rows; absent fields become NULL.

    Malformed payloads go to ``rejects`` (with the raw payload and a reason)
    instead of being silently turned into NULL rows. An event without some
    field counts in every view that does not need it; the changelog sink sets
    aside result rows whose own required columns are NULL. Works on batch and
    streaming DataFrames alike.
    """
    return split_tagged(tag_events(df, value_col, schema, required), schema)


def encode_events(df: DataFrame, key_col: str | None = "player") -> DataFrame:
    """Encode event rows as JSON ``value`` (and ``key``) columns.

    Timestamps keep microseconds and an explicit zone, so a decode of the
    encoded rows returns exactly the input.
    """
    cols = [c for c in df.columns]
    out = [F.to_json(F.struct(*cols), {"timestampFormat": ISO_TS_FORMAT}).alias("value")]
    if key_col:
        out.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*out)


# --------------------------------------------------------------------------
# Stream readers / writers
# --------------------------------------------------------------------------

@dataclass
class StreamConfig:
    """Where the event stream lives.

    ``format="kafka"`` needs the Kafka connector on the classpath;
    ``format="log"`` reads the partitioned event log in the folder ``path``,
    with offsets, from ``starting_offsets`` on (``start_file`` keeps what
    "latest" meant at the first start; ``partitions`` are a producer's);
    ``format="json"`` reads newline-delimited JSON files from ``path``.
    """

    format: str = "kafka"
    bootstrap_servers: str | None = None
    topic: str | None = None
    starting_offsets: str = "latest"
    path: str | None = None
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
    start_file: str | None = None
    partitions: int = 4


def read_raw_stream(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """The undecoded payloads (``value`` column), from Kafka, an event log or a
    JSON directory."""
    if cfg.format == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
                  .option("subscribe", cfg.topic)
                  .option("startingOffsets", cfg.starting_offsets))
        if cfg.max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", cfg.max_offsets_per_trigger)
        return reader.load()
    if cfg.format == "json":
        reader = spark.readStream.format("text")
        if cfg.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
        return reader.load(cfg.path)
    if cfg.format == "log":
        return stream_log(spark, cfg.path, cfg.starting_offsets, cfg.start_file)
    raise ValueError(f"unsupported stream format {cfg.format!r}")


def read_events_stream(spark: SparkSession, cfg: StreamConfig) -> Decoded:
    """Typed event stream (plus rejects), from any of the stream formats."""
    return decode_events(read_raw_stream(spark, cfg), "value")


def write_events(df: DataFrame, cfg: StreamConfig, mode: str = "append") -> None:
    """Publish events (batch DataFrame) to Kafka, to an event log or as JSON text files."""
    enc = encode_events(df)
    if cfg.format == "kafka":
        (enc.write.format("kafka")
         .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
         .option("topic", cfg.topic).save())
    elif cfg.format == "json":
        enc.select("value").write.mode(mode).text(cfg.path)
    elif cfg.format == "log":
        append_log(enc, cfg.path, cfg.partitions)
    else:
        raise ValueError(f"unsupported stream format {cfg.format!r}")
