"""A partitioned, append-only event log in a shared folder, as a Spark data source.

``popflow_log`` gives offline and small installations what a message broker
gives a cluster: partitions with offsets, producers that append, and streams
that start at the earliest or latest offset and resume where they stopped.

A partition is a folder of segments named by their first offset and their rows.
Producer tasks write segments side by side; the commit on the driver names them
(one producer job at a time; like a plain broker's, its commit is per partition).
A stream's offset is the end of every partition; a micro-batch reads the parts
of segments between two of them, one task per segment, in Arrow batches.

The classes travel to Spark's workers by value: these need no copy of this package.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

FORMAT = "popflow_log"
SCHEMA = "partition int, offset bigint, value string"
ARROW_SCHEMA = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.string())])
#: Rows of a batch handed to Spark.
BATCH_ROWS = 10_000
STAGED = "_staged"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and folder of a path or URI."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def segments(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """Per partition the (first offset, rows, file) of its segments, in order."""
    files, root = _place(path)
    out: dict[int, list[tuple[int, int, str]]] = {}
    for info in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        folder, _, name = info.path.rpartition("/")
        if info.type == fs.FileType.File and name.endswith(".parquet") and "/p=" in folder:
            first, _, rows = name.removesuffix(".parquet").partition("-")
            out.setdefault(int(folder.rpartition("=")[2]), []).append((int(first), int(rows), info.path))
    return {p: sorted(found) for p, found in out.items()}


def end_offsets(path: str) -> dict[str, int]:
    """The offset behind the last event of every partition."""
    return {str(p): found[-1][0] + found[-1][1] for p, found in sorted(segments(path).items())}


def start_offsets(path: str, starting: str, start_file: str | None = None) -> dict[str, int]:
    """Offsets that a stream starts at: "latest" as of this call, "earliest", or JSON.

    With a ``start_file`` the first call's answer holds for all later ones, so
    that a query stopped before its first micro-batch starts at the same place.
    """
    if start_file:
        files, name = _place(start_file)
        if files.get_file_info(name).type == fs.FileType.File:
            with files.open_input_stream(name) as f:
                return json.loads(f.read())
    offsets = end_offsets(path) if starting == "latest" else {} if starting == "earliest" else json.loads(starting)
    if start_file:
        files.create_dir(name.rpartition("/")[0], recursive=True)
        staged = f"{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(staged) as f:
            f.write(json.dumps(offsets).encode())
        files.move(staged, name)
    return offsets


@dataclass
class Slice(InputPartition):
    """Rows ``skip`` to ``skip + take`` of one segment."""

    partition: int
    first: int
    skip: int
    take: int
    file: str


def slices(path: str, start: dict[str, int], end: dict[str, int]) -> list[Slice]:
    out = []
    for p, found in segments(path).items():
        low, high = start.get(str(p), 0), end.get(str(p), 0)
        for first, rows, file in found:
            a, b = max(low, first), min(high, first + rows)
            if a < b:
                out.append(Slice(p, first, a - first, b - a, file))
    return out


def read_slice(path: str, part: Slice) -> Iterator[pa.RecordBatch]:
    files, _ = _place(path)
    at, end = 0, part.skip + part.take
    with files.open_input_file(part.file) as f:
        for batch in pq.ParquetFile(f).iter_batches(BATCH_ROWS, columns=["value"]):
            low, high = max(part.skip - at, 0), min(end - at, batch.num_rows)
            if low < high:
                value = batch.column(0).slice(low, high - low)
                offsets = range(part.first + at + low, part.first + at + high)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.partition] * len(value), pa.int32()), pa.array(offsets, pa.int64()), value],
                    schema=ARROW_SCHEMA)
            at += batch.num_rows
            if at >= end:
                return


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, start: dict[str, int]):
        self.path, self.start = path, start

    def initialOffset(self) -> dict:
        return self.start

    def latestOffset(self) -> dict:
        # Never behind the start: a partition of the start that is not listed yet stays.
        ends = end_offsets(self.path)
        return {p: max(ends.get(p, 0), self.start.get(p, 0)) for p in sorted({*ends, *self.start})}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return slices(self.path, start, end)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return read_slice(self.path, partition)


class LogReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Slice]:
        return slices(self.path, {}, end_offsets(self.path)) or [Slice(0, 0, 0, 0, "")]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return read_slice(self.path, partition) if partition.take else iter(())


@dataclass
class Written(WriterCommitMessage):
    task: int
    file: str
    rows: int


class LogWriter(DataSourceArrowWriter):
    def __init__(self, path: str, partitions: int):
        self.path, self.partitions = path, partitions

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _place(self.path)
        files.create_dir(f"{root}/{STAGED}", recursive=True)
        file, rows, out = f"{root}/{STAGED}/{uuid.uuid4().hex}.parquet", 0, None
        with files.open_output_stream(file) as f:
            for batch in iterator:
                if out is None:
                    out = pq.ParquetWriter(f, pa.schema([("value", pa.string())]))
                value = batch.column(batch.schema.get_field_index("value")).cast(pa.string())
                out.write_batch(pa.RecordBatch.from_arrays([value], ["value"]))
                rows += batch.num_rows
            if out is not None:
                out.close()
        return Written(TaskContext.get().partitionId(), file, rows)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _place(self.path)
        ends = end_offsets(self.path)
        for done in sorted((m for m in messages if m), key=lambda m: m.task):
            if not done.rows:
                files.delete_file(done.file)
                continue
            p = done.task % self.partitions
            first = ends.get(str(p), 0)
            files.create_dir(f"{root}/p={p}", recursive=True)
            files.move(done.file, f"{root}/p={p}/{first:020d}-{done.rows}.parquet")
            ends[str(p)] = first + done.rows

    def abort(self, messages: list[Written | None]) -> None:
        files, _ = _place(self.path)
        for done in messages:
            if done:
                files.delete_file(done.file)


class EventLog(DataSource):
    """Options: path; partitions (of a write); startingOffsets (JSON, of a stream)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> LogReader:
        return LogReader(self.options["path"])

    def streamReader(self, schema: T.StructType) -> LogStreamReader:
        return LogStreamReader(self.options["path"], json.loads(self.options.get("startingOffsets", "{}")))

    def writer(self, schema: T.StructType, overwrite: bool) -> LogWriter:
        return LogWriter(self.options["path"], int(self.options.get("partitions", "1")))


def register(spark: SparkSession) -> None:
    """Make ``format("popflow_log")`` known to the session."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(EventLog)


def append_log(df: DataFrame, path: str, partitions: int, key_col: str | None = "key") -> None:
    """Append the ``value`` payloads; those of one key go to one partition, in no set order among them."""
    register(df.sparkSession)
    dealt = df.repartition(partitions, key_col) if key_col else df.repartition(partitions)
    (dealt.select("value").write.format(FORMAT).option("path", path)
     .option("partitions", str(partitions)).mode("append").save())


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a batch."""
    register(spark)
    return spark.read.format(FORMAT).option("path", path).load()


def stream_log(spark: SparkSession, path: str, starting: str = "latest", start_file: str | None = None) -> DataFrame:
    """The log as a stream from ``starting`` (see :func:`start_offsets`)."""
    register(spark)
    start = start_offsets(path, starting, start_file)
    return spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", json.dumps(start)).load()
