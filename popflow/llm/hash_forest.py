"""Nearest neighbours by inner product from forests of sorted hash strings.

The vectors are dealt into shards of bounded size. A shard's forest has one
sorted array of long hash strings per tree; a bit of a string is the side of a
seeded random hyperplane. A query descends every tree to its longest matching
prefix. From there all trees ascend together, one bit at a time: the rows that
share a prefix of the current length, in whichever tree, are its candidates,
until they are as many as the search asks for. Their exact inner products in
double precision give the shard's nearest, and the shards' lists are merged.

Vectors of different norms are brought to one length by an extra component
(zero in a query), so that the largest inner product is the smallest angle.

How many candidates to ask for is measured, not guessed: for a bounded sample
of the queries the true neighbours are found by comparing them with every row,
and the number is the one at which the asked share of them is met.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popflow.llm.common import ship, staged

TREES, BITS, SEED = 48, 24, 29
#: Components of a shard's vectors together (bounds a task's memory), and rows of a block of queries.
SHARD_VALUES = 1 << 19
LEAST_SHARD = 1_024
QUERY_BLOCK = 512
#: Blocks of queries that one task takes against its shard.
BLOCKS_A_TASK = 8
#: About so many queries are compared with every row to measure the recall.
SAMPLE = 128
#: The level above all bits: no row.
NONE = BITS + 1


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding) with an id and finite components, not all zero, as doubles."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))
    return (vectors.select("vec_id", x.alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
            .where(sound & F.exists("embedding", lambda v: v != 0)).distinct())


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """The vectors as rows, shorter ones continued with zeros."""
    column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def strings(x: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Hash strings, one row per tree: bits of the sides of seeded hyperplanes."""
    planes = np.random.default_rng(SEED).standard_normal((x.shape[1] + 1, TREES * BITS))
    side = (x @ planes[:-1] + extra[:, None] * planes[-1] > 0).reshape(len(x), TREES, BITS)
    return (side @ (1 << np.arange(BITS - 1, -1, -1))).astype(np.uint32).T


SHARD = "shard int, ids binary, vectors binary, strings binary, places binary"
SHARD_OUT = pa.schema([("shard", pa.int32()), *[(c, pa.binary()) for c in ("ids", "vectors", "strings", "places")]])
BLOCK = "block int, ids binary, vectors binary, strings binary"
BLOCK_OUT = pa.schema([("block", pa.int32()), *[(c, pa.binary()) for c in ("ids", "vectors", "strings")]])


def _grow(dim: int, top: float):
    """A shard's vectors and its trees: strings in order, and the rows they belong to."""
    def run(table: pa.Table) -> pa.Table:
        ids, x = table["vec_id"].to_numpy(), matrix(table["embedding"], dim)
        by_id = np.argsort(ids, kind="stable")
        ids, x = ids[by_id], x[by_id]
        unit = x / top
        bits = strings(unit, np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1))))
        places = np.argsort(bits, axis=1, kind="stable")
        row = [table["shard"][0].as_py(), ids.astype(np.int64).tobytes(), x.tobytes(),
               np.take_along_axis(bits, places, 1).tobytes(), places.astype(np.int32).tobytes()]
        return pa.Table.from_pylist([dict(zip(SHARD_OUT.names, row))], schema=SHARD_OUT)
    return run


def _pack(dim: int):
    def run(table: pa.Table) -> pa.Table:
        ids, x = table["vec_id"].to_numpy(), matrix(table["embedding"], dim)
        bits = strings(x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros(len(x)))
        row = [table["block"][0].as_py(), ids.astype(np.int64).tobytes(), x.tobytes(), bits.tobytes()]
        return pa.Table.from_pylist([dict(zip(BLOCK_OUT.names, row))], schema=BLOCK_OUT)
    return run


class Forest:
    def __init__(self, row: dict, dim: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.x = np.frombuffer(row["vectors"], np.float64).reshape(len(self.ids), dim)
        self.strings = np.frombuffer(row["strings"], np.uint32).reshape(TREES, -1)
        self.places = np.frombuffer(row["places"], np.int32).reshape(TREES, -1)

    def level(self, bits: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each tree and query where the rows sharing a prefix of ``length`` begin and end."""
        low, high = np.empty(bits.shape, np.int64), np.empty(bits.shape, np.int64)
        tail = BITS - length
        first = (bits >> tail) << tail
        last = first | ((1 << tail) - 1)
        for t in range(TREES):
            low[t] = np.searchsorted(self.strings[t], first[t], "left")
            high[t] = np.searchsorted(self.strings[t], last[t], "right")
        return low, high

    def longest(self, bits: np.ndarray) -> np.ndarray:
        """Descent: length of each query's longest matching prefix in any tree."""
        best = np.zeros(bits.shape[1], np.int64)
        end = self.strings.shape[1] - 1
        for t in range(TREES):
            at = np.searchsorted(self.strings[t], bits[t])
            for beside in (np.maximum(at - 1, 0), np.minimum(at, end)):
                differ = self.strings[t][beside] ^ bits[t]
                # position of the highest differing bit; zero has none
                best = np.maximum(best, BITS - np.frexp(differ.astype(float))[1])
        return best

    def candidates(self, bits: np.ndarray, wanted: int) -> Iterator[tuple[int, np.ndarray]]:
        """(query, rows): the ascent in all trees at once, until ``wanted`` entries are met."""
        active = np.arange(bits.shape[1])
        deepest = self.longest(bits)
        for length in range(int(deepest.max(initial=0)), -1, -1):
            now = active[deepest[active] >= length]
            if not len(now):
                continue
            low, high = self.level(bits[:, now], length)
            enough = (high - low).sum(axis=0) >= wanted if length else np.ones(len(now), bool)
            for i in np.flatnonzero(enough):
                met = np.zeros(len(self.ids), bool)
                for t in range(TREES):
                    met[self.places[t, low[t, i]:high[t, i]]] = True
                yield int(now[i]), np.flatnonzero(met)
            active = np.setdiff1d(active, now[enough], assume_unique=True)

    def nearest(self, rows: np.ndarray, q: np.ndarray, q_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of ``rows`` (ascending) by inner product, one row per id: rows and scores."""
        rows = rows[self.ids[rows] != q_id]
        x = self.x[rows]
        rough = x @ q
        if len(rows) > 4 * k:
            # rounding of the fast product is far below this margin
            kth = np.partition(rough, len(rough) - 4 * k)[-4 * k]
            on = rough >= kth - 1e-9 * max(1.0, abs(kth))
            if len(np.unique(self.ids[rows[on]])) >= k:
                rows, x = rows[on], x[on]
        score = (x * q).sum(axis=1)
        order = np.lexsort((self.ids[rows], -score))
        ids = self.ids[rows[order]]
        first = np.zeros(len(ids), bool)
        first[np.unique(ids, return_index=True)[1]] = True
        order = order[first][:k]
        return rows[order], score[order]

    def effort(self, bits: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Entries the ascent has to ask for until it meets each of ``rows``, for one query."""
        strings = np.empty((TREES, len(rows)), np.uint32)
        for t in range(TREES):
            back = np.empty(len(self.ids), np.uint32)
            back[self.places[t]] = self.strings[t]
            strings[t] = back[rows]
        shared = (BITS - np.frexp((strings ^ bits).astype(float))[1]).max(axis=0)
        out = np.ones(len(rows), np.int64)
        for length in np.unique(shared):
            if length < BITS:
                low, high = self.level(bits, int(length) + 1)
                out[shared == length] = (high - low).sum() + 1
        return out


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("effort", pa.int64())])


def _search(dim: int, k: int, wanted: int | None):
    """Streams a shard, then blocks of queries against it; ``wanted`` None compares all rows."""
    def block(forest: Forest, row: dict) -> pa.RecordBatch:
        q_ids = np.frombuffer(row["ids"], np.int64)
        q = np.frombuffer(row["vectors"], np.float64).reshape(len(q_ids), dim)
        bits = np.frombuffer(row["strings"], np.uint32).reshape(TREES, -1)
        every = np.arange(len(forest.ids))
        queries = forest.candidates(bits, wanted) if wanted else ((i, every) for i in range(len(q_ids)))
        parts = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]]
        for i, rows in queries:
            rows, score = forest.nearest(rows, q[i], q_ids[i], k)
            effort = np.zeros(len(rows), np.int64) if wanted else forest.effort(bits[:, i:i + 1], rows)
            for part, values in zip(parts, (np.full(len(rows), q_ids[i]), forest.ids[rows], score, effort)):
                part.append(values)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in parts], schema=FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["block"] is None:
                    forest = Forest(row, dim)
                else:
                    yield block(forest, row)
    return run


def _blocks(queries: DataFrame, dim: int, count: int) -> DataFrame:
    dealt = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "vec_id", "embedding"), F.lit(count)).cast("int"))
    return dealt.groupBy("block").applyInArrow(_pack(dim), BLOCK)


def _against(shards: DataFrame, n_shards: int, blocks: DataFrame, n_blocks: int, dim: int, k: int,
             wanted: int | None) -> DataFrame:
    """Every block of queries against every shard; the k best of each shard, merged."""
    parts = -(-n_blocks // BLOCKS_A_TASK)
    left = shards.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn(
        "block", F.lit(None).cast("int"))
    right = blocks.withColumns({"shard": F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))),
                                "part": F.pmod("block", F.lit(parts)), "places": F.lit(None).cast("binary")})
    streams = (left.unionByName(right).repartition(n_shards * parts, "shard", "part")
               .sortWithinPartitions("shard", "part", F.col("block").asc_nulls_first()))
    found = streams.mapInArrow(_search(dim, k, wanted), "query_id long, vec_id long, score double, effort long")
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"), F.max("effort").alias("effort"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 20, recall: float = 0.95) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that ``queries`` selects.

    Nearness is the inner product in double precision, largest first, ties to
    the smaller vec_id. Vectors that are null, empty or zero or hold null or
    non-finite components and rows without an id take no part. Equal rows count
    once; an id with several vectors is as near as its nearest pair, and never
    its own neighbour. A shorter vector counts as continued with zeros. Other
    columns are ignored. Fewer than k candidates are returned all; without
    queries there are no rows. ``recall`` is the share of true neighbours that
    the number of candidates is measured for.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema["vec_id"].dataType
    rows = staged(usable(vectors), "vectors")
    x = F.col("embedding")
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v))
    dim, top, n, n_queries = rows.agg(F.max(F.size(x)), F.max(norm), F.count(F.lit(1)), F.count_if(queries)).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n_shards = -(-n // max(LEAST_SHARD, SHARD_VALUES // dim))
    # The shard's own hash: rows of one block or of one shard are not related.
    shards = staged(rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(7), "vec_id", "embedding"), F.lit(n_shards)).cast("int"))
                    .groupBy("shard").applyInArrow(_grow(dim, top), SHARD), "forest")
    asked = rows.where(queries)
    some = asked.where(F.pmod(F.xxhash64(F.lit(11), "vec_id"), F.lit(max(1, n_queries // SAMPLE))) == 0)
    truth = _against(shards, n_shards, _blocks(some, dim, 1), 1, dim, k, None)
    wanted = truth.agg(F.percentile("effort", F.lit(recall))).first()[0]
    n_blocks = -(-n_queries // QUERY_BLOCK)
    found = _against(shards, n_shards, _blocks(asked, dim, n_blocks), n_blocks, dim, k,
                     max(1, math.ceil(n if wanted is None else wanted)))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"),
                        F.col("vec_id").cast(kind).alias("vec_id"), "score")
