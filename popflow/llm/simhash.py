"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into tiles that share the population counts of
both 32-bit halves. A tile visits only the tiles whose counts lie within the
radius; inside a pair of tiles numpy xors and counts bits exactly. Copies share
one fingerprint, and a pair of tiles hands on a spanning forest of its links,
never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popflow.llm.common import ship, staged, text_or_empty
from popflow.llm.graph import components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Fingerprints of a tile, on average, and rows of it compared at once.
TILE = 16_384
ROWS = 128
#: Shingle hashes whose bits are counted at once.
BLOCK = 65_536

PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the whole text; 0 without words."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    stops = (ends[-n:] - 1).tolist()
    starts = [0, *ends[: n - 1].tolist()]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at:at + BLOCK], stops[at:at + BLOCK])],
                          dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(fps.view(np.int64))],
                                             schema=PRINTS)
    return run


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp) of every row; a null text counts as empty."""
    return (docs.select("doc_id", text_or_empty().alias("text"))
            .mapInArrow(_fingerprints(shingle), "doc_id long, fp long"))


class _Forest:
    """Union-find over the rows of one tile pair."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            roots = self._roots()
            ra, rb = roots[a], roots[b]
            apart = ra != rb
            if not apart.any():
                self.parent = roots
                return
            low, high = np.minimum(ra[apart], rb[apart]), np.maximum(ra[apart], rb[apart])
            np.minimum.at(roots, high, low)
            self.parent = roots
            a, b = a[apart], b[apart]

    def _roots(self) -> np.ndarray:
        roots = self.parent
        while True:
            up = roots[roots]
            if (up == roots).all():
                return up
            roots = up


def linked(own: np.ndarray, other: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (as member, root) of the links of two tiles, or within one."""
    across = other is not None
    values = np.concatenate([own, other]) if across else own
    against, offset = (other, len(own)) if across else (own, 0)
    forest, hit = _Forest(len(values)), False
    for at in range(0, len(own), ROWS):
        near = np.bitwise_count(own[at:at + ROWS, None] ^ against[None, :]) <= radius
        if not across:
            near &= np.arange(len(own))[None, :] > np.arange(at, at + len(near))[:, None]
        rows, cols = np.nonzero(near)
        if len(rows):
            hit = True
            forest.add(rows + at, cols + offset)
    if not hit:
        return values[:0], values[:0]
    roots = forest._roots()
    moved = np.flatnonzero(roots != np.arange(len(values)))
    return values[moved], values[roots[moved]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, own = None, None
        for batch in batches:
            for key, visitor, blob in zip(batch["tile"].to_pylist(), batch["visitor"].to_pylist(), batch["fps"]):
                fps = blob.values.to_numpy().view(np.uint64)
                if not visitor:
                    tile, own = key, fps.copy()
                    a, b = linked(own, None, radius)
                elif key == tile:
                    a, b = linked(own, fps, radius)
                else:  # hashing left the visited part empty
                    continue
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                     schema=EDGES)
    return run


def simhash_links(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints within the radius.

    ``distinct`` has one row per fingerprint in ``fp``.
    """
    cells = distinct.select(
        "fp", F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"),
        F.bit_count(F.col("fp").bitwiseAND(0xFFFFFFFF)).alias("lo"))
    # At most 33 x 33 rows, whatever the input.
    sizes = staged(cells.groupBy("hi", "lo").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles")), "cells")
    name = F.concat_ws("/", "hi", "lo", "part")
    tiles = staged(cells.join(F.broadcast(sizes), ["hi", "lo"])
                   .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
                   .groupBy("hi", "lo", "part").agg(F.collect_list("fp").alias("fps"))
                   .withColumn("tile", name), "tiles")
    steps = [(dh, dl) for dh in range(radius + 1) for dl in range(-radius, radius + 1)
             if abs(dh) + abs(dl) <= radius and (dh > 0 or dl >= 0)]
    target = F.explode(F.array(*(F.struct(F.lit(h).alias("h"), F.lit(x).alias("l")) for h, x in steps)))
    there = sizes.select(F.col("hi").alias("h"), F.col("lo").alias("l"), "tiles")
    visits = (tiles.select("hi", "lo", F.col("part").alias("own"), "fps", target.alias("d"))
              .select((F.col("hi") + F.col("d.h")).alias("h"), (F.col("lo") + F.col("d.l")).alias("l"),
                      ((F.col("d.h") == 0) & (F.col("d.l") == 0)).alias("home"), "own", "fps")
              .join(F.broadcast(there), ["h", "l"])
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .where(~F.col("home") | (F.col("own") < F.col("part")))
              .select(F.concat_ws("/", "h", "l", "part").alias("tile"), F.lit(True).alias("visitor"), "fps"))
    both = tiles.select("tile", F.lit(False).alias("visitor"), "fps").unionByName(visits).repartition(F.col("tile")).sortWithinPartitions("tile", "visitor")
    return both.mapInArrow(_compare(radius), "a long, b long")


def simhash_groups(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most
    ``radius`` differing bits. Null and empty texts have fingerprint 0 and are
    linked like any other; repeated rows share a fingerprint; a null id never
    names a component unless the whole component has none. Empty tables give
    no rows; other columns are ignored.
    """
    prints = staged(fingerprints(docs, shingle), "fingerprints")
    named, least = _rooted(prints, radius)
    groups = named.join(least, "root").select("fp", "component_id")
    return prints.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _rooted(prints: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(fp, first, root) of every fingerprint and (root, component_id) of every component."""
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(simhash_links(distinct, radius)).select(F.col("node").alias("fp"), "root")
    named = staged(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    return named, named.groupBy("root").agg(F.min("first").alias("component_id"))


def one_per_group(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The documents that stand for their group, with all their columns.

    It is the document with the group's smallest id; of several rows with that
    id the one with the smallest fingerprint stays, and of equal rows one.
    """
    ship(docs.sparkSession)

    def add(batches):
        for batch in batches:
            fps = np.array([fingerprint(t or "", shingle) for t in batch["text"].to_pylist()], dtype=np.uint64)
            yield batch.append_column("__fp", pa.array(fps.view(np.int64)))

    # The texts are read for their fingerprints once; the written rows are what the groups choose from.
    marked = staged(docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])), "marked")
    named, least = _rooted(marked.select("doc_id", F.col("__fp").alias("fp")), radius)
    stay = (named.join(least, "root").where(F.col("first").eqNullSafe(F.col("component_id")))
            .groupBy("root", "component_id").agg(F.min("fp").alias("__fp"))
            .select(F.col("component_id").alias("__id"), "__fp"))
    kept = marked.join(stay, (marked["__fp"] == stay["__fp"]) & marked["doc_id"].eqNullSafe(stay["__id"])).drop(
        stay["__fp"])
    one = Window.partitionBy("__fp", "doc_id").orderBy("text")
    return kept.withColumn("__row", F.row_number().over(one)).where("__row = 1").select(*docs.columns)
