"""Line dedup by a segment-partition edit join.

A line is split into threshold + 1 segments; a line within the threshold holds
one of them unchanged, near its place. Segments are indexed under (length,
segment), every line probes the substrings that its own length allows, and
candidates are verified by banded bit-parallel edit distance.

Index and probe entries are packed into arrays per hash bucket, so one shuffle
of a few bytes per entry serves the join. Copies of a line within a map task
are settled there; a task sends each line once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popflow.llm.common import ship, small, staged

#: Edits that still link two lines, and the least code points of a line that may be linked.
EDITS = 2
MIN_CHARS = 30
#: Hash buckets per shuffle partition, and entries held by a map task before it hands them on.
BUCKETS = 2
FLUSH_ENTRIES = 1_500_000
NO_ID = 2 ** 63 - 1
INDEX, PROBE = 1, 2

ENTRY = np.dtype([("key", "<u8"), ("id", "<u8"), ("sketch", "<u4"), ("kind", "u1")])
FIRST = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("code", "<i8"), ("place", "<i8")])
SPOT = np.dtype([("doc", "<i8"), ("code", "<i8"), ("place", "<i8")])

PACKED = pa.schema([("bucket", pa.int32()), ("entries", pa.binary()), ("firsts", pa.binary()), ("copies", pa.binary())])
PACKED_DDL = "bucket int, entries binary, firsts binary, copies binary"
FOUND = pa.schema([("what", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("tile", pa.binary())])
FOUND_DDL = "what string, a long, b long, c long, tile binary"
LINES = pa.schema([("id", pa.int64()), ("doc", pa.int64()), ("code", pa.int64()), ("place", pa.int64()), ("line", pa.string())])
LINKS = pa.schema([("doc", pa.int64()), ("code", pa.int64()), ("place", pa.int64()), ("near_doc", pa.int64())])
OUT_DDL = ("doc_id long, n_lines long, n_exact long, n_near long, near_docs array<long>, kept_sha256 string")
OUT = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_exact", pa.int64()), ("n_near", pa.int64()),
                 ("near_docs", pa.list_(pa.int64())), ("kept_sha256", pa.string())])


def row_code(text: str) -> int:
    """Tells rows of one id (or of none) with different texts apart, and orders them."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of the edits + 1 segments of a line; sizes differ by one at most."""
    n = edits + 1
    base, extra = divmod(length, n)
    out, at = [], 0
    for i in range(n):
        size = base + (i >= n - extra)
        out.append((at, size))
        at += size
    return out


def plan(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(seed, start, size, kind) of all entries of a line of ``length`` code points.

    A probe looks for lines of equal or smaller length. The shift of a segment
    is bounded by the edits left of it and, over the length difference, by
    those right of it.
    """
    out = []
    for other in range(max(length - edits, 0), length + 1):
        diff = length - other
        for i, (start, size) in enumerate(segments(other, edits)):
            for shift in range(max(-i, diff - (edits - i)), min(i, diff + edits - i) + 1):
                at = start + shift
                if 0 <= at and at + size <= length:
                    kind = PROBE | (INDEX if not diff and not shift else 0)
                    out.append((other * 16 + i, at, size, kind))
    return out


def sketch(points: np.ndarray) -> int:
    """Counts (modulo 16) of eight classes of code points, four bits each."""
    counts = np.bincount(points & 7, minlength=8) & 15
    return int((counts << (4 * np.arange(8))).sum())


def sketch_gap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At most twice the edit distance of the sketched lines."""
    gap = np.zeros(np.broadcast(a, b).shape, np.uint8)
    for k in range(8):
        d = ((a >> np.uint32(4 * k)) - (b >> np.uint32(4 * k))) & np.uint32(15)
        gap += np.minimum(d, np.uint32(16) - d).astype(np.uint8)
    return gap


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance if at most ``most``, else most + 1.

    Equal ends are cut off; the rest runs through a bit vector that holds only
    the diagonals of the band and slides down with each character of ``b``.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    low, n = 0, min(len(a), len(b))
    while low < n and a[low] == b[low]:
        low += 1
    high = 0
    while high < n - low and a[-1 - high] == b[-1 - high]:
        high += 1
    a, b = a[low:len(a) - high], b[low:len(b) - high]
    if len(a) <= most:
        return min(_table(a, b), most + 1)
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    width = 2 * most + 2
    full, top = (1 << width) - 1, 1 << (width - 1)
    plus, minus, dist, last = full & ~((1 << (width - 1 - most)) - 1), 0, most, top >> 1
    for i, c in enumerate(b):
        place = i + most - (width - 1)  # the pattern place of the lowest bit
        hit = masks.get(c, 0)
        hit = (hit >> place if place >= 0 else hit << -place) & full
        diagonal = ((((hit & plus) + plus) ^ plus) | hit | minus) & full
        up, down = minus | full & ~(diagonal | plus), diagonal & plus
        if i < len(a) - most:
            dist += not diagonal & top
        else:
            dist += bool(up & last) - bool(down & last)
            last >>= 1
        plus, minus = down | full & ~(diagonal >> 1 | up), diagonal >> 1 & up
    return min(dist, most + 1)


def _table(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def split_lines(text: str) -> list[str]:
    return text.split("\n")


def _entries(buckets: int, edits: int, least: int):
    digest = xxhash.xxh64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[int, list] = {}
        seen: dict[bytes, tuple[int, int, int]] = {}
        keys, ids, sketches, kinds, spots = [], [], [], [], []

        def flush():
            entries = np.empty(len(keys), ENTRY)
            entries["key"], entries["id"] = keys, ids
            entries["sketch"], entries["kind"] = sketches, kinds
            firsts = np.empty(len(seen), FIRST)
            halves = np.frombuffer(b"".join(seen), ">u8").reshape(-1, 2)
            firsts["h1"], firsts["h2"] = halves[:, 0], halves[:, 1]
            where = np.array(list(seen.values()), np.int64).reshape(-1, 3)
            again = np.array(spots, np.int64).reshape(-1, 3)
            copies = np.empty(len(again), SPOT)
            for n, part in enumerate(SPOT.names):
                firsts[part], copies[part] = where[:, n], again[:, n]
            yield _dealt([(rows, (by % np.uint64(buckets)).astype(np.int32)) for rows, by in (
                (entries, entries["key"]), (firsts, firsts["h1"]), (copies, copies["doc"].astype(np.uint64)))])
            for x in (keys, ids, sketches, kinds, spots):
                x.clear()
            seen.clear()

        for batch in batches:
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist()):
                code = row_code(text)
                for number, line in enumerate(split_lines(text)):
                    if not line or line.isspace():
                        continue
                    raw = line.encode("utf-32-le")
                    name, spot = xxhash.xxh3_128_digest(raw), (doc, code, number)
                    known = seen.get(name)
                    if known is not None:
                        if spot != known:
                            spots.append(max(known, spot))
                            seen[name] = min(known, spot)
                        continue
                    seen[name] = spot
                    length = len(line)
                    if length < least:
                        continue
                    todo = plans.get(length)
                    if todo is None:
                        todo = plan(length, edits)
                        if length < 5_000:
                            plans[length] = todo
                    keys += [digest(raw[4 * at:4 * (at + size)], seed) for seed, at, size, _ in todo]
                    ids += [int.from_bytes(name[:8])] * len(todo)
                    sketches += [sketch(np.frombuffer(raw, "<u4"))] * len(todo)
                    kinds += [kind for *_, kind in todo]
                if len(keys) > FLUSH_ENTRIES or len(seen) + len(spots) > FLUSH_ENTRIES // 4:
                    yield from flush()
        yield from flush()
    return run


def _dealt(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One row per bucket with the packed rows of each kind that belong there."""
    blobs: dict[int, list] = {}
    for kind, (rows, bucket) in enumerate(parts):
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        for s, e in zip(edges, edges[1:]):
            blobs.setdefault(int(bucket[s]), [None] * len(parts))[kind] = rows[s:e].tobytes()
    return pa.RecordBatch.from_arrays([pa.array(list(blobs), pa.int32()), *(
        pa.array([x[kind] for x in blobs.values()], pa.binary()) for kind in range(len(parts)))], schema=PACKED)


#: Candidate pairs looked at together, and entries on a side of a tile.
BLOCK = 1 << 20
TILE = 2_048


def candidate_pairs(entries: np.ndarray, edits: int, tile: int) -> Iterator[tuple[str, np.ndarray, np.ndarray | None]]:
    """Blocks of distinct ("pair", ids, None) of lines that share a key as index and
    probe, and whose sketches allow a link.

    A key with more than ``tile`` entries is dealt on: ("tile", index, probe)
    parts to be compared elsewhere, each of at most so many entries.
    """
    entries = np.unique(entries[["key", "id", "kind", "sketch"]])
    edges = np.flatnonzero(np.diff(entries["key"], prepend=entries["key"][:1] + np.uint64(1),
                                   append=entries["key"][-1:] + np.uint64(1)))
    starts, stops = edges[:-1], edges[1:]
    # Most shared keys have two entries: take those together.
    two = starts[stops - starts == 2]
    for at in range(0, len(two), BLOCK):
        yield "pair", _allowed(entries, two[at:at + BLOCK], two[at:at + BLOCK] + 1, edits), None
    held, size = [], 0
    many = stops - starts > 2
    for s, e in zip(starts[many], stops[many]):
        probe = np.arange(s, e)
        index = probe[entries["kind"][s:e] & INDEX > 0]
        if len(probe) > tile:
            for i in range(0, len(index), tile):
                for j in range(0, len(probe), tile):
                    yield "tile", entries[index[i:i + tile]], entries[probe[j:j + tile]]
            continue
        step = max(1, BLOCK // len(probe))
        for at in range(0, len(index), step):
            part = index[at:at + step]
            held.append(_allowed(entries, np.repeat(part, len(probe)), np.tile(probe, len(part)), edits))
            size += len(held[-1])
        if size > BLOCK:
            yield "pair", np.unique(np.concatenate(held), axis=0), None
            held, size = [], 0
    if held:
        yield "pair", np.unique(np.concatenate(held), axis=0), None


def _compare_tiles(edits: int):
    """Pairs of the tiles of frequent keys, block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, tile in zip(batch["a"].to_pylist(), batch["tile"]):
                both = np.frombuffer(tile.as_py(), ENTRY)
                index, probe = np.arange(n), np.arange(n, len(both))
                step = max(1, BLOCK // len(probe))
                for at in range(0, n, step):
                    part = index[at:at + step]
                    pairs = np.unique(_allowed(both, np.repeat(part, len(probe)), np.tile(probe, len(part)), edits), axis=0)
                    yield _found("pair", *pairs.view(np.int64).T)
    return run


def _allowed(entries: np.ndarray, a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    a, b = entries[a], entries[b]
    ok = (a["id"] != b["id"]) & ((a["kind"] & INDEX > 0) & (b["kind"] & PROBE > 0)
                                 | (a["kind"] & PROBE > 0) & (b["kind"] & INDEX > 0))
    a, b = a[ok], b[ok]
    ok = sketch_gap(a["sketch"], b["sketch"]) <= 2 * edits
    low, high = np.minimum(a["id"][ok], b["id"][ok]), np.maximum(a["id"][ok], b["id"][ok])
    return np.stack([low, high], axis=1)


def later_copies(firsts: np.ndarray) -> np.ndarray:
    """Places of every line but its first, from the firsts of all map tasks."""
    firsts = np.unique(firsts)  # by hash, then document and place
    again = (firsts["h1"][1:] == firsts["h1"][:-1]) & (firsts["h2"][1:] == firsts["h2"][:-1])
    return firsts[1:][again][["doc", "code", "place"]]


def _settle(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}

        def finish():
            if held.get("entries"):
                for what, found, probe in candidate_pairs(
                        np.frombuffer(b"".join(held["entries"]), ENTRY), edits, TILE):
                    if what == "tile":
                        yield _tile(found, probe)
                    else:
                        yield _found("pair", *found.view(np.int64).reshape(-1, 2).T)
            if held.get("firsts"):
                again = later_copies(np.frombuffer(b"".join(held["firsts"]), FIRST))
                yield _found("copy", again["doc"], again["code"], again["place"])

        for batch in batches:
            for bucket, entries, firsts, copies in zip(*(batch[c].to_pylist() for c in PACKED.names)):
                if bucket != now:
                    yield from finish()
                    now, held = bucket, {}
                for what, rows in (("entries", entries), ("firsts", firsts)):
                    if rows:
                        held.setdefault(what, []).append(rows)
                if copies:  # settled in the map task: only passed on
                    spots = np.frombuffer(copies, SPOT)
                    yield _found("copy", spots["doc"], spots["code"], spots["place"])
        yield from finish()
    return run


def _found(what: str, a: np.ndarray, b: np.ndarray, c: np.ndarray | None = None) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(x)) for x in (a, b, np.zeros(len(a), np.int64) if c is None else c)]
    return pa.RecordBatch.from_arrays([pa.array([what] * len(a), pa.string()), *columns, pa.nulls(len(a), pa.binary())],
                                      schema=FOUND)


def _tile(index: np.ndarray, probe: np.ndarray) -> pa.RecordBatch:
    both = np.empty(len(index) + len(probe), ENTRY)
    for name in ENTRY.names:
        both[name] = np.concatenate([index[name], probe[name]])
    return pa.RecordBatch.from_arrays([pa.array(["tile"]), pa.array([len(index)]), pa.array([0]), pa.array([0]),
                                       pa.array([both.tobytes()], pa.binary())], schema=FOUND)


def _numbered(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, docs, codes, places, lines = [], [], [], [], []
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist()):
                code = row_code(text)
                for number, line in enumerate(split_lines(text)):
                    if len(line) >= least and not line.isspace():
                        name = xxhash.xxh3_128_digest(line.encode("utf-32-le"))
                        ids.append(int.from_bytes(name[:8], signed=True))
                        docs.append(doc), codes.append(code), places.append(number), lines.append(line)
            yield pa.RecordBatch.from_pydict(dict(zip(LINES.names, (ids, docs, codes, places, lines))), schema=LINES)
    return run


def _verified(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, *at in zip(*(batch[c].to_pylist() for c in (
                    "line_a", "line_b", "doc_a", "code_a", "place_a", "doc_b", "code_b", "place_b"))):
                if edit_distance(a, b, edits) <= edits:
                    first, later = sorted([at[:3], at[3:]])
                    out.append((*later, first[0]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], [], []))],
                                             schema=LINKS)
    return run


def duplicate_lines(docs: DataFrame, edits: int = EDITS, least: int = MIN_CHARS) -> DataFrame:
    """(doc, code, place, near_doc) of every line that goes.

    A copy of an earlier line has no ``near_doc``; the first occurrence of a
    line linked to earlier lines has a row for each of them, with its document.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = staged(
        rows.mapInArrow(_entries(parts * BUCKETS, edits, least), PACKED_DDL)
        .repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
        .mapInArrow(_settle(edits), FOUND_DDL), "line-candidates")
    copies = found.where("what = 'copy'").select(F.col("a").alias("doc"), F.col("b").alias("code"), F.col("c").alias("place"),
                                                 F.lit(None).cast("long").alias("near_doc"))
    # The tiles of a frequent key go to as many tasks as there are.
    tiles = found.where("what = 'tile'").select("a", "tile").repartition(parts).mapInArrow(_compare_tiles(edits), FOUND_DDL)
    pairs = staged(found.where("what = 'pair'").unionByName(tiles).select("a", "b").distinct(), "line-pairs")
    wanted = staged(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "line-ids")
    numbered = rows.mapInArrow(_numbered(least), "id long, doc long, code long, place long, line string")
    lines = staged(numbered.join(small(wanted, wanted.count()), "id")
                   .groupBy("id", "line").agg(F.min(F.struct("doc", "code", "place")).alias("at"))
                   .select("id", "line", "at.doc", "at.code", "at.place"), "lines")
    a, b = (lines.select(*(F.col(c).alias(f"{c}_{x}") for c in lines.columns)).withColumnRenamed(f"id_{x}", x) for x in "ab")
    links = pairs.join(a, "a").join(b, "b").mapInArrow(_verified(edits), "doc long, code long, place long, near_doc long")
    return copies.unionByName(links)


def _kept_lines(text: str, spots: list | None) -> tuple[list[str], int, int, set]:
    """Kept lines, exact and near removals, and the documents of the near ones."""
    lines = split_lines(text)
    if not spots:
        return lines, 0, 0, set()
    exact, near, docs = set(), set(), set()
    for s in spots:
        if s["near_doc"] is None:
            exact.add(s["place"])
        else:
            near.add(s["place"])
            docs.add(s["near_doc"])
    gone = exact | near
    return [x for i, x in enumerate(lines) if i not in gone], len(exact), len(near - exact), docs


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, spots in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "__spots"))):
            kept, exact, near, docs = _kept_lines(text, spots)
            out.append((doc_id, len(split_lines(text)), exact, near, sorted(d for d in docs if d != NO_ID),
                        hashlib.sha256("\n".join(kept).encode()).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * len(OUT), OUT)],
                                         schema=OUT)


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [row_code(t or "") for t in batch["text"].to_pylist()]
        yield batch.append_column("__code", pa.array(codes, pa.int64()))


def _with_spots(docs: DataFrame, edits: int, least: int) -> DataFrame:
    """The rows with the ``__spots`` of their own text: a row's id and text code name them."""
    spots = (duplicate_lines(docs, edits, least).groupBy(F.col("doc").alias("__doc"), F.col("code").alias("__code"))
             .agg(F.collect_list(F.struct("place", "near_doc")).alias("__spots")))
    coded = docs.mapInArrow(_codes, T.StructType([*docs.schema.fields, T.StructField("__code", T.LongType())]))
    return (coded.withColumn("__doc", F.coalesce("doc_id", F.lit(NO_ID))).join(spots, ["__doc", "__code"], "left")
            .select(*docs.columns, "__spots"))


def line_dedup(docs: DataFrame, edits: int = EDITS, least: int = MIN_CHARS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_exact, n_near, near_docs, kept_sha256.

    Lines are split at newlines and ordered by (doc_id, place). A line goes if
    an earlier one is equal to it (n_exact), or, from ``least`` code points on,
    within ``edits`` edits of it (n_near; near_docs lists the documents where
    those earlier lines first stand). Blank lines stay. Null and empty texts are
    one empty line; a null id comes after every other and is left out of
    near_docs; repeated rows of one id and text count as one, further texts of
    an id as documents of their own. Empty tables give no rows; other columns
    are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return _with_spots(rows, edits, least).mapInArrow(_report, OUT_DDL)


def drop_duplicate_lines(docs: DataFrame, edits: int = EDITS, least: int = MIN_CHARS) -> DataFrame:
    """The documents with their duplicate lines removed.

    Columns are kept and a whole-numbered ``n_chars``, if there, counts the new
    text. A document that loses lines and keeps none but blank ones goes; others
    stay. Names that begin with two underscores are the operator's own.
    """
    ship(docs.sparkSession)
    schema = docs.schema
    joined = _with_spots(docs, edits, least)
    counts = "n_chars" in docs.columns and isinstance(schema["n_chars"].dataType, T.IntegralType)

    def run(batches):
        for batch in batches:
            texts, stay = [], []
            for text, found in zip(batch["text"].to_pylist(), batch["__spots"].to_pylist()):
                if text is not None and found:
                    kept, exact, near, _ = _kept_lines(text, found)
                    new = "\n".join(kept)
                    stay.append(not (exact + near) or not (new == "" or new.isspace()))
                    text = new
                else:
                    stay.append(True)
                texts.append(text)
            columns = {name: batch[name] for name in schema.names}
            columns["text"] = pa.array(texts, pa.string())
            if counts:
                sizes = [n if t is None else len(t) for n, t in zip(batch["n_chars"].to_pylist(), texts)]
                columns["n_chars"] = pa.array(sizes, batch["n_chars"].type)
            yield pa.RecordBatch.from_pydict(columns).filter(pa.array(stay, pa.bool_()))

    return joined.mapInArrow(run, schema)
