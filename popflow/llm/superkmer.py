"""Substring dedup by super-k-mer partitioning.

Consecutive windows of a text that share a minimiser (the least hash among
their word grams) travel as one packed string to that minimiser's bucket, where
the windows are counted exactly, as word sequences. A map task sends equal
strings once and packs all strings of a bucket into one compressed row; their
further occurrences follow as plain numbers, in bounded rows behind them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of the grams whose least hash is a window's minimiser.
GRAM = 3
#: Bytes of packed strings a map task holds before it hands them on.
FLUSH_BYTES = 96 << 20
#: Hash buckets per shuffle partition.
BUCKETS = 2
#: Further occurrences in one row.
CHUNK = 50_000
#: Order of a null id: after every other.
NO_ID = 2 ** 63 - 1
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

#: What is known of a packed string and of its first occurrence, or of a further one.
STRING = np.dtype([("key", "<u4"), ("many", "u1"), ("doc", "<i8"), ("place", "<i8")])
MORE = np.dtype([("p1", "<u8"), ("p2", "<u8"), ("doc", "<i8"), ("place", "<i8")])

PACKED = pa.schema([("bucket", pa.int32()), ("further", pa.bool_()), ("about", pa.binary()), ("strings", pa.binary())])
PACKED_DDL = "bucket int, further boolean, about binary, strings binary"
SPANS = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("first", pa.int32()), ("stop", pa.int32())])
SPANS_DDL = "doc long, row long, first int, stop int"
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
OUT_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def row_code(text: bytes) -> int:
    """Tells rows of one id with different texts apart."""
    return zlib.crc32(text) & 0x7FFFFFFF


def minimisers(words: list[bytes], window: int) -> np.ndarray:
    """The least gram hash of every window, in order."""
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    gram = min(GRAM, window)
    n = len(h) - gram + 1
    mixed = np.zeros(n, np.uint64)
    for j in range(gram):
        mixed += h[j:j + n] * MULTIPLIERS[j]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    least, width, want = mixed, 1, window - gram + 1
    while width < want:  # minima over doubling widths
        step = min(width, want - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    return least


def _pack(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], list[int]] = {}
        size = 0
        for batch in batches:
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist()):
                data = text.encode()
                words = data.split()
                if len(words) < window:
                    continue
                mini = minimisers(words, window)
                cuts = np.flatnonzero(mini[1:] != mini[:-1]) + 1
                starts = [0, *cuts.tolist()]
                stops = [*cuts.tolist(), len(mini)]
                ends = np.cumsum([len(w) + 1 for w in words])
                joined, begin = b" ".join(words), [0, *ends.tolist()]
                code = row_code(data) << 32
                for key, s, e in zip(mini[starts].tolist(), starts, stops):
                    packed = joined[begin[s]:begin[e + window - 1] - 1]
                    seen = held.get((key, packed))
                    if seen is None:
                        held[key, packed] = [doc, code | s]
                        size += len(packed) + 100
                    else:
                        seen += (doc, code | s)
                        size += 64
                if size > FLUSH_BYTES:
                    yield from _flush(held, buckets)
                    held, size = {}, 0
        yield from _flush(held, buckets)
    return run


def _flush(held: dict[tuple[int, bytes], list[int]], buckets: int) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    squeeze = zstandard.ZstdCompressor(level=3).compress
    keys = np.array([k for k, _ in held], np.uint64)
    strings = [p for _, p in held]
    about, further = np.empty(len(keys), STRING), []
    about["key"] = keys >> np.uint64(32)
    docs, places, many = [], [], []
    for n, seen in enumerate(held.values()):
        first = 0 if len(seen) == 2 else 2 * int(np.argmin(seen[::2]))  # the smallest document stands for the rest
        docs.append(seen[first]), places.append(seen[first + 1]), many.append(len(seen) > 2)
        if len(seen) > 2:
            del seen[first:first + 2]
            rest = np.empty(len(seen) // 2, MORE)
            rest["p1"], rest["p2"] = np.frombuffer(xxhash.xxh3_128_digest(strings[n]), "<u8")
            rest["doc"], rest["place"] = seen[::2], seen[1::2]
            further.append((int(keys[n]) % buckets, rest))
    about["doc"], about["place"], about["many"] = docs, places, many
    bucket = (keys % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    for s, e in zip(edges, edges[1:]):
        part = order[s:e]
        # each column on its own: equal bytes lie together
        columns = b"".join(np.ascontiguousarray(about[c][part]).view(np.uint8).reshape(e - s, -1).T.tobytes()
                           for c in STRING.names)
        yield _row(bucket[part[0]], False, squeeze(columns), squeeze(b"\n".join([strings[i] for i in part])))
    further.sort(key=lambda x: x[0])
    at = 0
    while at < len(further):  # rows of one bucket together, cut into chunks
        to = at
        while to < len(further) and further[to][0] == further[at][0]:
            to += 1
        rest = np.concatenate([x for _, x in further[at:to]])
        for k in range(0, len(rest), CHUNK):
            yield _row(further[at][0], True, squeeze(rest[k:k + CHUNK].tobytes()), None)
        at = to


def _row(bucket: int, further: bool, about: bytes, strings: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([int(bucket)], pa.int32()), pa.array([further]), pa.array([about], pa.binary()),
                                       pa.array([strings], pa.binary())], schema=PACKED)


def _unpack(about: bytes) -> np.ndarray:
    raw = np.frombuffer(about, np.uint8)
    n = len(raw) // STRING.itemsize
    out, at = np.empty(n, STRING), 0
    for c in STRING.names:
        width = STRING[c].itemsize
        out[c] = np.ascontiguousarray(raw[at:at + n * width].reshape(width, n).T).view(STRING[c]).ravel()
        at += n * width
    return out


def least_by_sort(windows: list[bytes], docs: np.ndarray) -> np.ndarray:
    """For each window the smallest document of all equal ones, by sorting.

    Windows are sorted by 128-bit digests; neighbours of one digest are compared
    word for word, and if any differ, the windows themselves are sorted.
    """
    if not windows:
        return docs
    name = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, windows)), ">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((name[:, 1], name[:, 0]))
    same = np.append(False, (name[order[1:]] == name[order[:-1]]).all(axis=1))
    at = order.tolist()
    if any(windows[at[k]] != windows[at[k - 1]] for k in np.flatnonzero(same).tolist()):
        at = sorted(range(len(windows)), key=windows.__getitem__)
        order = np.array(at)
        same = np.array([k > 0 and windows[at[k]] == windows[at[k - 1]] for k in range(len(at))])
    starts = np.flatnonzero(~same)
    out = np.empty(len(docs), np.int64)
    out[order] = np.minimum.reduceat(docs[order], starts)[np.cumsum(~same) - 1]
    return out


class _Bucket:
    """All rows of one bucket: strings first, further occurrences after them."""

    def __init__(self, window: int):
        self.window = window
        self.about: list[np.ndarray] = []
        self.strings: list[bytes] = []
        self.least: dict[tuple[int, int], np.ndarray] = {}

    def count(self) -> list[np.ndarray]:
        """Spans of the first occurrences, by the smallest document of every window."""
        about, out = np.concatenate(self.about), []
        _, at, uses = np.unique(about["key"], return_inverse=True, return_counts=True)
        shared = np.flatnonzero((uses[at] > 1) | (about["many"] > 0)).tolist()  # others hold no window twice
        docs, places, many = about["doc"].tolist(), about["place"].tolist(), about["many"].tolist()
        least_doc: dict[bytes, int] = {}
        for i in shared:
            packed = self.strings[i]
            least_doc[packed] = min(least_doc.get(packed, NO_ID), docs[i])
        windows, ends = [], []
        for packed in least_doc:
            words = packed.split(b" ")
            begin = [0]
            for w in words:
                begin.append(begin[-1] + len(w) + 1)
            windows += [packed[begin[i]:begin[i + self.window] - 1] for i in range(len(words) - self.window + 1)]
            ends.append(len(windows))
        own = np.repeat(np.fromiter(least_doc.values(), np.int64, len(least_doc)), np.diff(ends, prepend=0))
        least = dict(zip(least_doc, np.split(least_by_sort(windows, own), ends[:-1])))
        for i in shared:
            found = least[self.strings[i]]
            if docs[i] > found.min():
                self.spans(np.array([docs[i]]), np.array([places[i]]), found, out)
            if many[i]:
                self.least[_name(self.strings[i])] = found
        self.about, self.strings = [], []
        return out

    def further(self, rest: np.ndarray) -> list[np.ndarray]:
        """Spans of further occurrences."""
        out: list[np.ndarray] = []
        edges = np.flatnonzero(np.diff(rest["p1"], prepend=rest["p1"][:1] + np.uint64(1), append=rest["p1"][-1:] + np.uint64(1)))
        for s, e in zip(edges, edges[1:]):
            self.spans(rest["doc"][s:e], rest["place"][s:e], self.least[int(rest["p1"][s]), int(rest["p2"][s])], out)
        return out

    def spans(self, docs: np.ndarray, places: np.ndarray, least: np.ndarray, out: list[np.ndarray]) -> None:
        """Covered words (doc, row, first, stop) of occurrences whose windows start in a smaller document."""
        whole = docs > least.max()
        some = ~whole & (docs > least.min())
        row, start = places >> 32, places & 0xFFFFFFFF
        if whole.any():
            out.append(np.stack([docs[whole], row[whole], start[whole],
                                 start[whole] + len(least) + self.window - 1], axis=1))
        for k in np.flatnonzero(some):
            hit = np.flatnonzero(np.diff(np.concatenate([[0], least < docs[k], [0]]).astype(np.int8)))
            for a, b in hit.reshape(-1, 2):
                out.append(np.array([[docs[k], row[k], start[k] + a, start[k] + b + self.window - 1]]))


def _name(packed: bytes) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(packed), "<u8").tolist())


def _covered(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, number, bucket = zstandard.ZstdDecompressor().decompress, None, None
        for batch in batches:
            for key, further, about, strings in zip(*(batch[c] for c in PACKED.names)):
                key, further = key.as_py(), further.as_py()
                if key != number:
                    if bucket is not None and bucket.about:
                        yield _span_batch(bucket.count())
                    number, bucket = key, _Bucket(window)
                if not further:
                    bucket.about.append(_unpack(unzip(about.as_py())))
                    bucket.strings += unzip(strings.as_py()).split(b"\n")
                    continue
                if bucket.about:
                    yield _span_batch(bucket.count())
                yield _span_batch(bucket.further(np.frombuffer(unzip(about.as_py()), MORE)))
        if bucket is not None and bucket.about:
            yield _span_batch(bucket.count())
    return run


def _span_batch(out: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(out) if out else np.zeros((0, 4), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]),
                                       pa.array(rows[:, 2].astype(np.int32)), pa.array(rows[:, 3].astype(np.int32))],
                                      schema=SPANS)


def duplicate_spans(rows: DataFrame, window: int) -> DataFrame:
    """(doc, row, first, stop): word ranges covered by windows that start in a smaller document."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.select("doc", "text").mapInArrow(_pack(window, parts * BUCKETS), PACKED_DDL)
    return (packed.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket", "further")
            .mapInArrow(_covered(window), SPANS_DDL))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "spans"))):
            data = text.encode()
            words = data.split()
            if spans:
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    gone[s["first"]] += 1
                    gone[s["stop"]] -= 1
                keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                kept = [words[i] for i in keep]
            else:
                kept = words
            out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * len(OUT), OUT)],
                                         schema=OUT)


def substring_dedup(docs: DataFrame, window: int = 13) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window of ``window`` words covering it has a word sequence
    that also starts in a document with a smaller id. Null and empty texts have
    no words; texts shorter than the window keep all. Rows that share an id
    never remove words of each other; a null id counts as larger than every
    other. Empty tables give no rows; other columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    spans = (duplicate_spans(rows, window).groupBy("doc", "row")
             .agg(F.collect_list(F.struct("first", "stop")).alias("spans")))
    # each row gets the spans of its own text only, also where many share an id or have none
    code = F.crc32(F.col("text").cast("binary")).bitwiseAND(F.lit(0x7FFFFFFF))
    return rows.withColumn("row", code).join(spans, ["doc", "row"], "left").select("doc_id", "text", "spans").mapInArrow(_kept, OUT_DDL)
