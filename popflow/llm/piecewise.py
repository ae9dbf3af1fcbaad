"""Context-triggered piecewise hashing.

A rolling hash of seven bytes ends a chunk where it hits the block size; each
chunk gives one signature character, at the block size and at its double.
Signatures of compatible block sizes are compared by edit distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 7
LEAST_BLOCK = 3
#: Signature characters at most; a text beyond them ends in one longer chunk.
LENGTH = 64
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
#: Code of a null id in the order of documents: before every other.
NO_ID = -(2 ** 63)

OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                 ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                 ("near_edited", pa.float64()), ("near_next", pa.float64())])
OUT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")


def _signature(mixed: np.ndarray, ends: np.ndarray) -> str:
    ends = ends[: LENGTH - 1]
    starts = np.concatenate([[0], ends + 1])
    starts = starts[starts < len(mixed)]
    sums = np.add.reduceat(mixed, starts)
    codes = (sums * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
    return ALPHABET[codes.astype(np.int64)].tobytes().decode()


def fingerprint(text: str) -> str:
    """``block:signature:signature at double the block`` of the whole text."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return f"{LEAST_BLOCK}::"
    rolled = np.zeros(len(data), np.uint32)
    factor = 1
    for back in range(min(WINDOW, len(data))):
        rolled[back:] += data[: len(data) - back].astype(np.uint32) * np.uint32(factor)
        factor = factor * 16_777_619 % 2 ** 32
    mixed = rolled.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    counter = (mixed & np.uint64(0xFFFFFFFF)) + np.uint64(1)
    at = np.flatnonzero(counter % np.uint64(LEAST_BLOCK) == 0)
    third = counter[at] // np.uint64(LEAST_BLOCK)
    # the level of a boundary: how often the block may double with the boundary still one
    level = np.bitwise_count((third & (~third + np.uint64(1))) - np.uint64(1))
    k = 0
    while LEAST_BLOCK * 2 ** k * LENGTH < len(data):
        k += 1
    while k and np.count_nonzero(level >= k) < LENGTH // 2:
        k -= 1
    return (f"{LEAST_BLOCK * 2 ** k}:{_signature(mixed, at[level >= k])}"
            f":{_signature(mixed, at[level >= k + 1])}")


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance by bit vectors over the shorter string."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for c in b:
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(xh | plus), plus & xh
        score += bool(up & top) - bool(down & top)
        up = (up << 1) | 1
        down <<= 1
        plus = (down | ~(xv | up)) & full
        minus = up & xv & full
    return score


def _alike(a: str, b: str) -> float:
    return 1.0 - edit_distance(a, b) / max(len(a), len(b)) if a and b else 0.0


def likeness(a: str, b: str) -> float:
    """0 to 1: 1 for equal fingerprints, 0 for incompatible block sizes."""
    if a == b:
        return 1.0
    (sa, a1, a2), (sb, b1, b2) = a.split(":"), b.split(":")
    sa, sb = int(sa), int(sb)
    if sa == sb:
        return max(_alike(a1, b1), _alike(a2, b2))
    if sa == 2 * sb:
        return _alike(a1, b2)
    if sb == 2 * sa:
        return _alike(a2, b1)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many of the next text's first."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _row(doc_id, text: str, print_: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following)
    changed_print = print_ if changed == text else fingerprint(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), print_, changed_print,
            likeness(print_, changed_print), likeness(print_, next_print))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part and place; each is held until its successor comes."""
    held = None
    for batch in batches:
        out = []
        for part, tail, doc_id, text in zip(batch["part"].to_pylist(), batch["tail"].to_pylist(),
                                            batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            print_ = fingerprint(text)
            if held and held[0] == part:
                out.append(_row(*held[1:], text, print_))
            held = None if tail else (part, doc_id, text, print_)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * len(OUT), OUT)],
                                         schema=OUT)


def piecewise_hashes(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    Documents follow each other by (doc_id, text); after the last comes the
    first, so a single document follows itself. A null text counts as empty, a
    null id comes before every other; repeated rows are neighbours like any
    others. Empty tables give no rows; other columns are ignored.

    The id range is cut at quantiles into as many parts as there are shuffle
    partitions, and the first document of a part also travels to the part
    before it: each text is shuffled once.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("place"), "doc_id",
                       F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / parts for i in range(1, parts)]
    cuts = sorted({int(x) for x in rows.approxQuantile("place", shares, 0.002)}) if shares else []
    home = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("place"))) if cuts else F.lit(0)
    firsts = sorted((r["part"], r["place"]) for r in  # a row per part
                    rows.select("place", home.alias("part")).groupBy("part").agg(F.min("place").alias("place")).collect())
    before = [(firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))]
    before = spark.createDataFrame(before, "place long, earlier int")
    own = F.struct(home.alias("part"), F.lit(False).alias("tail"))
    copy = F.struct(F.col("earlier").alias("part"), F.lit(True).alias("tail"))
    dealt = (rows.join(F.broadcast(before), "place", "left")
             .select("place", "doc_id", "text",
                     F.explode(F.when(F.col("earlier").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("d"))
             .select("d.part", "d.tail", "place", "doc_id", "text"))
    return (dealt.repartitionById(parts, F.col("part") % parts).sortWithinPartitions("part", "tail", "place", "text")
            .mapInArrow(_pairs, OUT_DDL))
