"""Periodic runs of words, and texts with their repetitions collapsed.

Longest common extensions (LCE) of two word positions come from a difference
cover: only suffixes that start at positions of a fixed cover modulo 31 are
sorted. Any two positions reach a pair of sorted ones after fewer than 31
steps; those words are compared directly, the rest is a range minimum over the
common prefix lengths of neighbouring sorted suffixes, held in a sparse table.

Runs are enumerated on a harmonic grid: for every period q the grid points
0, q, 2q, ... (n ln n of them over all q). A run of three periods covers two
neighbouring grid points, from which extensions forward and backward give its
ends. Each document is one row's work; Spark deals the rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import ship

WORD = re.compile(r"[^ \t-\r]+")
#: A perfect difference set, every difference modulo 31 occurs in it.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Grid points compared at once (bounds the memory of a very long text).
GRID_BLOCK = 1 << 20

_SHIFT = np.full(MODULUS, -1)
for _a in COVER:
    for _b in COVER:
        _SHIFT[(_b - _a) % MODULUS] = _a


class Extensions:
    """Longest common prefixes of the suffixes of a word sequence."""

    def __init__(self, x: np.ndarray):
        self.n = len(x)
        # The end compares as a word of its own, below all others.
        self.x = np.concatenate([x.astype(np.int32), np.full(MODULUS, -1, np.int32)])
        self.rank: np.ndarray | None = None

    def _sort_samples(self) -> None:
        """Rank the suffixes at cover positions and keep their neighbours' common lengths."""
        classes = [np.arange(a, self.n, MODULUS) for a in COVER]
        at = np.concatenate(classes)
        end = np.repeat(np.cumsum([len(c) for c in classes]), [len(c) for c in classes])
        m = len(at)
        windows = np.lib.stride_tricks.sliding_window_view(self.x, MODULUS)
        # big-endian bytes order like the words themselves
        blocks = (windows[at].astype(np.int64) + 1).astype(">u4").view(np.dtype((np.void, 4 * MODULUS))).ravel()
        rank = np.unique(blocks, return_inverse=True)[1].astype(np.int64)
        levels, step, here = [rank], 1, np.arange(m)
        while m and rank.max() < m - 1:
            there = here + step
            follows = np.where(there < end, rank[np.minimum(there, m - 1)] + 1, 0)
            key = rank * (m + 1) + follows
            order = np.argsort(key, kind="stable")
            new = np.empty(m, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank, step = new, step * 2
            levels.append(rank)
        order = np.argsort(rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(0, m - 1), np.int64)
        ia, ib = a.copy(), b.copy()
        for k in range(len(levels) - 1, -1, -1):
            inside = (ia < end[a]) & (ib < end[b])
            same = inside & (levels[k][np.minimum(ia, m - 1)] == levels[k][np.minimum(ib, m - 1)])
            common += same * (MODULUS << k)
            ia, ib = ia + (same << k), ib + (same << k)
        # A name holds at least its own block; equal names count only as far as both texts go.
        common = np.minimum(common, self.n - np.maximum(at[a], at[b]))
        open_ = np.arange(len(common))
        while len(open_):
            pa_, pb = at[a[open_]] + common[open_], at[b[open_]] + common[open_]
            inside = np.maximum(pa_, pb) < self.n
            go = inside & (self.x[np.minimum(pa_, self.n)] == self.x[np.minimum(pb, self.n)])
            open_ = open_[go]
            common[open_] += 1
        self.rank = np.full(self.n + 1, -1)
        self.rank[at] = rank
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of the common lengths in [low, high), high > low."""
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            on = level == k
            t = self.table[k]
            out[on] = np.minimum(t[low[on]], t[high[on] - (1 << k)])
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common length of the suffixes at i and j, i < j <= n."""
        shift = (_SHIFT[(j - i) % MODULUS] - i) % MODULUS
        out = np.zeros(len(i), np.int64)
        alive = np.arange(len(i))
        for t in range(MODULUS):
            go = (t < shift[alive]) & (self.x[np.minimum(i[alive] + t, self.n)] == self.x[np.minimum(j[alive] + t, self.n)])
            stopped = alive[~go]
            # at its pair of samples: t words agree, the sorted suffixes tell the rest
            met = stopped[shift[stopped] == t]
            out[stopped] = t
            met = met[j[met] + t < self.n]
            if len(met):
                if self.rank is None:
                    self._sort_samples()
                ri, rj = self.rank[i[met] + t], self.rank[j[met] + t]
                out[met] += self._least(np.minimum(ri, rj), np.maximum(ri, rj))
            alive = alive[go]
            if not len(alive):
                break
        return out


def grid(n: int, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(point, period, step) of neighbouring grid points, in blocks.

    A run of period q has at least max(least, times q) - q places that agree
    with the one q further; a step of half of that puts two points in it.
    """
    periods = np.arange(1, n // times + 1)
    steps = np.maximum((times - 1) * periods, least - periods) // 2
    counts = np.maximum(0, (n - periods - steps - 1) // steps + 1)
    sums = np.cumsum(counts)
    low = 0
    while low < len(periods):
        base = sums[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sums, base + GRID_BLOCK, "right")))
        c = counts[low:high]
        q, step = np.repeat(periods[low:high], c), np.repeat(steps[low:high], c)
        within = np.arange(len(q)) - np.repeat(np.cumsum(c) - c, c)
        yield within * step, q, step
        low = high


def word_runs(x: np.ndarray, least: int = 24, times: int = 3) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of word numbers, by start, period."""
    n = len(x)
    forward = Extensions(x)
    backward: Extensions | None = None
    found = []
    for g, q, step in grid(n, least, times):
        # Both points of a run agree with the places one period on: the first word of each extension.
        on = x[g] == x[g + q]
        g, q, step = g[on], q[on], step[on]
        on = x[g + step] == x[g + step + q]
        g, q, step = g[on], q[on], step[on]
        if not len(g):
            continue
        ahead = forward.lce(g, g + q)
        on = ahead > step
        g, q, ahead = g[on], q[on], ahead[on]
        if not len(g):
            continue
        if backward is None:
            backward = Extensions(x[::-1])
        behind = backward.lce(n - g - q, n - g)
        length = behind + ahead + q
        on = length >= np.maximum(least, times * q)
        found.append(np.stack([g - behind, length, q], axis=1)[on])
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)  # by start, length, period
    # A stretch that is also periodic with a multiple is a run of its smallest period only.
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapsed(words: list[str], runs: np.ndarray) -> list[str]:
    """The words outside of every run's part after its first period."""
    if not len(runs):
        return words
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(marks[:-1]) == 0)]


def strongest(runs: np.ndarray) -> int | None:
    """Index of the run of greatest length / period; ties: smallest start, then period."""
    best = None
    for k, (_, length, period) in enumerate(runs.tolist()):
        if best is None or length * runs[best, 2] > runs[best, 1] * period:
            best = k
    return best


RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
OUT = pa.schema([("runs", RUNS), ("strongest", pa.int32()), ("collapsed", pa.string())])


def _find(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"runs": [], "strongest": [], "collapsed": []}
            for text in batch["text"]:
                words = WORD.findall(text.as_py() or "")
                numbers: dict[str, int] = {}
                x = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32)
                rows = word_runs(x, least, times)
                out["runs"].append([{"start": s, "length": n, "period": p} for s, n, p in rows.tolist()])
                out["strongest"].append(strongest(rows))
                out["collapsed"].append(" ".join(collapsed(words, rows)))
            found = pa.RecordBatch.from_pydict(out, schema=OUT)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *found.columns],
                                             schema=pa.schema([batch.schema.field("doc_id"), *OUT]))
    return run


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """doc_id, runs (start, length, period in words), strongest, collapsed.

    A run is a stretch of words of smallest period q and at least
    max(least, times q) words (``times`` at least 2) that no neighbouring word
    extends with that period. ``strongest`` is the index of the run of greatest
    length / period, null without runs; ``collapsed`` holds the words, joined
    by one space, that lie in no run behind its first period. One row per input
    row: repeated rows give equal rows, a null text counts as empty, null ids
    stay null, other columns are ignored, an empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _find(least, times), f"doc_id {kind}, runs {RUN}, strongest int, collapsed string")


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every tenth document, by its id's checksum, made periodic from some word on.

    With h = crc32(doc_id in decimal), g = h div 10 and n words, a document
    with h mod 10 = 0 repeats its words from a = g mod n on with period
    1 + (n - a) div (3 + g mod 8). Null ids and texts without words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("_h"), F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit("[^ \\t-\\r]+"), F.lit(0))).alias("_w"))
    part = words.withColumns({"_n": F.size("_w").cast("long"), "_g": F.floor(F.col("_h") / 10)})
    part = part.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    part = part.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    again = F.transform("_w", lambda w, i: F.when(
        i >= F.col("_a"),
        F.get("_w", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))).otherwise(w))
    return part.select("doc_id", F.when(F.col("_n") > 0, F.array_join(again, " "))
                       .otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, and digests of all runs and of the collapsed text."""
    top = F.get("runs", F.col("strongest"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("_top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_top.start", "_top.length", "_top.period",
        F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
