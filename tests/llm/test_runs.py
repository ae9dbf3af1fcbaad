"""Periodic runs against a scan of every period, and the query's digests on whole tables."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from popflow.llm.queries import op11_runs
from popflow.llm.runs import Extensions, collapsed, looped, periodic_runs, run_digests, strongest, word_runs
from tests.conftest import SF001


def scan(x, least=24, times=3):
    """Every maximal stretch of every period, of its smallest period only."""
    n, out = len(x), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def sequences():
    rng = random.Random(5)
    yield []
    for n in (1, 23, 24, 25, 72, 200, 500):
        for letters in (1, 2, 3, 8):
            x = [rng.randrange(letters) for _ in range(n)]
            for _ in range(3):
                a, p = rng.randrange(n), rng.randrange(1, 40)
                for i in range(a + p, min(n, a + rng.randrange(20, 200))):
                    x[i] = x[i - p]
            yield x


@pytest.mark.parametrize("least,times", [(24, 3), (6, 2)])
def test_runs_equal_a_scan(least, times):
    for x in sequences():
        assert [tuple(r) for r in word_runs(np.array(x, np.int32), least, times).tolist()] == scan(x, least, times)


def test_extensions_equal_a_comparison():
    rng = np.random.default_rng(3)
    for n in (2, 31, 200, 700):
        x = rng.integers(0, 2, n).astype(np.int32)
        x[n // 2:] = x[:n - n // 2]
        i = rng.integers(0, n - 1, 100)
        j = np.array([rng.integers(a + 1, n) for a in i])
        want = [next((k for k in range(n - b) if x[a + k] != x[b + k]), n - b) for a, b in zip(i, j)]
        assert Extensions(x).lce(i, j).tolist() == want


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = scan(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(kept))


def test_query_equals_brute_force_on_whole_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in op11_runs(spark, SF001).collect()}
    assert got.keys() == docs.keys()
    some = [i for i in docs if len(docs[i] or "") < 20_000]
    assert len(some) > 150
    for i in some:
        assert got[i] == expected(i, docs[i])


def test_odd_rows_have_defined_results(make_docs):
    loop = "a b c d e f " * 9
    rows = [(0, None), (0, ""), (1, " \n\t"), (1, loop), (1, loop), (None, loop), (None, None),
            (2, "x " * 50_000), (25, "ä ö\U0001F600 " * 30), (26, "one two")]
    docs = make_docs(rows, runs="clash", strongest=1, _w="w", _n=2)
    got = sorted((tuple(r) for r in run_digests(periodic_runs(looped(docs))).collect()), key=repr)
    assert got == sorted((expected(i, t) if len(t or "") < 20_000 else (
        2, 1, 0, 50_000, 1, 50_000_000, *(hashlib.sha256(s).hexdigest() for s in (b"0,50000,1\n", b"x"))) for i, t in rows), key=repr)
    empty = run_digests(periodic_runs(looped(docs.limit(0))))
    assert empty.columns[:3] == ["doc_id", "n_runs", "start"] and empty.count() == 0


def test_operator_returns_spans_and_texts(make_docs):
    found = periodic_runs(make_docs([(4, "s " + "u v " * 20 + "t")])).first()
    assert [tuple(r) for r in found.runs] == [(1, 40, 2)] and found.strongest == 0
    assert found.collapsed == "s u v t"


def test_ties_take_the_smallest_start_then_period():
    runs = np.array([(0, 24, 6), (5, 40, 10), (5, 48, 12), (60, 24, 8)])
    assert strongest(runs) == 0
    assert strongest(runs[1:]) == 0 and strongest(runs[:0]) is None
    assert collapsed(list("ab"), runs[:0]) == ["a", "b"]
