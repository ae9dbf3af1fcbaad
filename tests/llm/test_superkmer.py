import hashlib
import random

import numpy as np

from popflow.llm import superkmer


def plain(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    big = 2 ** 63 - 1
    first = {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k:k + window])
            first[key] = min(first.get(key, big), big if i is None else i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k:k + window])] < (big if i is None else i):
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = ["a", "b", "é", "d,", "e"]
    passage = [rng.choices(vocab, k=rng.randint(10, 40)) for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passage) if rng.random() < 0.6 else rng.choices(vocab + [str(rng.random())], k=rng.randint(1, 30))
        rows.append((i * 3 % n, rng.choice([" ", "  ", "\t", "\n"]).join(words)))
    return rows


def got(df, window):
    return sorted(map(tuple, superkmer.substring_dedup(df, window).collect()), key=str)


def test_matches_brute_force(make_docs):
    rows = corpus(1) + [(None, "a b " * 30), (None, "a b " * 30), (400, "x " * 3000), (401, "x " * 20),
                        (402, None), (403, ""), (7, "a b é d, e " * 9), (7, "a b é d, e " * 9), (7, "b " * 13)]
    for window in (13, 3):
        assert got(make_docs(rows, doc=1, spans="clash", row=2), window) == plain(rows, window)


def test_many_copies_and_small_flushes(make_docs, monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choices([f"w{i}" for i in range(500)], k=90))
    rows = [(i, text if i % 3 else text + f" end{i}") for i in range(300)] + [(500 + i, t) for i, t in corpus(3, 30)]
    monkeypatch.setattr(superkmer, "CHUNK", 5)
    assert got(make_docs(rows), 13) == plain(rows, 13)


def test_empty_table(make_docs):
    assert superkmer.substring_dedup(make_docs([])).collect() == []


def test_counting_by_sort_is_exact_whatever_the_digests(monkeypatch):
    rng = random.Random(6)
    windows = [b" ".join(rng.choices([b"a", b"b", b"c"], k=4)) for _ in range(500)]
    docs = np.array([rng.randrange(90) for _ in windows])
    want = {}
    for w, d in zip(windows, docs.tolist()):
        want[w] = min(want.get(w, d), d)
    assert superkmer.least_by_sort(windows, docs).tolist() == [want[w] for w in windows]
    # digests that collide: the words decide
    monkeypatch.setattr(superkmer.xxhash, "xxh3_128_digest", lambda w: bytes([w[0]]) * 16)
    assert superkmer.least_by_sort(windows, docs).tolist() == [want[w] for w in windows]
    assert superkmer.least_by_sort([], docs[:0]).tolist() == []
