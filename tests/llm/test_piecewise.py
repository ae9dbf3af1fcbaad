import hashlib
import random

import pytest

from popflow.llm import piecewise as pw


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_edit_distance_matches_the_table():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 20))) for _ in "ab")
        assert pw.edit_distance(a, b) == plain_distance(a, b)


def test_fingerprints_are_local():
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(800))
    other = " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(800))
    print_ = pw.fingerprint(text)
    assert print_ == pw.fingerprint(text)
    assert pw.likeness(print_, pw.fingerprint(text[:2000] + "X" + text[2000:])) > 0.85
    assert pw.likeness(print_, pw.fingerprint(pw.edited(text, other))) > 0.5
    assert pw.likeness(print_, pw.fingerprint(other)) < 0.3
    block, one, two = print_.split(":")
    assert int(block) % 3 == 0 and 16 <= len(one) <= pw.LENGTH and len(two) <= pw.LENGTH
    assert pw.fingerprint("") == "3::" and pw.likeness("3::", print_) == 0.0
    assert pw.fingerprint("a" * 500_000)


@pytest.mark.parametrize("parts", [1, 4])
def test_rows_follow_each_other_by_id(spark, make_docs, parts):
    rng = random.Random(4)
    rows = [(i * 7 % 101 * 1000, " ".join(rng.choices(["ab", "é", "ñu", "xyz"], k=rng.randint(0, 60)))) for i in range(90)]
    rows += [(None, "no id"), (5, None), (5, None), (6, ""), (9_000_000, "last text of all")]
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = pw.piecewise_hashes(make_docs(rows, place=1, part="x", tail=2)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    order = sorted(((-2 ** 63 if i is None else i, (t or "").encode()), i, t or "") for i, t in rows)
    want = []
    for k, (_, i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        cut = len(text) // 4
        changed = text[:len(text) - cut] + after[:cut]
        prints = [pw.fingerprint(x) for x in (text, changed, after)]
        want.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1],
                     pw.likeness(prints[0], prints[1]), pw.likeness(prints[0], prints[2])))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_one_document_follows_itself_and_none_gives_none(make_docs):
    assert pw.piecewise_hashes(make_docs([])).collect() == []
    (row,) = pw.piecewise_hashes(make_docs([(3, "abcdefgh")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0
