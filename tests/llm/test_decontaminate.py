import hashlib
import random
import re

from popflow.llm.decontaminate import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    wins = {}
    for item, text in items:
        ws = words(text)
        for k in range(max(1, len(ws) - window + 1) if ws else 0):
            wins.setdefault(tuple(ws[k:k + window]), set()).add(item)
    lengths = {len(w) for w in wins}
    out = []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(ws) - n + 1):
                if (w := tuple(ws[k:k + n])) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[w]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, contamination(docs, bench).collect()), key=str)


def test_matches_brute_force(spark, make_docs):
    rng = random.Random(1)
    vocab = ["the", "of", "É", "é", "Straße", "x1", "42", "ΑΣ", "ok"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(8, 25)))) for i in range(20)]
    items += [(50, "only, THREE Words!"), (51, "two words"), (52, "Single"), (53, None), (54, " ,,, "), (55, ""),
              (None, "a null item of a few words"), (0, items[0][1]), (56, items[1][1].upper()), (57, "ΑΣ.ΑΣ ok ΑΣ")]
    docs = []
    for i in range(60):
        part = []
        for _ in range(rng.randint(0, 6)):
            pick = rng.choice(items)[1] or ""
            part.append(pick if rng.random() < 0.3 else " ".join(rng.choices(vocab, k=rng.randint(1, 30))))
        docs.append((i, rng.choice([" ", ", ", "...\n"]).join(part)))
    docs += [(100, None), (101, ""), (102, "!!!"), (3, docs[3][1]), (3, "only three words"), (None, "two words single"),
             (103, "so-called TWO\twords " * 5000), (104, "a null item of a few words")]
    for sub in (items, items[:20], items[-4:]):
        assert run(spark, make_docs(docs, w=1, text_key=2, candidates=3), sub) == plain(docs, sub)


def test_empty_tables(spark, make_docs):
    assert run(spark, make_docs([]), [(1, "a b c")]) == []
    docs = [(1, "a b c"), (2, None)]
    assert run(spark, make_docs(docs), []) == plain(docs, [])
