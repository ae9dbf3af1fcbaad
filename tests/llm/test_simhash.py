import random

import xxhash

from popflow.llm import simhash


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ")
             .replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=4):
    fps = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((doc, f"{fps[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def test_fingerprint_definition():
    for text in ("", "One", "a B c", "a b\tc d e F\n g " * 50, "é É Ü ß x y z", "x " * 200_000):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_groups_match_brute_force(make_docs):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 40)))) for i in range(80)]
    for i in range(80, 140):  # near copies
        words = rows[rng.randrange(len(rows))][1].split()
        if words:
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i, " ".join(words) * 3))
    rows += [(200, None), (201, ""), (None, "w1 w2 w3 w4"), (7, rows[7][1]), (None, "zz yy xx qq")]
    got = simhash.simhash_groups(make_docs(rows, fp="clash", component_id=1))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups(rows)


def test_small_tiles_link_like_large_ones(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(50)}
    for f in list(fps):
        for _ in range(6):
            fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")

    def parts(tile):
        from popflow.llm.graph import components
        return sorted(map(tuple, components(simhash.simhash_links(df, 4, tile)).collect()))
    assert parts(2) == parts(10_000) != []


def test_empty_table(make_docs):
    assert simhash.simhash_groups(make_docs([])).collect() == []


def test_components_of_a_path_and_a_star(spark):
    from popflow.llm.graph import components
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (301, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {300: 300, 301: 300}
    assert got == want
