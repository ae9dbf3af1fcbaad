"""Conversation repair against all edits by dynamic programming over (cost, edits)."""

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from popflow.llm.conversations import ORDER, damaged, lower_bounds, repair, repair_conversations
from popflow.llm.queries import op12_conversations
from tests.conftest import SF001, SF01

NEXT_STATE = {0: 2, 1: 2, 2: 3, 3: 2}
ROW = "conv_id long, turn long, role string, text string"


def best(turns):
    """(cost, edits), least by cost, then by the edits' letters; fault 0 sound, 1 and 2 to delete, 3 truncated."""
    n, table = len(turns), {}
    for i in range(n, -1, -1):
        row = {}
        for q in range(4):
            options = [(0, "")] if i == n and q in (0, 3) else []
            if i < n:
                initial, fault = turns[i]
                options.append((2 + table[i + 1, q][0], "D" + table[i + 1, q][1]))
                if fault in (0, 3):
                    more = 5 if fault == 3 else 0
                    if (q, initial) in ORDER:
                        c, a = table[i + 1, ORDER[q, initial]]
                        options.append((more + c, "K" + a))
                    c, a = table[i + 1, NEXT_STATE[q]]
                    options.append((more + 1 + c, "R" + a))
            row[q] = min(options, default=(1 << 40, ""))
        for _ in range(4):
            for q in range(4):
                c, a = row[NEXT_STATE[q]]
                row[q] = min(row[q], (c + 5, "I" + a))
        table |= {(i, q): row[q] for q in range(4)}
    return table[0, 0]


def test_search_equals_all_edits():
    rng = random.Random(4)
    for trial in range(1_500):
        n = rng.randrange(12) if trial % 50 else rng.randrange(40, 120)
        turns = [(rng.choice(("s", "u", "a", "t", "", "u", "a")), rng.choice((0, 0, 0, 0, 1, 2, 3))) for _ in range(n)]
        assert repair(turns) == best(turns)
        assert lower_bounds(turns)[0][0] <= best(turns)[0]


def test_search_of_a_very_long_conversation():
    rng = random.Random(6)
    turns = [(rng.choice("ua") if rng.random() < .2 else "ua"[i % 2], rng.choice([0] * 12 + [1, 2, 3])) for i in range(3_000)]
    assert repair(turns) == best(turns)


def expected(rows):
    """Results by conv_id of (conv_id, turn, role, text) rows."""
    def plain(v):
        return " " if v is None else str(v)

    after = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{plain(conv)}:{plain(turn)}".encode()) % 20
        out = after.setdefault(conv, [])
        role, text = plain(role), plain(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out.extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    results = []
    for conv, turns in after.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in turns:
            end = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append(1 if not end else 2 if (role, text) in seen else 3 if end[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in turns]
        cost, edits = best(list(zip(initials, faults)))
        lines, state, at = [], 0, 0
        for e in edits:
            if e == "K":
                lines.append(f"{turns[at][1]}:{turns[at][2]}")
                state = ORDER[state, initials[at]]
            elif e in "IR":
                role = "assistant" if state == 2 else "user"
                lines.append(f"{role}:{turns[at][2] if e == 'R' else ''}")
                state = NEXT_STATE[state]
            at += e != "I"
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        results.append((conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, edits,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(results, key=repr)


def test_query_equals_brute_force(spark):
    for sf in (SF001, SF01):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
                .select("conv_id", "turn", "role", "text").collect()]
        got = sorted((tuple(r) for r in op12_conversations(spark, sf).collect()), key=repr)
        assert got == expected(rows)
        assert any(r[6] for r in got) and {"D", "K", "R"} <= set("".join(r[7] for r in got))


def test_odd_rows_have_defined_results(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a."), (1, 0, "user", "a."), (1, 9, "assistant", "b"), (2, 0, "", ""),
            (None, 1, "user", "Hi?"), (None, None, "system", "\t\n"), (3, None, "assistant", "x!"), (3, None, "user", "y!"),
            (4, 1, "tool", "z." * 100_000), (5, -3, "user", "ä. "), (5, 4, "assistant", "o.\x0b ")]
    rows += [(6, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(400)]
    rows += [(7 + i, 0, "user", "So.") for i in range(60)]  # some of them lose their only row
    df = spark.createDataFrame(rows, ROW).repartition(4).withColumns({"place": F.lit(1), "later": F.lit("x"), "n_chars": F.lit("y")})
    got = sorted((tuple(r) for r in repair_conversations(damaged(df)).collect()), key=repr)
    assert got == expected(rows)
    assert any(r[1:8] == (0, 0, 0, 0, 0, 0, "") for r in got)
    empty = repair_conversations(damaged(df.limit(0)))
    assert empty.columns[-2:] == ["audit", "repaired_sha256"] and empty.count() == 0


def test_texts_never_gather_in_a_conversation(spark):
    """One shuffle by conversation, no aggregation that would hold its rows."""
    df = spark.createDataFrame([(1, 0, "user", "a.")], ROW)
    plan = repair_conversations(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(conv_id") == 1 and "Aggregate" not in plan
