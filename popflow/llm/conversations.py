"""Repair of the turn order of conversations by iterative-deepening A*.

A repair keeps, reroles, deletes and inserts turns so that the role initials
read s?(ua)+ or nothing. The search goes depth first over the edits in ASCII
order (D, I, K, R) under a cost bound; the first path that reaches the end is
the answer, and where none does, the bound rises to the least cost that was cut
off. A table keeps, for every state that failed, the cost its completion needs
at least, so that a state is opened again only with more left to spend.

Rows reach the search sorted, one conversation after the other. Every row comes
twice: first without its text, then, behind the conversation's last row, with
it. The search needs only the first kind; the texts stream past it into the
digest, so a task never holds a conversation's texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from popflow.llm.common import ship

#: Costs of the edits, and what an undeleted truncated turn adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the order s?(ua)+: nothing yet, behind s, behind u, behind a.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
#: The state behind a kept turn, by state and role initial.
ORDER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Role of an inserted or reroled turn, and the state behind it, by state.
NEXT = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
#: Initials that may follow each other.
PAIRS = ("su", "ua", "au")
#: Cuts at which the lower bound lets the state of the order go free.
CUTS = 32
FAR = 1 << 60

#: Faults of a turn; the first that holds counts.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)


def keep_cost(fault: int) -> int:
    return {SOUND: KEEP, CUT_OFF: TRUNCATED}.get(fault, FAR)


def lower_bounds(turns: list[tuple[str, int]]) -> list[list[int]]:
    """Least cost of completing from each position and state, never above the true one.

    The turns are dealt into at most CUTS stretches; a stretch is priced exactly
    but may begin in whichever state suits it.
    """
    n = len(turns)
    size = max(1, -(-n // CUTS))
    bounds = [[0] * 4 for _ in range(n + 1)]
    # Completing behind the last turn: an open user turn lacks its answer, a lone system turn both.
    bounds[n] = [0, 2 * INSERT, INSERT, 0]
    for i in range(n - 1, -1, -1):
        initial, fault = turns[i]
        after = bounds[i + 1]
        if (i + 1) % size == 0 and i + 1 < n:
            after = [min(after)] * 4
        keep = keep_cost(fault)
        row = []
        for state in range(4):
            best = DELETE + after[state]
            if keep < FAR:
                if (state, initial) in ORDER:
                    best = min(best, keep + after[ORDER[state, initial]])
                best = min(best, keep + REROLE + after[NEXT[state][1]])
            row.append(best)
        # An insertion moves on to the next state; two of them come round.
        for _ in range(3):
            row = [min(row[s], INSERT + row[NEXT[s][1]]) for s in range(4)]
        bounds[i] = row
    return bounds


def repair(turns: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair; among equals the ASCII-least edits.

    ``turns`` holds each turn's role initial and fault.
    """
    n = len(turns)
    bounds = lower_bounds(turns)
    failed: dict[tuple[int, int], int] = {}

    def needs(i: int, state: int) -> int:
        return max(bounds[i][state], failed.get((i, state), 0))

    def edits(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, NEXT[state][1]
        if i < n and (keep := keep_cost(turns[i][1])) < FAR:
            if (state, turns[i][0]) in ORDER:
                yield "K", keep, i + 1, ORDER[state, turns[i][0]]
            yield "R", keep + REROLE, i + 1, NEXT[state][1]

    limit = needs(0, START)
    while True:
        # One entry per state on the path: state, edits left to try, what its completion needs at least.
        path, spent = [], 0
        stack = [[(0, START), edits(0, START), FAR]]
        while stack:
            (i, state), left, _ = stack[-1]
            if i == n and state in FINAL:
                return spent, "".join(name for name, _ in path)
            for name, cost, j, then in left:
                need = cost + needs(j, then)
                if spent + need > limit:
                    stack[-1][2] = min(stack[-1][2], need)
                    continue
                path.append((name, cost))
                spent += cost
                stack.append([(j, then), edits(j, then), FAR])
                break
            else:
                failed[i, state] = max(failed.get((i, state), 0), stack.pop()[2])
                if path:
                    _, cost = path.pop()
                    spent -= cost
                    stack[-1][2] = min(stack[-1][2], cost + failed[i, state])
        limit = needs(0, START)


# -- one conversation after the other -------------------------------------------

class _Conversation:
    """Collects a conversation's turns, repairs them, then takes their texts in."""

    def __init__(self):
        self.turns: list[tuple[str, int]] = []
        self.seen: set[bytes] = set()
        self.faults = [0] * 4
        self.illegal, self.distinct, self.low, self.high, self.last = 0, 0, None, None, None
        self.answer: tuple[int, str] | None = None
        self.digest, self.first = hashlib.sha256(), True
        self.at = 0  # next edit
        self.state = START

    def turn(self, turn: int | None, initial: str, blank: bool, cut_off: bool, identity: bytes) -> None:
        duplicate = identity in self.seen
        self.seen.add(identity)
        fault = BLANK if blank else DUPLICATE if duplicate else CUT_OFF if cut_off else SOUND
        self.faults[fault] += 1
        if self.turns and self.turns[-1][0] + initial not in PAIRS:
            self.illegal += 1
        self.turns.append((initial, fault))
        if turn is not None:
            self.distinct += turn != self.last
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn

    def solve(self) -> None:
        if self.answer is None:
            self.answer = repair(self.turns)

    def _line(self, role: str, text: str) -> None:
        self.digest.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False

    def _insertions(self) -> None:
        edits = self.answer[1]
        while self.at < len(edits) and edits[self.at] == "I":
            role, self.state = NEXT[self.state]
            self._line(role, "")
            self.at += 1

    def text(self, role: str, text: str) -> None:
        self.solve()
        self._insertions()
        edit = self.answer[1][self.at]
        self.at += 1
        if edit == "K":
            self._line(role, text)
            self.state = ORDER[self.state, role[:1]]
        elif edit == "R":
            role, self.state = NEXT[self.state]
            self._line(role, text)

    def result(self, conv_id: int | None) -> dict:
        self.solve()
        self._insertions()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {"conv_id": conv_id, "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
                "truncated": self.faults[CUT_OFF], "illegal": self.illegal, "cost": self.answer[0],
                "audit": self.answer[1], "repaired_sha256": self.digest.hexdigest()}


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: Results handed on at a time.
FLUSH = 2_000


def _repairs(kind: pa.DataType):
    out_schema = pa.schema([("conv_id", kind), *[(c, pa.int64()) for c in COUNTS],
                            ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        current, conversation = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if conversation is None or current != r["conv_id"]:
                    if conversation is not None:
                        done.append(conversation.result(current))
                    current, conversation = r["conv_id"], _Conversation()
                if r["dropped"]:
                    continue
                if r["later"]:
                    conversation.text(r["role"], r["text"])
                else:
                    conversation.turn(r["turn"], r["role"][:1], r["blank"], r["cut_off"], r["identity"])
            if len(done) >= FLUSH:
                yield pa.RecordBatch.from_pylist(done, schema=out_schema)
                done = []
        if conversation is not None:
            done.append(conversation.result(current))
        yield pa.RecordBatch.from_pylist(done, schema=out_schema)
    return run


#: White space as the tables have it: blank, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, nulls first; rows of one turn by role, then text.
    Nulls in role or text count as one space; a null conv_id is a conversation
    of its own. A role without characters has no initial and fits no place. An
    optional boolean column ``dropped`` marks rows that are gone but whose
    conversation is still to be named: without other rows it has zeros, an
    empty audit and the digest of the empty string. Other columns are ignored;
    an empty table gives no rows.
    """
    ship(rows.sparkSession)
    dropped = F.coalesce("dropped", F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), dropped.alias("dropped"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = plain.withColumn("place", F.row_number().over(order))
    end = F.rtrim("text", F.lit(SPACES))
    # The length in front keeps (role, text) pairs apart.
    identity = F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256))

    def first(value: Column) -> Column:
        return F.when(~F.col("later"), value)

    twice = placed.withColumn("later", F.explode(F.array(F.lit(False), F.lit(True)))).select(
        "conv_id", "later", "place", "turn", "role", "dropped",
        F.when(F.col("later"), F.col("text")).alias("text"),
        first(end == "").alias("blank"), first(~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
        first(identity).alias("identity"))
    kind = rows.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
    # The window's shuffle by conversation still holds; only the rows' order changes.
    return twice.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "later", "place").mapInArrow(
        _repairs(to_arrow_type(kind)), f"{schema}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with some of their turns damaged by a checksum of conv_id:turn.

    Modulo 20: 0 drops the row (marked), 1 empties its text, 2 removes its full
    stops, exclamation and question marks, 3 repeats it, 4 makes it the user's.
    Nulls count as one space, also in the checksum.
    """
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    role, text = plain("role"), plain("text")
    out = rows.select("conv_id", "turn", kind.alias("_kind"), role.alias("role"), text.alias("text"))
    out = out.withColumns({
        "role": F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")),
        "text": F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                 .otherwise(F.col("text")),
        "dropped": F.col("_kind") == 0})
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return out.withColumn("_copy", F.explode(copies)).select("conv_id", "turn", "role", "text", "dropped")
