"""Personal data by bootstrapped contextual extraction.

The identifiers that the base patterns find are seeds. The words around them
induce lexical patterns (left pair, left word with right word); patterns and
the identifier-like strings they surround form a graph that is scored in
rounds: a pattern is as good as the share of trusted instances it surrounds, an
instance as its patterns together. Patterns trusted at the end name the kind of
strings that no base pattern matched. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popflow.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
#: Each base pattern in a form of linear time: leftmost starts are those not
#: inside a run, or right behind the previous match, and runs never give back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text that does not match this can't hold the kind.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
#: Where a telephone or card form may end: at the end of a run without white space, or at its closing marks.
END = r"""(?=[.,;:!?)\]}>"']*+(?!\S))"""
NUMBER = "[0-9]++(?:-[0-9]++)*+" + END
#: Identifier-like strings, each from the start of a run without white space: telephone and card forms of whole runs,
#: else a run that holds a digit or at sign, also one written out in brackets.
INSTANCE = (r"""(?<!\S)(?:[(\[{<"']*+(?:""" + PATTERNS["phone"] + END + "|" + NUMBER + r"(?:\x20" + NUMBER + ")*+)"
            r"|[^\s0-9@]*+[0-9@]\S*+|[^\s(\[{]++[(\[{][Aa][Tt][)\]}]\S++)")
#: Marks around an identifier that are no part of it; a run of marks is entered at its first only.
LEAD = r"""^[(\[{<"']++"""
TRAIL = r"""(?<![.,;:!?)\]}>"'])[.,;:!?)\]}>"']++\z"""
#: Code points next to an instance that are searched for its context words; a text is cut into pieces of as many.
CONTEXT = 100

#: Rounds of scoring; least distinct seeds of a pattern, least confidences at the end.
ROUNDS = 3
MIN_SEEDS = 3
MIN_PATTERN = 0.8
MIN_INSTANCE = 0.8
#: What a string must hold to be named as a kind.
SHAPES = {"email": r"@|[(\[{][Aa][Tt][)\]}]", "ip": r"[0-9]\D+[0-9]+\D+[0-9]+\D+[0-9]", "card": r"(?:[0-9]\D*){12}", "phone": r"(?:[0-9]\D*){7}"}
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string,value:string>>"


#: Matches whose places are summed up in one go; the sums of such blocks are summed up in turn.
BLOCK = 256


def _located(text: Column, pattern: str, make, kind: str) -> Column:
    """Array of ``make(start, stop, value)`` for all matches, in order.

    A fold that appends copies its array at every step. So matches are folded in
    blocks, and then the blocks: the copying stays linear in the matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, v: F.struct(
        F.length(g).alias("gap"), F.length(v).alias("length"), v.alias("value")))
    place = "array<struct<start:int,stop:int,value:string>>"

    def within(pairs: Column) -> Column:
        """A block's matches, placed from its own beginning, and its length."""
        def step(acc, pair):
            start = acc["at"] + pair["gap"]
            return F.struct((start + pair["length"]).alias("at"), F.concat(acc["out"], F.array(F.struct(
                start.alias("start"), (start + pair["length"]).alias("stop"), pair["value"].alias("value")))).alias("out"))

        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(place).alias("out")), step)

    def blocks(pairs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int")),
                           lambda b: within(F.slice(pairs, b * BLOCK + 1, F.lit(BLOCK))))

    def together(blocks: Column) -> Column:
        """The blocks one behind the other."""
        def step(acc, size):
            return F.struct((acc["at"] + size).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

        begins = F.aggregate(F.transform(blocks, lambda b: b["at"]), F.struct(
            F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step, lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, begins, lambda b, begin: F.transform(
            b["out"], lambda m: make(begin + m["start"], begin + m["stop"], m["value"]))))

    def bound(value: Column, use) -> Column:
        """``use(value)`` with the value computed once: a lambda's variable is not computed again."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    return bound(pairs, lambda p: F.when(F.size(p) > 0, bound(blocks(p), together)).otherwise(F.array().cast(kind)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    """The check that a match of a base pattern has to pass."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Checked matches of all base patterns by (start, kind as listed)."""
    def spans(rank: int, kind: str) -> Column:
        def make(start, stop, value):
            return F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), F.lit(kind).alias("kind"),
                            value.alias("value"))
        found = F.filter(_located(text, PATTERNS[kind], make, SPAN), lambda s: _holds(kind, s["value"]))
        return F.when(F.rlike(text, F.lit(NEEDS[kind])), found).otherwise(F.array().cast(SPAN))

    return F.array_sort(F.concat(*(spans(rank, kind) for rank, kind in enumerate(KINDS))))


def instances(text: Column, base: Column) -> Column:
    """Base spans as seeds and identifier-like strings, with the two words before and the word behind."""
    kind = "array<struct<start:int,stop:int,value:string,seed:string>>"

    def make(start, stop, value):
        first = start + F.length(F.regexp_extract(value, LEAD, 0))
        core = F.regexp_replace(value, f"{LEAD}|{TRAIL}", "")
        return F.struct(first.alias("start"), (first + F.length(core)).alias("stop"), core.alias("value"), F.lit(None).cast("string").alias("seed"))

    def words(part: Column) -> Column:
        return F.regexp_extract_all(F.lower(part), F.lit(r"\S+"), F.lit(0))

    def piece(pieces: Column, k: Column) -> Column:
        return F.coalesce(F.get(pieces, k), F.lit(""))

    def in_context(row: Column) -> Column:
        def one(i: Column) -> Column:
            first, last = (F.floor(i[at] / CONTEXT).cast("int") for at in ("start", "stop"))
            before = words(F.right(F.concat(piece(row["pieces"], first - 1), F.left(
                piece(row["pieces"], first), i["start"] - first * CONTEXT)), F.lit(CONTEXT)))
            after = words(F.left(F.concat(F.substring(piece(row["pieces"], last), i["stop"] - last * CONTEXT + 1, F.lit(CONTEXT)),
                                          piece(row["pieces"], last + 1)), F.lit(CONTEXT)))
            return F.struct(i["start"].alias("start"), i["stop"].alias("stop"), i["value"].alias("value"), i["seed"].alias("seed"),
                            F.coalesce(F.try_element_at(before, F.lit(-2)), F.lit("")).alias("left2"),
                            F.coalesce(F.try_element_at(before, F.lit(-1)), F.lit("")).alias("left1"),
                            F.coalesce(F.try_element_at(after, F.lit(1)), F.lit("")).alias("right1"))

        seeds = F.transform(row["base"], lambda b: F.struct(b["start"].alias("start"), b["stop"].alias("stop"),
                                                            b["value"].alias("value"), b["kind"].alias("seed")))
        return F.transform(F.concat(seeds, row["others"]), one)

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CONTEXT}}}"), F.lit(0))
    # the one-element array binds its parts once, so that no lambda computes them again
    row = F.array(F.struct(base.alias("base"), _located(text, INSTANCE, make, kind).alias("others"), pieces.alias("pieces")))
    found = F.get(F.transform(row, in_context), F.lit(0))
    empty = "array<struct<start:int,stop:int,value:string,seed:string,left2:string,left1:string,right1:string>>"
    return F.when(F.rlike(text, F.lit(r"[0-9@]|[(\[{][Aa][Tt][)\]}]")), found).otherwise(F.array().cast(empty))


def apart_from_seeds(seen: DataFrame) -> DataFrame:
    """The instances without those that overlap a seed of their text.

    In the order of seeds by start and other instances by end, the furthest end
    of the seeds so far tells: a sort and a running maximum per text.
    """
    seed = F.col("seed").isNotNull()
    place = F.when(seed, F.col("start")).otherwise(F.col("stop"))
    # where a seed starts as an instance ends they do not overlap: the instance comes first
    order = Window.partitionBy("doc_id", "text_key").orderBy(place, seed).rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(seed, F.col("stop"))).over(order)
    return (seen.withColumn("_reach", reach).where(seed | F.col("_reach").isNull() | (F.col("_reach") <= F.col("start")))
            .drop("_reach"))


def trusted_values(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind) of strings that are no seeds, named by trusted patterns.

    ``edges`` has distinct (pattern, value, seed): the pattern-instance graph,
    ``seed`` the kind a base pattern gave the value, or null. A pattern's
    confidence for a kind is the mean trust of all its values, seeds 1 and
    unknown ones what the round before gave them; at least MIN_SEEDS of them are
    seeds. A value's trust is 1 minus the product of its patterns' doubts.
    """
    uses = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    seeds = edges.where("seed is not null").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("trust"),
                                                   F.lit(1).alias("is_seed")).distinct()
    trust = seeds
    scored = None
    for number in range(rounds):
        scored = staged(edges.join(trust, "value").groupBy("pattern", "kind")
                        .agg(F.sum("trust").alias("t"), F.sum("is_seed").alias("seeds"))
                        .where(F.col("seeds") >= MIN_SEEDS).join(uses, "pattern")
                        .select("pattern", "kind", (F.col("t") / F.col("n")).alias("confidence")), f"pii-patterns-{number}")
        named = (edges.where("seed is null").join(scored, "pattern").groupBy("value", "kind")
                 .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))).alias("trust"),
                      F.max("confidence").alias("best")))
        named = staged(named, f"pii-instances-{number}")
        trust = seeds.unionByName(named.select("value", "kind", "trust", F.lit(0).alias("is_seed")))
    shaped = F.lit(False)
    for kind, shape in SHAPES.items():
        shaped = shaped | ((F.col("kind") == kind) & F.rlike("value", F.lit(shape)))
    return named.where((F.col("best") >= MIN_PATTERN) & (F.col("trust") >= MIN_INSTANCE) & shaped).select("value", "kind")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more.

    Counts and base_sha256 are of the base spans; ``spans`` adds those that
    trusted patterns name, n_more counts them. Offsets are code points. A null
    text counts as empty; repeated rows get equal results; the evidence for a
    pattern counts different strings, not their copies. Empty tables give no
    rows; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"), base_spans(text).alias("base"))
    rows = staged(rows.select("doc_id", "text_key", "base", instances(F.col("text"), F.col("base")).alias("instances")), "pii-rows")
    seen = rows.select("doc_id", "text_key", F.explode("instances").alias("i")).select("doc_id", "text_key", "i.*")
    seen = staged(apart_from_seeds(seen), "pii-instances")
    patterns = F.array(
        F.when((F.col("left2") != "") & (F.col("left1") != ""), F.concat_ws(" ", F.lit("L"), "left2", "left1")),
        F.when((F.col("left1") != "") & (F.col("right1") != ""), F.concat_ws(" ", F.lit("R"), "left1", "right1")))
    edges = staged(seen.select(F.explode(F.array_compact(patterns)).alias("pattern"), "value", "seed")
                   .groupBy("pattern", "value").agg(F.min("seed").alias("seed")), "pii-edges")
    more = (seen.where("seed is null").join(trusted_values(edges), "value")
            .select("doc_id", "text_key", F.struct(
                "start", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int").alias("rank"), "stop",
                "kind").alias("s"))
            .groupBy("doc_id", "text_key").agg(F.collect_set("s").alias("more"))
            .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "more"))
    joined = rows.join(more, rows["doc_id"].eqNullSafe(more["__id"]) & (rows["text_key"] == more["__key"]), "left")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), (s["rank"] + 1).alias("rank"),
                                                  s["stop"].alias("stop"), s["kind"].alias("kind")))
    extra = F.coalesce("more", F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return joined.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                         listed(F.concat(base, extra)).alias("spans"), F.size(extra).cast("long").alias("n_more"))
