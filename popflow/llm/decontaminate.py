"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are sets of word shingles at known places. Shingles are
ordered by rarity in the corpus; a document can hold a window only where it
holds the window's rarest shingle, so only that prefix token is joined. Length
and position bound the candidates, and the words of the window are compared
with the document's words at the implied place. DataFrame operations only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import small, staged

#: Everything that is not part of a word: ASCII apart from letters and digits.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Upper-case letters are folded first, so they are no breaks.
BREAK_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHINGLE = 3


def _words(text: Column) -> Column:
    """Words with A-Z lowered."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, BREAK), lambda w: w != "")


def _plain_words(text: Column) -> Column:
    return F.filter(F.split(text, BREAK_ANY_CASE), lambda w: w != "")


def _loose_words(text: Column) -> Column:
    """Words lowered in every script, one by one: equal wherever ``_words`` are, and cheaper."""
    return F.transform(_plain_words(text), lambda w: F.lower(w))


def _shingles(words: Column, size: Column | int) -> Column:
    """Hashes of all runs of ``size`` words, in order."""
    last = F.size(words) - size + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                        lambda i: F.xxhash64(F.slice(words, i, size)))).otherwise(
        F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, n, win, tokens): every distinct window of an item, tokens by place.

    ``win`` holds the exact words, ``tokens`` the shingle hashes of the loosely
    lowered words, ``size`` the words of a shingle (all of a shorter item).
    """
    items = benchmark.select("item_id", _words(F.coalesce("text", F.lit(""))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    wins = (items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("win"))
            .distinct().withColumn("n", F.size("win"))
            .withColumn("size", F.least(F.lit(SHINGLE), F.col("n"))))
    loose = F.transform("win", lambda w: F.lower(w))
    return wins.withColumn("tokens", _shingles(loose, F.col("size")))


CANDIDATES = "array<struct<start:int,wid:bigint,win:array<string>>>"


def _with_candidates(rows: DataFrame, wins: DataFrame) -> DataFrame:
    """Adds ``candidates``: places where a row's text may hold a window, with its words."""
    # At most SHINGLE different sizes.
    sizes = sorted(r["size"] for r in wins.select("size").distinct().collect())
    if not sizes:
        return rows.withColumn("__candidates", F.lit(None).cast(CANDIDATES))
    known = staged(wins.select("size", F.explode("tokens").alias("token")).distinct(), "tokens")
    n_known = known.count()
    # Every place of a benchmark shingle in the corpus.
    text = F.coalesce("text", F.lit(""))
    loose = rows.select("doc_id", F.xxhash64(text).alias("text_key"), _loose_words(text).alias("w"))
    found = None
    for size in sizes:
        places = loose.select("doc_id", "text_key", F.posexplode(_shingles(F.col("w"), size)).alias("place", "token"))
        part = places.join(small(known.where(F.col("size") == size).select("token"), n_known), "token").withColumn(
            "size", F.lit(size))
        found = part if found is None else found.unionByName(part)
    found = staged(found, "places")

    # The prefix of a window: its rarest shingle, with its offset.
    rarity = found.groupBy("size", "token").agg(F.count("*").alias("uses"))
    distinct = wins.select("win", "n", "size", "tokens").distinct().withColumn("wid", F.xxhash64("win"))
    prefix = (distinct.select("wid", "win", "n", "size", F.posexplode("tokens").alias("offset", "token"))
              .join(rarity, ["size", "token"], "left")
              .groupBy("wid", "win", "n", "size")
              .agg(F.min_by(F.struct("token", "offset"),
                            F.struct(F.coalesce("uses", F.lit(0)), "offset")).alias("p"))
              .select("size", F.col("p.token").alias("token"), F.col("p.offset").alias("offset"), "wid", "win"))
    prefix = staged(prefix, "prefixes")
    candidates = (found.join(small(prefix, prefix.count()), ["size", "token"])
                  .withColumn("start", F.col("place") - F.col("offset")).where("start >= 0")
                  .groupBy("doc_id", "text_key")
                  .agg(F.collect_set(F.struct("start", "wid", "win")).alias("__candidates"))
                  .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__candidates"))
    keyed = rows.withColumn("__text_key", F.xxhash64(text))
    return keyed.join(candidates, keyed["doc_id"].eqNullSafe(candidates["__id"])
                      & (keyed["__text_key"] == candidates["__key"]), "left").drop("__id", "__key", "__text_key")


def _verified(words: str) -> Column:
    """The candidates whose words stand in the array column ``words`` at their place."""
    return F.filter("__candidates", lambda c: F.slice(words, c["start"] + 1, F.size(c["win"])) == c["win"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and no hits; items without words are
    none. Repeated rows (also under one id, with other texts) are judged each by
    its own text, repeated items count once per item_id, and a null item_id
    counts in no list. Empty tables give no rows, an empty benchmark no hits.
    Other columns are ignored.
    """
    wins = staged(item_windows(benchmark, window), "windows")
    rows = _with_candidates(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), wins)
    exact = F.when(F.col("__candidates").isNotNull(), _words(F.col("text")))
    judged = rows.select("doc_id", F.size(_plain_words(F.col("text"))).alias("n_words"), "__candidates",
                         exact.alias("w")).select(
        "doc_id", "n_words",
        F.array_sort(F.transform(_verified("w"), lambda c: F.struct(
            c["start"].alias("start"), (c["start"] + F.size(c["win"])).alias("stop"), c["wid"].alias("wid")))).alias("hits"))
    # Words covered by the sorted intervals.
    merged = F.aggregate(
        "hits", F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda a, h: F.struct(F.greatest(a["upto"], h["stop"]).alias("upto"),
                              (a["n"] + F.greatest(F.lit(0), h["stop"] - F.greatest(a["upto"], h["start"]))).alias("n")))
    judged = judged.select("doc_id", "n_words", F.coalesce(merged["n"], F.lit(0).cast("long")).alias("n_hit"),
                           F.array_distinct(F.transform("hits", lambda h: h["wid"])).alias("wids"))
    judged = staged(judged.withColumn("row", F.expr("uuid()")), "judged")
    owners = wins.where("item_id is not null").select(F.xxhash64("win").alias("wid"), "item_id").distinct()
    items = (judged.where("n_hit > 0").select("row", F.explode("wids").alias("wid")).join(owners, "wid")
             .select("row", "item_id").distinct()
             .groupBy("row").agg(F.count("*").alias("n_items"),
                                 F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("ids")))
    return judged.join(items, "row", "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_hit",
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents that hold no window of the benchmark, with all their columns."""
    wins = staged(item_windows(benchmark, window), "windows")
    rows = _with_candidates(docs, wins)
    exact = F.when(F.col("__candidates").isNotNull(), _words(F.coalesce("text", F.lit(""))))
    hits = F.coalesce(F.size(_verified("__w")), F.lit(0))
    return (rows.withColumn("__w", exact).where(F.col("__candidates").isNull() | (hits <= 0))
            .select(*docs.columns))
