"""Ordering primitives: latest-per-key, top-k and a distributed global rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    With one order column (a changelog's ``batch_id``, unique per key) every
    value column is its own ``max_by``: the buffers of fixed-width columns are
    mutable in place, so it plans as a hash aggregate with a map-side partial
    step, no sort. A composite order needs a struct buffer, which Spark
    aggregates by sorting each side of the shuffle; a key with millions of
    updates is still reduced to one row per task before the shuffle.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    if len(order) == 1:
        last = F.col(order[0])
        picked = [F.max(c).alias(c) if c == order[0] else F.max_by(c, last).alias(c) for c in rest]
        return df.groupBy(*keys).agg(*picked).select(*keys, *rest)
    picked = F.max_by(F.struct(*[F.col(c) for c in rest]),
                      F.struct(*[F.col(c) for c in order])).alias("_latest")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_latest.{c}").alias(c)
                                                         for c in rest])


def top_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    """First ``k`` rows by ``order`` (plans as TakeOrderedAndProject:
    each task keeps its own top k, the driver merges k x tasks rows)."""
    return df.orderBy(*_cols(order)).limit(k)


# Rows looked at per bucket when the bucket bounds of a rank are chosen.
BOUND_ROWS = 32


def _rank_key(order: Sequence) -> Column:
    """One ascending struct for an order of (column, "asc" | "desc") pairs;
    "desc" needs a numeric column and puts NULLs last."""
    parts = []
    for name, way in order:
        c = F.col(name)
        parts += [c.isNull(), -c] if way == "desc" else [c]
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def _bounds(keys: DataFrame, n: int) -> Column:
    """At most n - 1 ascending bounds that deal ``keys`` (column k) into n even buckets.

    One array literal: the quantiles of the keys whose hash is below a threshold,
    which the count sets so that about n * BOUND_ROWS pass, whichever task they
    are in. The bounds reach the plan as text; were one rounded on the way, it
    would still be one value for all rows.
    """
    wanted, total = n * BOUND_ROWS, keys.count()
    low, high = -(1 << 63), (1 << 63) - 1
    if total > wanted:
        high = low + (1 << 64) * wanted // total
    some = keys.where(F.xxhash64(F.to_json("k")) <= F.lit(min(high, (1 << 63) - 1)))
    ordered = some.agg(F.sort_array(F.collect_list("k")).alias("all"))
    place = F.transform(F.sequence(F.lit(1), F.lit(max(1, n - 1))),
                        lambda i: F.get("all", (F.size("all") * i / F.lit(n)).cast("int")))
    cuts = F.when((F.size("all") >= n) & F.lit(n > 1), F.array_distinct(place))
    kind = T.ArrayType(keys.schema["k"].dataType)
    text = ordered.select(F.to_json(cuts)).first()[0]
    return F.from_json(F.lit(text or "[]"), kind)


def _bucket(key: Column, bounds: Column, n: int) -> Column:
    """Number of bounds below or at ``key``: a binary search in the array."""
    steps = [F.lit(1 << i) for i in reversed(range(n.bit_length()))]
    return F.aggregate(F.array(*steps), F.lit(0), lambda low, step: F.when(
        F.get(bounds, low + step - 1) <= key, low + step).otherwise(low))


def global_rank(df: DataFrame, order: Sequence, name: str = "position",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in the total order given by ``order``,
    pairs of (column, "asc" | "desc"), computed distributed.

    A window without ``partitionBy`` would move every row to one task. Here
    bucket bounds are quantiles of a bounded sample of the keys (it decides the
    balance only); a row's bucket follows from its own values, so counting the
    buckets and numbering the rows within them agree however often and wherever
    either is computed. The counts (one row per bucket) give each bucket its
    offset. With an order that ends in a unique column, the bounds split even a
    score shared by a third of all rows.
    """
    n = max(1, num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = _rank_key(order)
    placed = df.withColumn("_bucket", _bucket(key, _bounds(df.select(key.alias("k")), n), n))
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_bucket",
        (F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_n")).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (placed.withColumn("_local", local).join(F.broadcast(offsets), "_bucket")
            .select((F.col("_off") + F.col("_local")).alias(name), *df.columns))
