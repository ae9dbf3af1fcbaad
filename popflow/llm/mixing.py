"""Mixing sources to target weights by hierarchical budgeting.

A token budget runs down a domain / language / source tree. At every node the
children share it by weight; what a child cannot use goes to its siblings first
and reaches an ancestor's other branches only where all siblings are full. Each
leaf takes whole epochs and then the token prefix of one more, in an order
seeded per epoch. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popflow.llm.common import small, staged

WORD = r"[^\x20\x09-\x0D]+"
LEAF = ["domain", "lang", "source"]
#: Hex digits of the order key that name a bucket, two more at each step: a leaf
#: is summed by bucket, then the bucket where its prefix ends by finer buckets,
#: and only the last of these is ordered row by row.
BUCKET_DIGITS = (2, 4, 6)


def domain_of(source: Column) -> Column:
    """Production domains: four groups of sources by the number in their name."""
    return F.concat(F.lit("d"), F.coalesce(F.regexp_extract(source, "([0-9]{1,9})", 1).try_cast("long") % 4,
                                           F.lit(0)).cast("string"))


def _leaves(docs: DataFrame, domain: Column) -> DataFrame:
    """The documents with the leaf they belong to; null names count as empty ones."""
    return docs.withColumns({"__domain": F.coalesce(domain, F.lit("")), "__lang": F.coalesce("lang", F.lit("")),
                             "__source": F.coalesce("source", F.lit(""))})


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("/", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _weight(weights: dict[str, int], name: Column) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    pairs = [F.lit(x) for k, v in sorted(weights.items()) for x in (k, int(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), name), F.lit(1)).cast("long")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``got`` to nodes with ``budget`` (of the parent), ``w`` and ``cap``.

    Children that their share by weight would overfill get their capacity; the
    rest share what is left by weight, in whole tokens.
    """
    fill = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = fill.orderBy((F.col("cap").cast("double") / F.col("w")).asc(), F.col(name).asc())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = F.col("cap").cast("double") * rest <= (F.col("budget") - before).cast("double") * F.col("w")
    nodes = nodes.where("w > 0").withColumn("full", full)
    used = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(fill), F.lit(0))
    open_ = F.sum(F.when(~F.col("full"), F.col("w"))).over(fill)
    part = F.floor((F.col("budget") - used).cast("double") * F.col("w") / open_)
    return nodes.withColumn("got", F.when(F.col("full"), F.col("cap")).otherwise(part).cast("long")).drop("full")


def leaf_budgets(sizes: DataFrame, budget_share: float, epochs: int, domain_weights: dict[str, int],
                 lang_weights: dict[str, int], source_weights: dict[str, int]) -> DataFrame:
    """(domain, lang, source, tokens, budget) from the leaves' token counts."""
    usable = ((_weight(domain_weights, F.col("domain")) > 0) & (_weight(lang_weights, F.col("lang")) > 0)
              & (_weight(source_weights, F.col("source")) > 0))
    leaves = sizes.withColumn("cap", F.when(usable, F.col("tokens") * epochs).otherwise(0))
    everything = Window.partitionBy(F.lit(0))  # over one row per domain
    domains = (leaves.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
               .withColumn("w", _weight(domain_weights, F.col("domain")))
               .withColumn("budget", F.floor(F.sum("tokens").over(everything).cast("double") * budget_share).cast("long")))
    domains = share_out(domains, [], "domain").select("domain", F.col("got").alias("budget"))
    langs = (leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
             .withColumn("w", _weight(lang_weights, F.col("lang"))).join(domains, "domain"))
    langs = share_out(langs, ["domain"], "lang").select("domain", "lang", F.col("got").alias("budget"))
    sources = (leaves.withColumn("w", _weight(source_weights, F.col("source"))).join(langs, ["domain", "lang"]))
    return share_out(sources, ["domain", "lang"], "source").select(*LEAF, "tokens", F.col("got").alias("budget"))


def leaf_cuts(rows: DataFrame, budgets: DataFrame, epochs: int, seed: int) -> DataFrame:
    """(domain, lang, source, full, cut): whole epochs, and the last key of the next one that is taken."""
    plan = budgets.select(*LEAF, F.expr(f"CASE WHEN tokens > 0 THEN least(budget div tokens, {int(epochs)}) ELSE 0L END").alias("full"),
                          "tokens", "budget")
    plan = staged(plan.withColumn("rest", F.when(F.col("full") < epochs, F.col("budget") - F.col("full") * F.col("tokens"))
                                  .otherwise(0)).select(*LEAF, "full", "rest"), "leaf-plan")
    n = plan.count()
    keyed = (rows.join(small(plan.where("rest > 0"), n), LEAF)
             .select(*LEAF, "rest", "n_tokens", _key(seed, F.col("full"), F.col("doc_id")).alias("key")))
    # Step by step into the bucket where the prefix ends: at most 256 rows a leaf each time.
    edge = plan.where("rest > 0").select(*LEAF, F.lit("").alias("bucket"), F.lit(0).cast("long").alias("before"))
    run = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    for digits in BUCKET_DIGITS:
        inside = keyed.withColumn("bucket", F.substring("key", 1, digits - 2)).join(small(edge, n), [*LEAF, "bucket"])
        buckets = (inside.withColumn("bucket", F.substring("key", 1, digits))
                   .groupBy(*LEAF, "rest", "before", "bucket").agg(F.sum("n_tokens").alias("t"))
                   .withColumn("upto", F.col("before") + F.sum("t").over(run)))
        edge = staged(buckets.where("upto > rest").groupBy(*LEAF)
                      .agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before")), "bucket").alias("e"))
                      .select(*LEAF, F.col("e.bucket").alias("bucket"), F.col("e.before").alias("before")), "leaf-edges")
    within = Window.partitionBy(*LEAF).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (keyed.withColumn("bucket", F.substring("key", 1, digits)).join(small(edge, n), [*LEAF, "bucket"])
            .withColumn("upto", F.col("before") + F.sum("n_tokens").over(within))
            .where("upto <= rest").groupBy(*LEAF).agg(F.max("key").alias("key")))
    return (plan.join(edge, LEAF, "left").join(last, LEAF, "left")
            .select(*LEAF, "full", F.coalesce("key", "bucket").alias("cut")))


def _cuts(rows: DataFrame, budget_share: float, epochs: int, seed: int, domain_weights, lang_weights,
          source_weights) -> tuple[DataFrame, int]:
    sizes = staged(rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")), "leaf-sizes")
    budgets = leaf_budgets(sizes, budget_share, epochs, domain_weights or {}, lang_weights or {}, source_weights or {})
    cuts = staged(leaf_cuts(rows, budgets, epochs, seed), "leaf-cuts")
    return cuts, cuts.count()


def _taken(seed: int, doc_id: Column, full: Column, cut: Column) -> Column:
    """Epochs a row is part of: the whole ones, and one more up to the cut."""
    return full + F.when(_key(seed, full, doc_id) <= cut, 1).otherwise(0)


def mix(docs: DataFrame, *, budget_share: float = 0.5, epochs: int = 3, seed: int = 11, domain: Column | None = None,
        domain_weights: dict[str, int] | None = None, lang_weights: dict[str, int] | None = None,
        source_weights: dict[str, int] | None = None) -> DataFrame:
    """One row per document taken: doc_id, domain, lang, source, n_tokens, n_epochs.

    The budget is a share of the corpus's tokens; no row is taken in more than
    ``epochs`` epochs. Names without a weight weigh 1, a weight of 0 takes
    nothing. Null texts have no tokens, null names count as empty names, a null
    id as an empty one. Rows with one id are ordered together and taken only
    together; a prefix never passes its leaf's budget. Leaves without tokens and
    empty tables give no rows; other columns are ignored.
    """
    named = _leaves(docs, domain_of(F.col("source")) if domain is None else domain)
    rows = staged(named.select("doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"),
                               F.col("__source").alias("source"), tokens(F.col("text")).alias("n_tokens")), "token-counts")
    cuts, n = _cuts(rows, budget_share, epochs, seed, domain_weights, lang_weights, source_weights)
    taken = _taken(seed, F.col("doc_id"), F.col("full"), F.col("cut")).cast("long")
    return (rows.join(small(cuts, n), LEAF).withColumn("n_epochs", taken)
            .where("n_epochs > 0").select("doc_id", *LEAF, "n_tokens", "n_epochs"))


def mix_documents(docs: DataFrame, *, budget_share: float = 0.5, epochs: int = 3, seed: int = 11,
                  domain_weights: dict[str, int] | None = None, lang_weights: dict[str, int] | None = None,
                  source_weights: dict[str, int] | None = None) -> DataFrame:
    """The documents taken, with all their columns and ``n_epochs`` (in place of one they may
    have); as ``mix`` otherwise."""
    named = _leaves(docs, domain_of(F.col("source")))
    rows = staged(named.select("doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"),
                               F.col("__source").alias("source"), tokens(F.col("text")).alias("n_tokens")), "token-counts")
    cuts, n = _cuts(rows, budget_share, epochs, seed, domain_weights, lang_weights, source_weights)
    cuts = cuts.select(*(F.col(c).alias(f"__{c}") for c in LEAF), F.col("full").alias("__full"),
                       F.col("cut").alias("__cut"))
    taken = _taken(seed, F.col("doc_id"), F.col("__full"), F.col("__cut")).cast("long")
    return (named.join(small(cuts, n), [f"__{c}" for c in LEAF]).withColumn("n_epochs", taken)
            .where("n_epochs > 0").select(*(c for c in docs.columns if c != "n_epochs"), "n_epochs"))


def oracle(budget_share: float, epochs: int, seed: int, domain_weights: dict[str, int], lang_weights: dict[str, int],
           documents: str = "documents") -> str:
    """DuckDB SQL of ``mix`` with unit source weights; orders leaves row by row instead of by bucket."""
    def weight(column: str, weights: dict[str, int]) -> str:
        return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(weights.items())) + " ELSE 1 END"

    def level(name: str, source: str, parent: str, column: str) -> str:
        by = f"PARTITION BY {parent}" if parent else ""
        return f"""
{name}_o AS (SELECT *, coalesce(sum(cap) OVER ({by} ORDER BY cap / w::DOUBLE, {column} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(w) OVER ({by} ORDER BY cap / w::DOUBLE, {column} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM ({source}) WHERE w > 0),
{name}_f AS (SELECT *, cap::DOUBLE * rest::DOUBLE <= (budget - before)::DOUBLE * w AS is_full FROM {name}_o),
{name}_u AS (SELECT *, coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({by}), 0) AS used,
  sum(CASE WHEN NOT is_full THEN w END) OVER ({by}) AS open_w FROM {name}_f),
{name} AS (SELECT *, CASE WHEN is_full THEN cap::BIGINT ELSE floor((budget - used)::DOUBLE * w / open_w::DOUBLE)::BIGINT END AS got FROM {name}_u)"""

    return f"""WITH d AS (
  SELECT doc_id, 'd' || coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})', 1) AS BIGINT) % 4, 0) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM {documents}),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (CASE WHEN {weight('domain', domain_weights)} > 0 AND {weight('lang', lang_weights)} > 0
  THEN sum(n_tokens) * {epochs} ELSE 0 END)::BIGINT AS cap FROM d GROUP BY domain, lang, source),
total AS (SELECT floor(coalesce(sum(tokens), 0)::DOUBLE * {budget_share})::BIGINT AS budget FROM leaf),""" + level(
        "dom", f"SELECT domain, sum(cap)::BIGINT AS cap, {weight('domain', domain_weights)} AS w, any_value(budget) AS budget "
               "FROM leaf, total GROUP BY domain", "", "domain") + "," + level(
        "lan", f"SELECT domain, lang, sum(leaf.cap)::BIGINT AS cap, {weight('lang', lang_weights)} AS w, any_value(dom.got) AS budget "
               "FROM leaf JOIN dom USING (domain) GROUP BY domain, lang", "domain", "lang") + "," + level(
        "src", "SELECT domain, lang, source, tokens, leaf.cap AS cap, 1 AS w, lan.got AS budget "
               "FROM leaf JOIN lan USING (domain, lang)", "domain, lang", "source") + f""",
plan AS (SELECT domain, lang, source, tokens, got, CASE WHEN tokens > 0 THEN least(got // tokens, {epochs}) ELSE 0 END AS whole FROM src),
keyed AS (SELECT d.*, whole, CASE WHEN whole < {epochs} THEN got - whole * tokens ELSE 0 END AS rest,
  md5('{seed}/' || whole || '/' || coalesce(d.doc_id::VARCHAR, '')) AS k FROM d JOIN plan USING (domain, lang, source)),
upto AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS u FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, (whole + CASE WHEN rest > 0 AND u <= rest THEN 1 ELSE 0 END)::BIGINT AS n_epochs
FROM upto WHERE whole > 0 OR (rest > 0 AND u <= rest)"""
