"""Pipeline verification: counts, reconciliation, freshness, nulls, schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popflow.functions.expressions import age_seconds, ts_as
from popflow.operators import views
from popflow.operators.leaderboard import require_rows  # noqa: F401  (re-export)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each named DataFrame (one global count
    aggregate per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def view_counts(events: DataFrame, width: str, source: str = "game_events") -> DataFrame:
    """``table_name, row_count`` of the events and of all their views, in one scan.

    The views come fanned out of one aggregate, so the events are read and
    grouped once; every event is in exactly one row of the first view.
    """
    fanned = views.fan_out(events, width)
    per_view = fanned.groupBy("view").agg(F.count(F.lit(1)).alias("n"), F.sum("pops").alias("pops"))
    first = next(iter(views.FAN_USES))
    counted = F.array(F.struct(F.col("view").alias("table_name"), F.col("n").alias("row_count")),
                      F.struct(F.when(F.col("view") == first, F.lit(source)).alias("table_name"), F.col("pops").alias("row_count")))
    found = per_view.select(F.inline(counted)).where("table_name is not null")
    # without events there is no row to count, but the tables are there
    none = events.sparkSession.createDataFrame([(n, 0) for n in (source, *views.FAN_USES)], "table_name string, row_count long")
    return found.unionByName(none).groupBy("table_name").agg(F.sum("row_count").alias("row_count"))


def reconcile(view: DataFrame, table: DataFrame, keys: Sequence[str],
              compare: Sequence[str] = ()) -> DataFrame:
    """Row counts on both sides, keys missing from / extra in the table, and
    keys present on both sides whose ``compare`` columns differ.

    One full outer join on the key (both sides shuffle on it) and one global
    aggregate; NULL-safe comparison.
    """
    keys, compare = list(keys), list(compare)
    v = view.select(*keys, *[F.col(c).alias(f"_v_{c}") for c in compare],
                    F.lit(True).alias("_in_v"))
    t = table.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in compare],
                     F.lit(True).alias("_in_t"))
    j = v.join(t, keys, "full_outer")
    both = F.col("_in_v").isNotNull() & F.col("_in_t").isNotNull()
    differs = reduce(lambda a, b: a | b,
                     [~F.col(f"_v_{c}").eqNullSafe(F.col(f"_t_{c}")) for c in compare],
                     F.lit(False))
    return j.agg(
        F.count_if(F.col("_in_v").isNotNull()).alias("view_rows"),
        F.count_if(F.col("_in_t").isNotNull()).alias("table_rows"),
        F.count_if(F.col("_in_t").isNull()).alias("missing_keys"),
        F.count_if(F.col("_in_v").isNull()).alias("extra_keys"),
        F.count_if(both & differs).alias("mismatched_rows"))


#: Buckets of a digest, and the finer ones inside a bucket that differs.
BUCKETS = 1_024


def digest(df: DataFrame, keys: Sequence[str], compare: Sequence[str], bucket: Column) -> DataFrame:
    """Per bucket of keys: rows, and sums that do not depend on their order.

    Two independent 64-bit hashes of a row: the halves of one are added up, the
    other is combined by exclusive or. A NULL is hashed as such, so columns that
    trade a NULL for a value differ.
    """
    parts = [x for c in (*keys, *compare) for x in (F.col(c).isNull(), F.col(c))]
    one, two = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    low = F.lit(0xFFFFFFFF)
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(one.bitwiseAND(low)).alias("low"),
        F.sum(F.shiftrightunsigned(one, 32)).alias("high"), F.bit_xor(two).alias("mix"))


def _differing(view: DataFrame, table: DataFrame, keys, compare, bucket: Column) -> tuple[list[int], int, int]:
    """Buckets whose digests differ (at most as many as there are buckets), and both sides' rows."""
    sides = digest(view, keys, compare, bucket).withColumn("side", F.lit(1)).unionByName(
        digest(table, keys, compare, bucket).withColumn("side", F.lit(0)))
    ours = F.col("side") == 1
    same = F.lit(True)
    for c in ("rows", "low", "high", "mix"):
        same = same & (F.max(F.when(ours, F.col(c))).eqNullSafe(F.max(F.when(~ours, F.col(c)))))
    found = sides.groupBy("bucket").agg(
        same.alias("same"), F.sum(F.when(ours, F.col("rows"))).alias("v"), F.sum(F.when(~ours, F.col("rows"))).alias("t"))
    total = found.agg(F.collect_list(F.when(~F.col("same"), F.col("bucket"))), F.coalesce(F.sum("v"), F.lit(0)),
                      F.coalesce(F.sum("t"), F.lit(0))).first()
    return sorted(total[0]), total[1], total[2]


def reconcile_by_digest(view: DataFrame, table: DataFrame, keys: Sequence[str], compare: Sequence[str] = (),
                        buckets: int = BUCKETS) -> DataFrame:
    """As :func:`reconcile`, without a join of what is equal. Keys must be unique on each side.

    Both sides are reduced to one digest row per bucket of key hashes; equal
    tables end there, with nothing but those rows shuffled. Only keys in buckets
    that differ are digested again in finer buckets, and only what still differs
    is joined. Each step filters by values of the key alone, so it holds however
    often a side is computed.
    """
    keys, compare = list(keys), list(compare)
    parts = [x for c in keys for x in (F.col(c).isNull(), F.col(c))]
    coarse = F.pmod(F.xxhash64(F.lit(3), *parts), F.lit(buckets))
    fine = F.pmod(F.xxhash64(F.lit(4), *parts), F.lit(buckets))
    differ, n_view, n_table = _differing(view, table, keys, compare, coarse)
    if not differ:
        return view.sparkSession.range(1).select(
            F.lit(n_view).cast("long").alias("view_rows"), F.lit(n_table).cast("long").alias("table_rows"),
            *[F.lit(0).cast("long").alias(c) for c in ("missing_keys", "extra_keys", "mismatched_rows")])
    view, table = (df.where(coarse.isin(differ)) for df in (view, table))
    finer, _, _ = _differing(view, table, keys, compare, fine)
    view, table = (df.where(fine.isin(finer)) for df in (view, table))
    return reconcile(view, table, keys, compare).withColumns(
        {"view_rows": F.lit(n_view).cast("long"), "table_rows": F.lit(n_table).cast("long")})


def freshness(tables: Mapping[str, tuple[DataFrame, str]], now=None) -> DataFrame:
    """``table_name, latest_ts, age_seconds`` per table; ``tables`` maps a
    name to (DataFrame, timestamp column). ``now`` defaults to the current
    time."""
    parts = []
    for name, (df, col) in tables.items():
        ts_type = dict(df.dtypes)[col]
        now_col = ts_as(now, ts_type)
        parts.append(df.agg(F.max(col).alias("latest_ts"))
                     .select(F.lit(name).alias("table_name"), "latest_ts",
                             age_seconds("latest_ts", now_col).alias("age_seconds")))
    return reduce(DataFrame.unionByName, parts)


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``column_name, null_count`` for each column, in one scan."""
    cols = list(cols or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "null_count")


# -- measured by the sink ------------------------------------------------------
# The same three checks from what the changelog sink recorded of each batch
# (``TableStore.commits``): one small row per batch instead of the tables' data.

def measured_counts(commits: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of changelog tables."""
    parts = [log.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, log in commits.items()]
    return reduce(DataFrame.unionByName, parts)


def measured_freshness(commits: Mapping[str, DataFrame], now=None) -> DataFrame:
    """``table_name, latest_ts, age_seconds`` of changelog tables."""
    return freshness({name: (log, "max_ts") for name, log in commits.items()}, now)


def measured_nulls(commits: Mapping[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    """``table_name, column_name, null_count`` of the required columns of
    changelog tables (zero where the sink sets incomplete rows aside)."""
    parts = []
    for name, (log, schema) in commits.items():
        for field in schema:
            if not field.nullable:
                parts.append(log.agg(F.coalesce(F.sum(F.col("nulls")[field.name]), F.lit(0).cast("long")).alias("null_count"))
                             .select(F.lit(name).alias("table_name"), F.lit(field.name).alias("column_name"), "null_count"))
    return reduce(DataFrame.unionByName, parts)


def schema_diff(df: DataFrame, expected: T.StructType | DataFrame) -> list[dict]:
    """Columns whose presence or type differs between ``df`` and ``expected``
    (by name). Empty list = schemas match. Driver-side metadata only."""
    exp = expected.schema if isinstance(expected, DataFrame) else expected
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in exp}
    out = []
    for name in sorted(set(have) | set(want)):
        a, b = have.get(name), want.get(name)
        if a is None:
            out.append({"column": name, "issue": "missing", "expected": b.simpleString()})
        elif b is None:
            out.append({"column": name, "issue": "unexpected", "actual": a.simpleString()})
        elif a != b:
            out.append({"column": name, "issue": "type", "actual": a.simpleString(),
                        "expected": b.simpleString()})
    return out


def required_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Null counts of the columns the table schema declares NOT NULL (file
    tables do not enforce it on write)."""
    req = [f.name for f in schema if not f.nullable and f.name in df.columns]
    return null_report(df, req)


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    """Up to ``n`` arbitrary rows (a preview, not a statistic)."""
    return df.limit(n)
