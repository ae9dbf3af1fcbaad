"""Bounded, documented training samples for the two classifiers.

Only these samples are bounded; scoring always covers every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import fold, text_or_empty

#: Bounds of the fitted samples (rows with the smallest seeded id hash).
MAX_POSITIVES = 6_000
MAX_UNLABELLED = 12_000


def _smallest(ids: DataFrame, bound: int) -> DataFrame:
    """The ``bound`` ids of smallest seeded hash.

    A threshold from the counted ids lets about a tenth more than the bound
    through, so that the sort sees few rows however many there are.
    """
    dealt = ids.select("doc_id", F.xxhash64(F.lit(17).cast("int"), F.col("doc_id")).alias("o"))
    n = ids.count()
    if n > bound:
        below = -(1 << 63) + int((1 << 64) * min(1.0, (1.1 * bound + 100) / n))
        dealt = dealt.where(F.col("o") < F.lit(min(below, (1 << 63) - 1)))
    return dealt.distinct().orderBy("o", "doc_id").limit(bound).select("doc_id")


def training_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held: int) -> DataFrame:
    """(doc_id, text, positive, half) of the sample.

    Positives are ids outside the held-out fold with a label of 1 among theirs;
    no other label is read. Unlabelled rows are drawn from all documents outside
    the fold, the positives among them. ``half`` deals the ids into two.
    """
    outside = F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), mod) != held)
    positives = _smallest(labels.where(outside & (F.col(label) == 1)).select("doc_id").distinct(), MAX_POSITIVES)
    unlabelled = _smallest(docs.where(outside).select("doc_id"), MAX_UNLABELLED)
    ids = (positives.withColumn("positive", F.lit(True))
           .unionByName(unlabelled.withColumn("positive", F.lit(False))))  # at most the sum of both bounds
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return rows.join(F.broadcast(ids), "doc_id").withColumn(
        "half", F.pmod(F.xxhash64(F.lit(5), F.col("doc_id")), F.lit(2)) == 0)
