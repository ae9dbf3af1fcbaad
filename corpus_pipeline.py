"""A training corpus from raw documents, in five stages.

Every stage gets what its predecessor kept, written as Parquet and read again;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from popflow.llm import decontaminate, lines, mixing, simhash, toxicity
from popflow.llm.common import read, ship, staged
from popflow.llm.queries import MIX


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents scored as toxic go."""
    return toxicity.reject_toxic(docs, read(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: later copies and near copies of a line go, and documents left without lines."""
    ship(spark)
    return lines.drop_duplicate_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each SimHash group stays."""
    ship(spark)
    return simhash.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a window of the benchmark go."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the mixture's documents, with the epochs each is seen in."""
    return mixing.mix_documents(docs, **MIX)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The first stage is a trained classifier: no SQL gives its rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').lower()}")
    return docs
