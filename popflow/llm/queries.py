"""The registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popflow.llm.common import read
from popflow.llm.conversations import damaged, repair_conversations
from popflow.llm.decontaminate import contamination
from popflow.llm.hash_forest import nearest_neighbours
from popflow.llm.html_extract import main_texts
from popflow.llm.lines import line_dedup
from popflow.llm import mixing
from popflow.llm.piecewise import piecewise_hashes
from popflow.llm.pii import personal_data
from popflow.llm.quality import score_quality
from popflow.llm.runs import looped, periodic_runs, run_digests
from popflow.llm.simhash import simhash_groups
from popflow.llm.superkmer import substring_dedup
from popflow.llm.toxicity import score_toxicity


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)


#: Half of the corpus's tokens, in three epochs at most.
MIX = {"budget_share": 0.5, "epochs": 3, "seed": 11, "domain_weights": {"d0": 4, "d1": 2, "d2": 1, "d3": 3},
       "lang_weights": {"en": 6, "de": 2, "fr": 2, "es": 1}}


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), **MIX)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents"), window=13)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read(spark, sf_dir, "documents"), shingle=4, radius=4)


def op9_piecewise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise_hashes(read(spark, sf_dir, "documents"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents"), edits=2, least=30)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(looped(read(spark, sf_dir, "documents")), least=24, times=3))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(read(spark, sf_dir, "conversations")))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_quality": op2_quality,
    "op3_decontaminate": op3_decontaminate,
    "op4_mixing": op4_mixing,
    "op5_pii": op5_pii,
    "op6_substrings": op6_substrings,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_piecewise": op9_piecewise,
    "op10_lines": op10_lines,
    "op11_runs": op11_runs,
    "op12_conversations": op12_conversations,
    "op13_neighbours": op13_neighbours,
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {"op4_mixing": mixing.oracle(**MIX)}
