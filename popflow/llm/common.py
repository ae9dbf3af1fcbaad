"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popflow.session import shared_dir

#: Rows that may be broadcast once a count of a written table has proven them.
MAX_BROADCAST_ROWS = 500_000
#: Applications whose executors have the code.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once per application.

    A small zip that Spark's own file service hands out; needed where the
    package is not installed on the workers.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "popflow-code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(application)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the cluster's shared folder and read it back.

    Cuts lineage so that a lost executor costs a re-read, not a recomputation.
    The files live as long as the checkpoint folder keeps them.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a table whose counted rows are within the bound.

    Beyond it the join stays an ordinary shuffle join: same rows either way.
    """
    return F.broadcast(df) if rows <= limit else df


def fold(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
