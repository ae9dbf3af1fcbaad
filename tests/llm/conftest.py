import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, dealt over three partitions."""
    def make(rows, **extra):
        full = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA).repartition(3)
        from pyspark.sql import functions as F
        return df.withColumns({k: F.lit(v) for k, v in extra.items()})
    return make
