"""Continuously kept sketches: each micro-batch adds its own, reads unite them.

Sketches merge, so the stream needs no state: a micro-batch is aggregated to one
sketch per player and day, stored in the batch's own partition (a retried batch
replaces it), and a read unites what is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from popflow.functions.expressions import utc_day
from popflow.operators.sketches import HLL_LG, color_sketches
from popflow.sources.tables import TableStore

TABLE = "color_sketches"
SCHEMA = T.StructType([T.StructField("player", T.StringType()), T.StructField("day", T.DateType()),
                       T.StructField("colors", T.BinaryType()), T.StructField("batch_id", T.LongType())])


def start_color_sketches(events: DataFrame, store: TableStore, checkpoint: str, lg: int = HLL_LG,
                         trigger: dict | None = None) -> StreamingQuery:
    """Keep the distinct colours per player and day of an event stream."""
    store.create_namespace()
    store.create_table(TABLE, SCHEMA, ["batch_id"])
    view = f"_popflow_sketches_{store.namespace}"

    def write(batch: DataFrame, batch_id: int) -> None:
        found = color_sketches(batch.withColumn("day", utc_day("event_ts")), "player", "day", lg=lg)
        found.createOrReplaceTempView(view)
        batch.sparkSession.sql(f"INSERT OVERWRITE TABLE {store.qualified(TABLE)} PARTITION (batch_id={int(batch_id)}) "
                               f"SELECT player, day, colors FROM `{view}`")
        batch.sparkSession.catalog.dropTempView(view)

    w = events.writeStream.queryName(f"{store.namespace}.sketches").option("checkpointLocation", checkpoint).foreachBatch(write)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def stored_sketches(store: TableStore, first_day=None, last_day=None) -> DataFrame:
    """The stored sketches, of some days only if asked for."""
    found = store.table(TABLE)
    for bound, keep in ((first_day, F.col("day") >= F.lit(first_day)), (last_day, F.col("day") <= F.lit(last_day))):
        if bound is not None:
            found = found.where(keep)
    return found
