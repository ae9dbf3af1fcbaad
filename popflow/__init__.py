"""popflow: Spark-native game-event analytics.

Typed event ingestion, scoring, five keyed / tumbling-window aggregates that
run unchanged in batch and Structured Streaming, changelog tables with a
current-state view, dashboard post-aggregations and data-quality checks.
Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so Catalyst plans it and it scales with the cluster.
"""

__version__ = "0.1.0"
