"""Load report (S17) and timing statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(label, row_count)`` per table — one count aggregate each,
    unioned (no rows pass through the driver)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(label).alias("label"), "row_count") for label, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def timing_stats(rows: DataFrame) -> DataFrame:
    """Per (database, query_name): runs, average and **sample**
    standard deviation of ``execution_time_ms`` (n − 1, as published), to
    3 decimals like the published table."""
    return rows.groupBy("database", "query_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.round(F.avg("execution_time_ms"), 3).alias("avg_ms"),
        F.round(F.stddev_samp("execution_time_ms"), 3).alias("stddev_ms"),
        F.min("execution_time_ms").alias("min_ms"),
        F.max("execution_time_ms").alias("max_ms"))
