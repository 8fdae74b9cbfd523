"""Result files: query result JSON, summary table, timing CSV."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_result(df: DataFrame, path: str, query: str, database: str = "spark") -> dict:
    """Rows as JSON lines under ``<path>/rows`` and a one-row summary
    ``{database, query, execution_time_sec, row_count}`` under
    ``<path>/summary``.  The row count is observed during the write (one
    pass); the time covers running the query and writing its rows."""
    obs = Observation(f"result_{query}")
    t0 = time.perf_counter()
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{path}/rows")
    secs = time.perf_counter() - t0
    meta = {"database": database, "query": query, "execution_time_sec": round(secs, 3),
            "row_count": int(obs.get["n"])}
    spark = df.sparkSession
    spark.createDataFrame([meta], "database string, query string, execution_time_sec double, "
                                  "row_count bigint") \
        .coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    return meta


def result_summary(spark: SparkSession, summary_paths: list[str], databases: list[str],
                   queries: list[str]) -> DataFrame:
    """One row per (database, query) of the databases that have a result
    file; a missing file is skipped, and so is a database without any, while a
    query that its files lack gives NULLs."""
    schema = "database string, query string, execution_time_sec double, row_count bigint"
    existing = [p for p in summary_paths if _exists(spark, p)]
    found = spark.read.schema(schema).json(existing) if existing else spark.createDataFrame([], schema)
    grid = spark.createDataFrame([(d, q) for d in databases for q in queries], "database string, query string")
    # one row a query and system: a few rows
    grid = grid.join(F.broadcast(found.select("database").distinct()), "database", "left_semi")
    return grid.join(found, ["database", "query"], "left")


def _exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds at least one JSON file (file listing only);
    only a missing path counts as none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
    try:
        return bool(files.load(path).select("path").limit(1).collect())
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def write_timings(spark: SparkSession, rows: list[tuple[str, int, float, str]], path: str) -> DataFrame:
    """``query_name, run_number, execution_time_ms, database`` → CSV."""
    df = spark.createDataFrame(rows, "query_name string, run_number int, "
                                     "execution_time_ms double, database string")
    df = df.withColumn("execution_time_ms", F.round("execution_time_ms", 3))
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return df
