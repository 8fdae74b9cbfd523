"""Versioned pointers: small Parquet tables, one folder a version.

A version becomes visible when Spark's job commit moves its only file into
place; readers take the highest version that has a file.  One writer at a time
is assumed (a stream or a load job)."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class Versions:
    def __init__(self, spark: SparkSession, path: str, name: str = "version"):
        self.spark, self.path, self.name = spark, path, name

    def latest(self) -> int:
        """The newest version, -1 if there is none.  Only a missing folder
        counts as none; any other error is the caller's."""
        try:
            files = self.spark.read.parquet(self.path).inputFiles()
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return -1
            raise
        found = [int(m[1]) for f in files if (m := re.search(rf"/{self.name}=(\d+)/", f))]
        return max(found, default=-1)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self.name}={version}")

    def commit(self, version: int, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{self.name}={version}")
