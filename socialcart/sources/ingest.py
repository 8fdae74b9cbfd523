"""Ingest of a tree of CSV files as one job per header.

Files are grouped by their header line.  All files of one header are read by
one scan, each row with the file it came from, and written once, by outcome:

    <out>/<k>/_outcome=kept        cleaned columns, _file
    <out>/<k>/_outcome=malformed   rows with more fields than the header
    <out>/<k>/_outcome=empty       rows blank after cleaning

``_raw`` holds the row as read where it was rejected, so nothing is lost and
kept + malformed + empty is what each file holds.  The number of jobs follows
the number of different headers (kinds of table), not the number of files:
100,000 files of five extracts take seven jobs.  Files are split over tasks
by Spark; one scan of the lines that start files finds the headers.

Defined cases: a file with a header alone appears in the metrics with zeros, a
file without bytes is not listed by Spark and so does not; short rows are padded with blanks; blank lines are
skipped; header names are trimmed; a header with a name twice is refused; files
are named by their URI.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialcart.functions.clean import blank_row, clean_columns
from socialcart.sources.csv_io import CORRUPT, field_count, preflight

KEPT, MALFORMED, EMPTY = "kept", "malformed", "empty"


def file_headers(spark: SparkSession, root: str, glob: str = "*.csv") -> dict[str, str]:
    """The first line that is not blank of each file that has one: one pass
    over the lines, one row a file to the driver."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
    first = (lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                          F.monotonically_increasing_id().alias("n"))
             .where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "n").alias("header")))
    return {r["file"]: r["header"].lstrip("\ufeff") for r in first.collect()}


def _names(header: str) -> list[str]:
    """Trimmed column names of a header line."""
    names = [c.strip() for c in next(csv.reader([header]))]
    if len(set(names)) < len(names):
        raise ValueError(f"a column name occurs twice in the header {header!r}")
    return names


def _rows(spark: SparkSession, files: list[str], names: list[str], multiline: bool, compat: bool) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    read = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
            .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multiline).csv(files))
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    text = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]), spaces))
    too_long = F.col(CORRUPT).isNotNull() & (field_count(F.col(CORRUPT)) > len(names))
    outcome: Column = F.when(too_long, MALFORMED).when(blank_row(names), EMPTY).otherwise(KEPT)
    tagged = read.select(*[F.col(f"`{n}`") for n in names], F.col("_metadata.file_path").alias("_file"), outcome.alias("_outcome"),
                         F.when(outcome != KEPT, text).alias("_raw"))
    return clean_columns(tagged, names, compat=compat)


class Ingested:
    """What an ingest wrote: one table per header, and all files seen."""

    def __init__(self, spark: SparkSession, out: str, tables: dict[int, list[str]], files: list[str]):
        self.spark, self.out, self.tables, self.files = spark, out, tables, files

    def table(self, k: int) -> DataFrame:
        names = self.tables[k]
        schema = ", ".join([f"`{n}` string" for n in names] + ["_file string", "_raw string", "_outcome string"])
        return self.spark.read.schema(schema).parquet(f"{self.out}/{k}")

    def kept(self, names: list[str]) -> DataFrame:
        """Cleaned rows of the files whose header has these names."""
        k = next(k for k, own in self.tables.items() if own == names)
        return self.table(k).where(F.col("_outcome") == KEPT).drop("_outcome", "_raw").withColumnRenamed("_file", "file")

    def _all(self, *cols: Column) -> DataFrame:
        empty = self.spark.createDataFrame([], "_file string, _raw string, _outcome string")
        parts = [self.table(k).select("_file", "_raw", "_outcome") for k in self.tables]
        return reduce(DataFrame.unionByName, parts, empty).select(*cols)

    def rejects(self) -> DataFrame:
        """``(file, raw, reason)`` of every rejected row."""
        return self._all(F.col("_file").alias("file"), F.col("_raw").alias("raw"), F.col("_outcome").alias("reason")).where(
            F.col("reason") != KEPT)

    def metrics(self) -> DataFrame:
        """``(file, kept, skipped_empty, skipped_malformed)``, zeros for files
        without rows: one aggregate over the outcomes."""
        rows = self._all(F.col("_file").alias("file"), F.col("_outcome"))
        seen = self.spark.createDataFrame([(f, None) for f in self.files], "file string, _outcome string")
        of = lambda kind: F.count_if(F.coalesce(F.col("_outcome") == kind, F.lit(False)))
        return rows.unionByName(seen).groupBy("file").agg(
            of(KEPT).alias("kept"), of(EMPTY).alias("skipped_empty"), of(MALFORMED).alias("skipped_malformed"))


def ingest(spark: SparkSession, root: str, out: str, multiline: bool = False, compat: bool = False) -> Ingested:
    """Clean every CSV file below ``root`` into ``out`` (see the module
    docstring).  Pointer files fail the job before anything is written."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
              .load(root).select("path", F.col("_metadata.file_path").alias("uri")).collect())
    path_of = {r["uri"]: r["path"] for r in listed}
    preflight(spark, sorted(path_of.values()))
    groups: dict[str, list[str]] = {}
    for uri, header in sorted(file_headers(spark, root).items()):
        groups.setdefault(header, []).append(path_of[uri])
    tables = {}
    for k, (header, own) in enumerate(groups.items()):
        tables[k] = _names(header)
        (_rows(spark, own, tables[k], multiline, compat)
         .write.mode("overwrite").partitionBy("_outcome").parquet(f"{out}/{k}"))
    return Ingested(spark, out, tables, sorted(path_of))
