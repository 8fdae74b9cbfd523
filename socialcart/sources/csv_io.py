"""CSV ingest and cleaned-CSV output.

* ``list_csv_files``   – S01: recursive discovery, sorted (file-system metadata only)
* ``preflight``        – S16: fail on files that are Git-LFS pointers
* ``read_text_table``  – S02–S05: header CSV as all-text columns, header names
                         trimmed, over-long rows flagged, short rows padded
* ``clean_csv``        – S06–S08: clean one table and write it, counting
                         kept / blank / malformed rows in the same pass
                         (``Observation``), so the data is read once
* ``clean_csv_tree``   – the folder-to-folder job, one table per file,
                         keeping relative paths
"""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialcart.functions.clean import clean_frame

CORRUPT = "_corrupt_record"
LFS_PREFIX = "version https://git-lfs"


def list_csv_files(spark: SparkSession, root: str) -> list[str]:
    """Every ``*.csv`` under ``root`` (recursive), sorted.  Only the
    ``path`` column of the ``binaryFile`` source is read, so file contents
    are never loaded; the result is the file list (metadata), not data.
    Zero-length files hold no rows and are not listed."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").load(root).select("path"))
    return sorted(r["path"] for r in files.collect())


def preflight(spark: SparkSession, paths: list[str]) -> None:
    """Raise when any file starts like a Git-LFS pointer."""
    if not paths:
        return
    first = (spark.read.text(paths).where(F.col("value").startswith(LFS_PREFIX))
             .select(F.input_file_name().alias("f")).limit(1).collect())
    if first:
        raise ValueError(f"input file is a Git-LFS pointer, not data: {first[0]['f']}")


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def field_count(line) -> F.Column:
    """Number of fields of a raw CSV record: commas outside quoted parts + 1."""
    outside = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return F.length(outside) - F.length(F.regexp_replace(outside, ",", "")) + 1


def read_text_table(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All columns as text, header names trimmed (H0).

    Adds ``_malformed`` (more fields than the header, S03).  Short rows get
    NULLs for the missing trailing fields (S04); blank lines are skipped by
    the reader (S05).  ``multiline=True`` accepts quoted newlines but makes
    every file one unsplittable task, so it is opt-in: the default read
    splits large files across executors.
    """
    names = _header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names]
                          + [T.StructField(CORRUPT, T.StringType(), True)])
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multiline)
          .option("escape", '"').option("encoding", "UTF-8").csv(path))
    malformed = F.col(CORRUPT).isNotNull() & (field_count(F.col(CORRUPT)) > len(names))
    out = df.select(*[F.col(f"`{n}`").alias(n.strip()) for n in names],
                    malformed.alias("_malformed"))
    return out


def clean_csv(spark: SparkSession, path: str, out_path: str, fmt: str = "parquet",
              compat: bool = False, multiline: bool = False) -> dict[str, int]:
    """Clean one table, overwrite ``out_path``; returns
    ``{"kept", "skipped_empty", "skipped_malformed"}`` measured during the
    write itself."""
    if not _header(spark, path):  # an empty file: nothing to clean, nothing written
        return {"kept": 0, "skipped_empty": 0, "skipped_malformed": 0}
    raw = read_text_table(spark, path, multiline)
    data_cols = [c for c in raw.columns if c != "_malformed"]
    obs = Observation("ingest")
    # malformed rows are counted on the raw side of the same scan
    counted = (raw.select(*data_cols, "_malformed")
               .observe(obs, F.count_if(F.col("_malformed")).alias("skipped_malformed")))
    obs2 = Observation("kept")
    out = clean_frame(counted.where(~F.col("_malformed")).select(*data_cols),
                      compat=compat, drop_blank=True, observation=obs2)
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(out_path)
    else:
        writer.format(fmt).save(out_path)
    m1, m2 = obs.get, obs2.get
    return {"kept": int(m2["kept"]), "skipped_empty": int(m2["skipped_empty"]),
            "skipped_malformed": int(m1["skipped_malformed"])}


def clean_csv_tree(spark: SparkSession, raw_dir: str, out_dir: str, fmt: str = "parquet",
                   multiline: bool = False) -> DataFrame:
    """S01 + S07 + S08: clean every CSV under ``raw_dir`` into ``out_dir``
    at the same relative path (Parquet by default, without the ``.csv``
    suffix; ``fmt='csv'`` keeps the name); returns per-file metrics plus a
    total row."""
    files = list_csv_files(spark, raw_dir)
    preflight(spark, files)
    rows = []
    base = urlparse(raw_dir).path.rstrip("/") or raw_dir
    for f in files:
        rel = os.path.relpath(urlparse(f).path, base)
        target = rel if fmt == "csv" else os.path.splitext(rel)[0]
        m = clean_csv(spark, f, os.path.join(out_dir, target), fmt, multiline=multiline)
        rows.append((rel, m["kept"], m["skipped_empty"], m["skipped_malformed"]))
    schema = "file string, kept bigint, skipped_empty bigint, skipped_malformed bigint"
    per_file = spark.createDataFrame(rows, schema)
    total = per_file.agg(F.lit("TOTAL").alias("file"),
                         *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
                           for c in ("kept", "skipped_empty", "skipped_malformed")])
    return per_file.unionByName(total)
