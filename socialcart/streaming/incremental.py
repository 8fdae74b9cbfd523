"""Incremental chunked loading with upserts (S12) on Structured Streaming.

The source project splits each input into chunks of 10,000 rows and applies
them one after another as upserts.  Here:

* ``write_chunks``   – split a DataFrame into files of at most ``n`` rows
                       (``maxRecordsPerFile``), all executors writing;
* ``load_increments``– a file stream over the chunk folder,
                       ``maxFilesPerTrigger`` chunks per micro-batch,
                       ``trigger(availableNow=True)``; each micro-batch is
                       appended to a change log under ``batch_id=<n>``
                       (overwrite of that one folder, so a retried batch is
                       idempotent) and progress is kept in the checkpoint;
* ``current_state``  – merge-on-read: the latest row per key over the newest
                       compacted base plus later log batches, one ``max_by``
                       aggregate (partial aggregation first, so hot keys are
                       combined before the shuffle);
* ``compact``        – writes the current state as a new versioned base.

No micro-batch rewrites the stored table, so batch cost stays proportional
to the batch, not to the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialcart.session import checkpoint_root
from socialcart.sources.versions import Versions


# Most micro-batches of one load.
MAX_BATCHES = 64


def write_chunks(df: DataFrame, path: str, rows_per_chunk: int = 10_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_chunk).parquet(path)


def load_increments(spark: SparkSession, source: str, schema, log_dir: str,
                    checkpoint: str | None = None, files_per_batch: int = 1,
                    fmt: str = "parquet") -> int:
    """Run the stream until every chunk present now is applied; returns the
    number of micro-batches."""
    ckpt = checkpoint or f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .format(fmt).load(source))

    applied: list[int] = []  # Spark itself reports the last 100 batches only

    def apply(batch: DataFrame, batch_id: int) -> None:
        applied.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{log_dir}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(set(applied))


def _latest_base(spark: SparkSession, base_dir: str | None):
    """(rows of the newest compacted base, last batch it covers) or (None, -1)."""
    upto = Versions(spark, base_dir, "upto").latest() if base_dir else -1
    return (spark.read.parquet(f"{base_dir}/upto={upto}"), upto) if upto >= 0 else (None, -1)


def current_state(spark: SparkSession, log_dir: str, key: list[str], order: str,
                  base_dir: str | None = None) -> DataFrame:
    """Latest row per ``key`` by ``order``: the newest compacted base (if
    any) plus only the log batches written after it — partition pruning on
    ``upto`` and ``batch_id`` keeps reads proportional to the state plus
    the recent changes, not to the whole history."""
    base, upto = _latest_base(spark, base_dir)
    log = spark.read.parquet(log_dir)
    rows = log.where(F.col("batch_id") > upto).drop("batch_id")
    if base is not None:
        rows = base.select(*rows.columns).unionByName(rows)
    rest = [c for c in rows.columns if c not in key]
    latest = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return latest.select(*key, "_r.*")


def compact(spark: SparkSession, log_dir: str, key: list[str], order: str, base_dir: str) -> int:
    """Write the current state as a new base ``upto=<last batch>`` and return
    that batch id; later reads skip every log batch it covers.  Earlier
    bases and log batches stay in place (readers never see a half-written
    state; removing old versions is a separate retention step)."""
    upto = spark.read.parquet(log_dir).agg(F.max("batch_id")).first()[0]
    if upto is None:
        return -1
    state = current_state(spark, log_dir, key, order, base_dir)
    state.write.mode("overwrite").parquet(f"{base_dir}/upto={int(upto)}")
    return int(upto)


def incremental_upsert(spark: SparkSession, rows: DataFrame, key: list[str], order: str,
                       rows_per_chunk: int = 2_000, files_per_batch: int = 2) -> DataFrame:
    """S12 end to end: chunk ``rows`` into the shared checkpoint folder, apply
    the chunks through the stream, return the final state.

    A micro-batch applies ``files_per_batch`` chunks, or more when there are
    more than ``MAX_BATCHES`` times as many: each costs a fixed time on the
    driver, so their number must not grow with the table."""
    base = f"{checkpoint_root(spark)}/incremental-{uuid.uuid4().hex}"
    write_chunks(rows, f"{base}/source", rows_per_chunk)
    chunks = len(spark.read.schema(rows.schema).parquet(f"{base}/source").inputFiles())
    load_increments(spark, f"{base}/source", rows.schema, f"{base}/log",
                    f"{base}/checkpoint", max(files_per_batch, -(-chunks // MAX_BATCHES)))
    return current_state(spark, f"{base}/log", key, order)
