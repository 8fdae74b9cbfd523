"""Exact top k keys by number of rows without moving every key (Q2-a).

Three phases over the counts inside each scan task (uniform threshold):

1. every task counts its own rows; its k largest counts move and are summed.
   The k-th largest sum is a lower bound of the k-th largest count.
2. a key with no task count of at least bound / tasks cannot reach the bound,
   so only counts from there on move.  What a key may have elsewhere is less
   than that share a task, which bounds its count from above.
3. exact sums of the keys whose upper bound reaches the (raised) bound.

The rows that move are k a task, the counts over the share, and those of the
candidates; on skewed data that is a small part of all keys, on even data
(every count below the share) it is all counts, which the plain aggregate moves
too.  The task counts are stored once in the shared folder.  A task holds one
number a distinct key of its split."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialcart.session import checkpoint_root


def _task_counts(rows: DataFrame, key: str, k: int) -> DataFrame:
    """(task, key, n, best): rows a key and task; ``best`` marks the k keys
    with the largest counts of a task."""
    kind = rows.schema[key].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, held, arrow = TaskContext.get().partitionId(), Counter(), None
        for batch in batches:
            arrow = batch.schema.field(0).type
            for v in pc.value_counts(batch.column(0)).to_pylist():
                held[v["values"]] += v["counts"]
        if arrow is None:
            return
        keys = list(held)
        best = set(sorted(keys, key=lambda x: (-held[x], x is None, x))[:k])
        for i in range(0, len(keys), 100_000):
            some = keys[i:i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * len(some), pa.int32()), pa.array(some, arrow), pa.array([held[x] for x in some], pa.int64()),
                 pa.array([x in best for x in some])], ["task", "key", "n", "best"])

    return rows.select(F.col(key)).mapInArrow(count, f"task int, key {kind.simpleString()}, n long, best boolean")


def _kth(sums: DataFrame, k: int) -> int:
    """The k-th largest sum, 0 if there are fewer."""
    top = sums.orderBy(F.desc("s")).limit(k).collect()
    return top[-1]["s"] if len(top) == k else 0


def top_counts(rows: DataFrame, key: str, k: int, name: str = "activity") -> DataFrame:
    """``(<key>, <name>)`` of the k keys with most rows, ties by key (null
    last); equal to grouping, sorting and cutting."""
    spark = rows.sparkSession
    path = f"{checkpoint_root(spark)}/task-counts-{uuid.uuid4().hex}"
    counts = _task_counts(rows, key, k)
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    tasks = counts.select("task").distinct().count()
    if not tasks:
        return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name)).limit(0)
    bound = _kth(counts.where("best").groupBy("key").agg(F.sum("n").alias("s")), k)
    share = -(-bound // tasks)  # a key that reaches the bound has at least this in some task
    known = counts.where(F.col("n") >= share).groupBy("key").agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("met"))
    known_path = f"{path}-known"
    known.write.parquet(known_path)
    known = spark.read.schema(known.schema).parquet(known_path)
    bound = max(bound, _kth(known, k))
    upper = F.col("s") + (tasks - F.col("met")) * max(share - 1, 0)
    candidates = known.where(upper >= bound).select(F.col("key").alias("_key"))
    exact = counts.join(candidates, F.col("key").eqNullSafe(F.col("_key")), "left_semi").groupBy("key").agg(F.sum("n").alias(name))
    return exact.select(F.col("key").alias(key), name).orderBy(F.col(name).desc(), F.col(key).asc_nulls_last()).limit(k)
