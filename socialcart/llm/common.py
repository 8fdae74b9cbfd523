"""Helpers shared by the operators: shared scratch tables, hot-key joins and
the ASCII text rules that the operators agree on."""

from __future__ import annotations

import ctypes
import os
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from socialcart.session import checkpoint_root

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Fixed value: the white space that separates words and is collapsed, as a
# Java regular-expression class (bytes 0x20 and 0x09 to 0x0D).
SPACE_CLASS = r"[\x20\x09-\x0D]"

# A key is hot from this share of the rows on; at most HOT_KEYS keys can be.
HOT_KEYS = 1024


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Arrow batches to and from Python workers: what a worker and its executor hold
# beside their heaps is a few batches, whatever the length of the texts.
ARROW_ROWS = 2000
ARROW_BYTES = 4 * 2 ** 20


def find_package(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package from where
    the driver has it (on a cluster, ship it with ``--py-files``), give freed
    Arrow memory back, and get Arrow batches of bounded size."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    env = spark.sparkContext.environment
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    env.setdefault("MALLOC_ARENA_MAX", "2")
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *known])


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def map_arrow(df: DataFrame, run: Callable, schema: str, encodes: bool = False) -> DataFrame:
    """``df.mapInArrow(run, schema)`` on workers that find this package.

    Workers outlive their tasks: one that goes on to a step that does not
    encode (``encodes``) drops the tokenizer and its cache."""
    find_package(df.sparkSession)

    def task(batches):
        tokens = sys.modules.get("socialcart.llm.tokens")
        if tokens is not None and not encodes:
            tokens.encoder.cache_clear()
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def text_slices(texts: Iterable, size: int) -> Iterator[tuple[int, list]]:
    """(place of the first, texts) of consecutive values of an Arrow column
    that hold about ``size`` characters or bytes together, so that what a
    worker holds beside its Arrow batch is bounded by ``size`` and one text."""
    at, some, held = 0, [], 0
    for i, t in enumerate(texts):
        some.append(t.as_py())
        held += len(some[-1] or "")
        if held >= size:
            yield at, some
            at, some, held = i + 1, [], 0
    if some:
        yield at, some


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: the lineage is cut, lost executors lose nothing, and the table's
    size is known to the planner."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def collapse_space(col: Column) -> Column:
    """Null as empty, and each run of white space replaced by one space.

    Only runs other than a single space match, so ordinary text is copied
    without a replacement per word."""
    other_runs = rf"[\x09-\x0D]{SPACE_CLASS}*|\x20{SPACE_CLASS}+"
    return F.regexp_replace(F.coalesce(col, F.lit("")), other_runs, " ")


def join_by_key(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per ``key``; ``count``
    is the number of rows with that key), safe against hot keys.

    Keys with more than ``total / HOT_KEYS`` rows are at most ``HOT_KEYS``
    by arithmetic, so their part of ``table`` is broadcast; the rows of all
    other keys are joined by shuffle, where no key is large.  The result has
    the columns of ``rows`` and ``table`` in one struct column ``found``."""
    least = max(total // HOT_KEYS, 1)
    packed = table.select(F.col(key).alias("_k"), F.struct(*table.columns).alias("_t"), F.col(count).alias("_n"))
    hot = packed.where(F.col("_n") > least).select(F.col("_k").alias("_hk"), F.col("_t").alias("_ht"))
    cold = packed.where(F.col("_n") <= least).select("_k", "_t")
    out = rows.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
    # rows that are done, or have no key, get a key of their own that matches
    # nothing, so they spread over all tasks
    other = out.withColumn("_jk", F.when(F.col("_hk").isNull() & F.col(key).isNotNull(), F.struct(F.col(key).alias("k"), F.lit(0).cast("long").alias("s")))
                           .otherwise(F.struct(F.lit(None).cast(rows.schema[key].dataType).alias("k"),
                                               (F.monotonically_increasing_id() + 1).alias("s"))))
    cold = cold.withColumn("_ck", F.struct(F.col("_k").alias("k"), F.lit(0).cast("long").alias("s")))
    joined = other.join(cold, F.col("_jk") == F.col("_ck"), "left")
    return joined.select(*[F.col(c) for c in rows.columns], F.coalesce("_ht", "_t").alias("found"))
