"""Join helpers: row-checked broadcast, undirected edges, hot-key salting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side we are willing to ship to every executor, in rows.  At about
# 16-40 bytes per row of keys this stays far below executor memory; beyond it
# the join is left to the shuffle strategies (and AQE's runtime re-plan).
BROADCAST_MAX_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows.

    The check is one job, ``limit(max_rows + 1).count()``: each partition
    stops after ``max_rows + 1`` rows, though the work upstream of ``df``
    (scans, aggregates) still runs.  Above the bound the frame is returned
    unchanged and Spark picks a shuffle join (sort-merge or shuffled hash,
    with AQE skew splitting).
    """
    return checked_broadcast(df, max_rows)[0]


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      reuse: bool = False) -> tuple[DataFrame, bool]:
    """Like :func:`bounded_broadcast`, also telling whether it broadcast, so
    a plan can pick a different shape for the large case.

    ``reuse=True`` persists ``df`` (memory, spilling to disk) and counts it
    fully, so the checked rows are computed once and read again by the
    query in either case (broadcast or shuffle join); lost blocks are
    recomputed from lineage.  Use it when ``df`` is expensive to derive."""
    if reuse:
        df = df.persist()
        n = df.count()
    else:
        n = df.limit(max_rows + 1).count()
    return (F.broadcast(df), True) if n <= max_rows else (df, False)


def undirected(edges: DataFrame, a: str = "user_id", b: str = "friend_id") -> DataFrame:
    """Both directions of every stored edge (``UNION ALL``: a pair stored
    both ways appears twice in each direction, as in the source queries)."""
    # one pass over the edges: each row generates its two directions
    both = F.array(F.struct(F.col(a).alias(a), F.col(b).alias(b)),
                   F.struct(F.col(b).alias(a), F.col(a).alias(b)))
    return edges.select(F.explode(both).alias("_e")).select(f"_e.{a}", f"_e.{b}")


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keys holding at least ``min_rows`` rows (one partial aggregate).  At
    most ``rows / min_rows`` keys qualify, so the result is small."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= min_rows).select(key))


def salted_join(heavy: DataFrame, light: DataFrame, key: str, hot: DataFrame,
                buckets: int, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` that splits hot keys over ``buckets`` tasks
    without relying on AQE: rows of ``heavy`` with a hot key get a salt from
    a hash of the row, rows of ``light`` with a hot key are replicated once
    per salt; other keys keep salt 0.  The hot-key list is broadcast after a
    row check.  Equivalent to ``heavy.join(light, key, how)`` for ``inner``
    and ``left`` (heavy preserved)."""
    hot_b = bounded_broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
    h = heavy.join(hot_b, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*[F.col(c) for c in heavy.columns]),
                                              F.lit(buckets))).otherwise(F.lit(0)))
    zero = F.lit(0).cast("long")
    salts = F.when(F.col("_hot"), F.sequence(zero, F.lit(buckets - 1).cast("long"))) \
        .otherwise(F.array(zero))
    lt = light.join(hot_b, key, "left").withColumn("_salt", F.explode(salts))
    return (h.drop("_hot").join(lt.drop("_hot"), [key, "_salt"], how).drop("_salt"))
