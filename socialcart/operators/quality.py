"""Data-quality checks re-aimed from declared constraints.

Each check returns a DataFrame of findings instead of rejecting the load;
every check is one aggregate or one anti-join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (NULL keys are
    reported too: a primary key may not be NULL)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def null_counts(df: DataFrame, cols: list[str], table: str = "") -> DataFrame:
    """``(table, column, nulls)`` for the NOT NULL columns, from one
    aggregate over the table."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.select(F.lit(table).alias("table_name"),
                      F.expr(f"stack({len(cols)}, {stack}) AS (column_name, nulls)"))


def orphans(child: DataFrame, parent: DataFrame, child_key: list[str],
            parent_key: list[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    pk = parent_key or child_key
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(pk, child_key)]).distinct()
    c = child
    for k in child_key:
        c = c.where(F.col(k).isNotNull())
    return c.join(p, child_key, "left_anti")


def foreign_key_report(checks: dict[str, tuple[DataFrame, DataFrame, list[str], list[str]]]) -> DataFrame:
    """V03 over several keys: ``(constraint, orphans)``."""
    parts = [orphans(c, p, ck, pk).agg(F.count(F.lit(1)).alias("orphans"))
             .select(F.lit(name).alias("constraint_name"), "orphans")
             for name, (c, p, ck, pk) in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def schema_report(df: DataFrame, expected: T.StructType, table: str = "") -> DataFrame:
    """V04 (warn mode): per expected field, is it present, does the type
    match, how many NULLs in a non-nullable field; plus additional fields.
    Schema comparison is metadata only; the NULL counts are one aggregate."""
    actual = {f.name: f for f in df.schema.fields}
    rows = []
    null_cols = []
    for f in expected.fields:
        a = actual.get(f.name)
        if a is None:
            rows.append((f.name, "missing", None))
            continue
        if a.dataType != f.dataType:
            rows.append((f.name, f"type {a.dataType.simpleString()} != {f.dataType.simpleString()}", None))
        if not f.nullable:
            null_cols.append(f.name)
    for name in actual:
        if name not in expected.fieldNames():
            rows.append((name, "additional", None))
    spark = df.sparkSession
    schema = "field string, rule string, violations bigint"
    meta = spark.createDataFrame(rows, schema)
    if not null_cols:
        out = meta
    else:
        nulls = null_counts(df, null_cols).select(
            F.col("column_name").alias("field"), F.lit("not null").alias("rule"),
            F.col("nulls").cast("bigint").alias("violations"))
        out = meta.unionByName(nulls)
    return out.select(F.lit(table).alias("table_name"), "field", "rule", "violations")
