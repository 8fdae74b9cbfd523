"""Data-quality reports (V03, V04) on hand-made rows."""

from pyspark.sql import types as T

from socialcart.operators import quality as V


def test_schema_report_warn_mode(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "b", "y")], "id long, name string, extra string")
    expected = T.StructType([
        T.StructField("id", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("missing_col", T.StringType(), True)])
    got = {(r["field"], r["rule"]): r["violations"] for r in V.schema_report(df, expected, "t").collect()}
    assert got == {("id", "type bigint != int"): None, ("id", "not null"): 0,
                   ("name", "not null"): 1, ("missing_col", "missing"): None,
                   ("extra", "additional"): None}
    assert df.count() == 2  # warn mode: rows are reported, never dropped


def test_foreign_key_report(spark):
    child = spark.createDataFrame([("a", "x"), ("b", None), ("z", "y")], "k string, c string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    pc = spark.createDataFrame([("x", 1)], "c string, n int")
    got = {r["constraint_name"]: r["orphans"] for r in V.foreign_key_report({
        "k": (child, parent, ["k"], ["k"]), "c": (child, pc, ["c"], ["c"])}).collect()}
    assert got == {"k": 1, "c": 1}  # NULL foreign keys are not orphans
