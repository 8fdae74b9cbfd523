"""Foreign keys in one shuffle, validators over nested paths."""

from socialcart.operators.constraints import FOREIGN_KEYS, VALIDATORS, ForeignKey, compile_validator, foreign_key_counts, validate

KEYS = (ForeignKey("one", "child", ("a",), "parent", ("p",)), ForeignKey("two", "child", ("a", "b"), "parent", ("p", "q")),
        ForeignKey("self", "child", ("b",), "child", ("a",)), ForeignKey("none", "nothing", ("x",), "parent", ("p",)))


def test_foreign_keys(spark):
    child = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z"), (None, "1"), (None, None)], "a long, b string")
    parent = spark.createDataFrame([(1, "x"), (1, "x"), (3, "y"), (None, "z")], "p int, q string")
    nothing = spark.createDataFrame([], "x int")
    got = foreign_key_counts({"child": child, "parent": parent, "nothing": nothing}, KEYS)
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {
        "one": (4, 1, 1), "two": (3, 1, 1), "self": (4, 3, 2), "none": (0, 0, 0)}


def test_foreign_keys_take_one_shuffle_of_the_rows(spark):
    child = spark.range(1000).selectExpr("id % 7 AS a", "cast(id AS string) AS b")
    parent = spark.range(5).selectExpr("id AS p", "cast(id AS string) AS q")
    plan = foreign_key_counts({"child": child, "parent": parent, "nothing": spark.range(0).toDF("x")}, KEYS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    # by (constraint, key), then one row a constraint
    assert text.count("Exchange hashpartitioning(constraint") == 2 and "SortMergeJoin" not in text
    assert len(FOREIGN_KEYS) == 8 and sum(len(k.child_key) == 2 for k in FOREIGN_KEYS) == 1


def test_nested_rules(spark):
    rows = [(1, ("k", True, 1.0), "x"), (2, (None, None, 2.0), None), (3, None, "y")]
    docs = spark.createDataFrame(rows, "id long, ref struct<key string, ok boolean, more double>, extra string")
    rules = {"id": "string!", "ref": "struct!", "ref.key": "string?", "ref.ok": "boolean", "ref.at": "date!", "gone": "int!", "may": "int"}
    got = {(r.field, r.rule): r.violations for r in validate({"t": docs}, {"t": rules}).collect()}
    assert got == {("id", "type bigint is not string"): 3, ("ref", "not null"): 1, ("ref.ok", "not null"): 1, ("ref.at", "required"): 2,
                   ("gone", "required"): 3, ("ref.more", "additional"): 3, ("extra", "additional"): 3}


def test_all_seven_tables_have_rules(spark):
    assert set(VALIDATORS) == {"users", "clients", "products", "events", "campaigns", "messages", "friendships"}
    assert len(VALIDATORS["messages"]) == 36
    empty = spark.createDataFrame([], "user_id string")
    assert [c[:2] for c in compile_validator(empty.schema, VALIDATORS["users"])] == [("user_id", "not null")]
    assert [r.violations for r in validate({"users": empty}, {"users": VALIDATORS["users"]}).collect()] == [0]
