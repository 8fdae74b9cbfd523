"""Full refresh of all tables as one snapshot.

Tables are written to a folder of their own, read back and checked (V01-V04
style checks, any function of the tables that returns violations); then one
pointer write makes the whole set current.  A reader opens the set that the
pointer names, so it never meets tables of two loads, and a load that fails
or is rejected leaves the old set as it was."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from socialcart.operators import quality as V
from socialcart.sources.versions import Versions

Check = Callable[[dict[str, DataFrame]], DataFrame]


class LoadRejected(ValueError):
    """A staged set broke a check; ``rows`` holds some of the violations."""

    def __init__(self, name: str, rows: list):
        super().__init__(f"check {name} failed: {rows}")
        self.name, self.rows = name, rows


def unique(table: str, key: list[str]) -> Check:
    return lambda t: V.duplicate_keys(t[table], key)


def references(child: str, key: list[str], parent: str, parent_key: list[str] | None = None) -> Check:
    return lambda t: V.orphans(t[child], t[parent], key, parent_key)


def not_null(table: str, cols: list[str]) -> Check:
    return lambda t: V.null_counts(t[table], cols, table).where("nulls > 0")


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], checks: dict[str, Check] | None = None) -> int:
    """Stage ``tables``, check them, make them current; the new version."""
    pointer = Versions(spark, f"{root}/current")
    folder = f"{root}/data/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    staged = {n: spark.read.schema(df.schema).parquet(f"{folder}/{n}") for n, df in tables.items()}
    for name, check in (checks or {}).items():
        if found := check(staged).limit(5).collect():
            raise LoadRejected(name, found)
    version = pointer.latest() + 1
    pointer.commit(version, spark.createDataFrame([(n, f"{folder}/{n}", df.schema.json()) for n, df in tables.items()],
                                                  "name string, folder string, schema string"))
    return version


def open_snapshot(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version (the current one by default)."""
    import json

    from pyspark.sql.types import StructType

    pointer = Versions(spark, f"{root}/current")
    at = pointer.latest() if version is None else version
    if at < 0:
        raise FileNotFoundError(f"no snapshot has been published below {root}")
    return {r["name"]: spark.read.schema(StructType.fromJson(json.loads(r["schema"]))).parquet(r["folder"])
            for r in pointer.read(at).collect()}
