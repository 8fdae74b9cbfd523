"""A keyed table in hash buckets with a versioned manifest.

Layout::

    <path>/data/version=<v>/bucket=<b>   rows of bucket b, one per key
    <path>/manifest/version=<v>          bucket, data_version, batch_id

A batch of upserts rewrites only the buckets of its keys: the new rows are cut
to the latest per key, merged with the old rows of those buckets and written
as the next data version; then one manifest write makes them visible, all
buckets at once.  A batch that dies before the manifest leaves the old version
readable, and its half-written data is overwritten by the retry.  A read takes
the files that the manifest names: it has no aggregate and no join.

The manifest remembers the last batch, so a batch that is delivered again does
nothing.  A late row (lower ``order`` than the stored one) does not replace it;
at equal order the greater row wins, whatever the batch.

Scale: a batch costs the buckets that it touches, so size ``buckets`` to keep
one at a few hundred megabytes and let a batch carry rows of many keys.  Keys
are unique in a bucket, so no key is hot; versions in a batch are combined
inside each task first.  NULL keys form keys of their own (null equals null).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialcart.session import checkpoint_root
from socialcart.sources.versions import Versions

BUCKETS = 32


class BucketTable:
    def __init__(self, spark: SparkSession, path: str, schema, key: list[str], order: str, buckets: int = BUCKETS,
                 bucket_by: list[str] | None = None):
        """``bucket_by``: the part of the key that chooses the bucket, so that
        rows can be looked up by it (default: the whole key)."""
        self.spark, self.path, self.schema, self.key, self.order, self.buckets = spark, path, schema, key, order, buckets
        self.bucket_by = bucket_by or key
        self.manifest = Versions(spark, f"{path}/manifest")

    def _latest(self, rows: DataFrame) -> DataFrame:
        """The greatest row per key by ``order``, then by the other columns."""
        rest = [c for c in self.schema.names if c not in self.key and c != self.order]
        best = rows.groupBy("bucket", *self.key).agg(F.max(F.struct(self.order, *rest)).alias("_best"))
        return best.select("bucket", *self.key, "_best.*").select("bucket", *self.schema.names)

    def _load(self, entries: list) -> DataFrame:
        """Rows of manifest entries, with their bucket."""
        empty = self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/data/version={e['data_version']}/bucket={e['bucket']}" for e in entries]
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else empty
        return rows

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def read(self, before: int | None = None, like: DataFrame | None = None) -> DataFrame:
        """The current rows, or those from before batch ``before``; with
        ``like`` only the buckets that its ``bucket_by`` columns fall into."""
        version = self.manifest.latest()
        entries = self.manifest.read(version).collect() if version >= 0 else []
        if entries and before is not None and entries[0]["batch_id"] >= before:
            entries = self.manifest.read(version - 1).collect() if version else []
        entries = [e for e in entries if e["bucket"] >= 0]
        if like is not None and entries:
            asked = {r["b"] for r in like.select(self._bucket().alias("b")).distinct().collect()}
            entries = [e for e in entries if e["bucket"] in asked]
        return self._load(entries)

    def upsert(self, batch: DataFrame, batch_id: int) -> int:
        """Apply a batch; the version that holds it.  Returns the present
        version without a change if the batch was applied before."""
        version = self.manifest.latest()
        # at most one row a bucket, and one (bucket -1) for the last batch
        entries = self.manifest.read(version).collect() if version >= 0 else []
        if entries and batch_id <= entries[0]["batch_id"]:
            return version
        staged = f"{self.path}/staged"
        self._latest(batch.select(*self.schema.names).withColumn("bucket", self._bucket())) \
            .write.mode("overwrite").parquet(staged)
        new = self.spark.read.parquet(staged)
        touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}
        old = self._load([e for e in entries if e["bucket"] in touched]).withColumn("bucket", self._bucket())
        target = version + 1
        (self._latest(old.unionByName(new)).hint("rebalance", "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={target}"))
        kept = [(e["bucket"], e["data_version"], batch_id) for e in entries if e["bucket"] not in touched and e["bucket"] >= 0]
        rows = kept + [(b, target, batch_id) for b in touched] + [(-1, -1, batch_id)]
        self.manifest.commit(target, self.spark.createDataFrame(rows, "bucket int, data_version long, batch_id long"))
        return target


def stream_upserts(table: BucketTable, source: str, files_per_batch: int = 1, checkpoint: str | None = None) -> None:
    """Apply every chunk file below ``source`` as batches of a file stream."""
    spark = table.spark
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (stream.writeStream.foreachBatch(table.upsert).trigger(availableNow=True)
             .option("checkpointLocation", checkpoint or f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}").start())
    query.awaitTermination()
