"""Campaign helper edges (D16, D18) kept up to date by deltas.

A helper edge (user, campaign) stands for the paths user -> client -> message
-> campaign; it exists while it has a path, and is a purchase edge while one
of them was purchased.  Four bucket tables hold the state:

    messages   message_id                the present version of each message
    owners     (user_id, client_id)      rows that name the pair
    sent       (client_id, campaign)     messages, and purchased ones
    helpers    (user_id, campaign)       paths, and purchased ones

A batch of message versions gives signed rows: the old version is retracted,
the new one added.  With D for a change, sent changes by D(sent), the pairs
that appear or vanish are D(owners), and

    D(helpers) = D(owners) x sent before + owners after x D(sent)

joined on the client.  Only buckets of the batch's messages, clients and users
are read and written.  All four changes are computed from the state before the
batch, so a batch that died between two tables is completed by its retry: a
table that holds it already skips it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialcart.operators.graph import campaign_key
from socialcart.session import checkpoint_root
from socialcart.streaming.bucket_table import BucketTable

# Message versions in one file of a stream, which one task writes.
ROWS_A_FILE = 1_000_000
MESSAGE = ("message_id", "user_id", "client_id", "campaign_key", "is_purchased", "ord")


class HelperEdges:
    def __init__(self, spark: SparkSession, path: str, id_type: str = "long", buckets: int = 32):
        def table(name: str, columns: str, key: list[str], order: str = "batch", by: list[str] | None = None) -> BucketTable:
            schema = spark.createDataFrame([], columns).schema
            return BucketTable(spark, f"{path}/{name}", schema, key, order, buckets, by)

        i = id_type
        self.spark, self.path = spark, path
        self.messages = table("messages", f"message_id {i}, user_id {i}, client_id {i}, campaign_key string, is_purchased boolean, ord long",
                              ["message_id"], "ord")
        self.owners = table("owners", f"user_id {i}, client_id {i}, n long, batch long", ["user_id", "client_id"], by=["client_id"])
        self.sent = table("sent", f"client_id {i}, campaign_key string, n long, p long, batch long",
                          ["client_id", "campaign_key"], by=["client_id"])
        self.helpers = table("helpers", f"user_id {i}, campaign_key string, n long, p long, batch long",
                             ["user_id", "campaign_key"], by=["user_id"])

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/changes/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _apply(self, table: BucketTable, change: DataFrame, sums: list[str], batch_id: int) -> None:
        """Add a change to the counts of a table."""
        old = table.read(batch_id, like=change).select(*table.key, *sums)
        rows = old.unionByName(change.select(*table.key, *sums)).join(change.select(*table.key).distinct(), table.key, "left_semi")
        rows = rows.groupBy(*table.key).agg(*[F.sum(c).alias(c) for c in sums])
        table.upsert(rows.withColumn("batch", F.lit(batch_id).cast("long")), batch_id)

    def _signed(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows with ``sign`` -1 and 1 of the messages that change."""
        own = batch.select(*MESSAGE).where(F.col("message_id").isNotNull())
        rest = F.struct(*[c for c in MESSAGE if c not in ("message_id", "ord")])
        new = own.groupBy("message_id").agg(F.max(F.struct("ord", rest.alias("row"))).alias("new"))
        old = self.messages.read(batch_id, like=new).select(
            "message_id", F.struct("ord", rest.alias("row")).alias("old"))
        both = new.join(old, "message_id", "left").where(F.col("old").isNull() | (F.col("new") > F.col("old")))
        sides = F.array_compact(F.array(
            F.when(F.col("old").isNotNull(), F.struct("old.row", F.lit(-1).alias("sign"))),
            F.struct("new.row", F.lit(1).alias("sign"))))
        return both.select(F.explode(sides).alias("s")).select("s.row.*", "s.sign").where("client_id is not null")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """One batch of message versions (``MESSAGE`` columns)."""
        signed = self._stored(self._signed(batch, batch_id), "signed")
        bought = F.coalesce(F.col("is_purchased"), F.lit(False)).cast("long")
        owners = self._stored(signed.where("user_id is not null").groupBy("user_id", "client_id")
                              .agg(F.sum("sign").cast("long").alias("n")).where("n <> 0"), "owners")
        sent = self._stored(signed.where("campaign_key is not null").groupBy("client_id", "campaign_key").agg(
            F.sum("sign").cast("long").alias("n"), F.sum(F.col("sign") * bought).alias("p")).where("n <> 0 or p <> 0"), "sent")

        # pairs that appear (1) or vanish (-1)
        had = self.owners.read(batch_id, like=owners).select("user_id", "client_id", F.col("n").alias("had"))
        flips = owners.join(had, ["user_id", "client_id"], "left").fillna(0, ["had"]).select(
            "user_id", "client_id", ((F.col("had") + F.col("n") > 0).cast("long") - (F.col("had") > 0).cast("long")).alias("flip")).where("flip <> 0")
        before = self.sent.read(batch_id, like=flips)
        turned = flips.join(before, "client_id").select("user_id", "campaign_key", (F.col("flip") * F.col("n")).alias("n"),
                                                        (F.col("flip") * F.col("p")).alias("p"))
        pairs = self.owners.read(batch_id, like=sent).select("user_id", "client_id", "n").unionByName(owners)
        after = pairs.groupBy("user_id", "client_id").agg(F.sum("n").alias("n")).where("n > 0").select("user_id", "client_id")
        moved = after.join(sent, "client_id").select("user_id", "campaign_key", "n", "p")
        helpers = self._stored(turned.unionByName(moved).groupBy("user_id", "campaign_key").agg(
            F.sum("n").alias("n"), F.sum("p").alias("p")).where("n <> 0 or p <> 0"), "helpers")

        self._apply(self.helpers, helpers, ["n", "p"], batch_id)
        self._apply(self.sent, sent, ["n", "p"], batch_id)
        self._apply(self.owners, owners, ["n"], batch_id)
        self.messages.upsert(batch.select(*MESSAGE).where(F.col("message_id").isNotNull()), batch_id)

    def seed(self, clients: DataFrame, batch_id: int = 0) -> None:
        """The (user, client) pairs of the client table, before any message."""
        rows = clients.select("user_id", "client_id").dropna().distinct().withColumn("n", F.lit(1).cast("long"))
        self.owners.upsert(rows.withColumn("batch", F.lit(batch_id).cast("long")), batch_id)

    def edges(self) -> DataFrame:
        """``(user_id, campaign_key, purchased)`` as a full rebuild gives it."""
        return self.helpers.read().where("n > 0").select("user_id", "campaign_key", (F.col("p") > 0).alias("purchased"))


def helper_edges_by_deltas(messages: DataFrame, clients: DataFrame, batches: int = 3) -> DataFrame:
    """Message versions (columns of D15 plus ``ord``) applied as a stream of
    ``batches`` chunks of as many files as they need; the helper edges after
    the last.  A file holds about ``ROWS_A_FILE`` versions, picked by a hash."""
    spark = messages.sparkSession
    path = f"{checkpoint_root(spark)}/helper-deltas-{uuid.uuid4().hex}"
    rows = messages.select("message_id", "user_id", "client_id", campaign_key(messages).alias("campaign_key"), "is_purchased",
                           F.col("ord").cast("long").alias("ord"))
    source = f"{path}/source"
    rows.repartition(batches * (1 + rows.count() // (batches * ROWS_A_FILE)), "ord").write.parquet(source)
    per_batch = max(1, -(-len(spark.read.schema(rows.schema).parquet(source).inputFiles()) // batches))
    edges = HelperEdges(spark, f"{path}/state", buckets=8)
    edges.seed(clients)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch).parquet(source)
    (stream.writeStream.foreachBatch(lambda batch, i: edges.apply(batch, i + 1)).trigger(availableNow=True)
     .option("checkpointLocation", f"{path}/checkpoint").start().awaitTermination())
    return edges.edges()
