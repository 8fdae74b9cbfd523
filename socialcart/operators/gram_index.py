"""Substring search by n-gram postings (Q3-f): which texts contain a keyword.

Index folder (Parquet)::

    postings/bucket=<b>     gram, id      distinct grams of 1, 2 and 3 characters
    frequencies/bucket=<b>  gram, df
    texts/bucket=<b>        id, text      lower-cased; bucket by id

A keyword of three or more characters asks for its ``RAREST`` least frequent
trigrams; ids that hold all of them are candidates and are verified with
``contains`` on their texts.  A keyword of one or two characters is a gram
itself, so its postings are the answer and nothing is verified.  The empty
keyword is in every text.

Scale: only the buckets of the asked grams are read.  The rarest trigrams keep
a common one, which may stand in a third of all texts, out of the search
unless a keyword has no rarer.  Candidates carry (keyword, id); texts are
joined by id, reading only the buckets of the candidates' ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from socialcart.operators.joins import bounded_broadcast
from socialcart.operators.token_index import bucket_of

GRAM = 3
RAREST = 3
BUCKETS = 64


def grams(text: Column, size: int) -> Column:
    """Distinct character n-grams of ``text`` (none if it is shorter)."""
    starts = F.sequence(F.lit(1), F.length(text) - (size - 1))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(size))))) \
        .otherwise(F.array().cast("array<string>"))


def build_gram_index(docs: DataFrame, id_col: str, text_col: str, path: str, buckets: int = BUCKETS) -> "GramIndex":
    """Index the lower-cased ``text_col`` (NULL as empty) below ``path``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text")).withColumn(
        "bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    texts.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/texts")
    stored = spark.read.schema(texts.schema).parquet(f"{path}/texts")
    every = F.concat(*[grams(F.col("text"), n) for n in range(1, GRAM + 1)])
    postings = stored.select("id", F.explode(every).alias("gram")).withColumn("bucket", bucket_of(F.col("gram"), buckets))
    (postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram", "id")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings"))
    counts = spark.read.schema(postings.schema).parquet(f"{path}/postings").groupBy("bucket", "gram").agg(
        F.count(F.lit(1)).alias("df"))
    (counts.hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/frequencies"))
    return GramIndex(spark, path, buckets, postings.schema, counts.schema, texts.schema)


class GramIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int, postings, frequencies, texts):
        self.path, self.buckets = path, buckets
        self.postings = spark.read.schema(postings).parquet(f"{path}/postings")
        self.frequencies = spark.read.schema(frequencies).parquet(f"{path}/frequencies")
        self.texts = spark.read.schema(texts).parquet(f"{path}/texts")

    def _pruned(self, table: DataFrame, wanted: DataFrame, bucket: Column) -> DataFrame:
        """``table`` without the buckets that nobody asks for."""
        asked = [r[0] for r in wanted.select(bucket.alias("b")).distinct().collect()]
        return table.where(F.col("bucket").isin(asked)) if len(asked) < self.buckets else table

    def _asked(self, keywords: DataFrame) -> DataFrame:
        """(keyword, gram, n): the grams whose postings answer a keyword."""
        short = keywords.where(F.length("keyword") < GRAM).select("keyword", F.col("keyword").alias("gram"), F.lit(1).alias("n"))
        pairs = keywords.where(F.length("keyword") >= GRAM).select("keyword", F.explode(grams(F.col("keyword"), GRAM)).alias("gram"))
        known = self._pruned(self.frequencies, pairs, bucket_of(F.col("gram"), self.buckets)).select("gram", "df")
        # a trigram that no text has is the rarest of all
        counted = pairs.join(known, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        place = F.row_number().over(Window.partitionBy("keyword").orderBy("df", "gram"))
        rare = counted.withColumn("place", place).where(F.col("place") <= RAREST)
        n = F.least(F.lit(RAREST), F.size(grams(F.col("keyword"), GRAM)))
        return short.unionByName(rare.select("keyword", "gram", n.alias("n")))

    def search(self, keywords: DataFrame, id_name: str = "id") -> DataFrame:
        """``(keyword, <id_name>)`` of all texts that contain a keyword."""
        wanted = keywords.select("keyword").where(F.col("keyword").isNotNull()).distinct()
        asked = self._asked(wanted.where("keyword <> ''"))
        rows = self._pruned(self.postings, asked, bucket_of(F.col("gram"), self.buckets))
        # at most RAREST grams a keyword: as small as the keywords themselves
        met = rows.join(bounded_broadcast(asked), "gram").groupBy("keyword", "id").agg(
            F.count(F.lit(1)).alias("met"), F.max("n").alias("n"))
        found = met.where(F.col("met") == F.col("n")).select("keyword", "id")
        texts = self._pruned(self.texts, found.where(F.length("keyword") >= GRAM),
                             F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int")).select("id", "text")
        out = found.where(F.length("keyword") < GRAM).unionByName(
            found.where(F.length("keyword") >= GRAM).join(texts, "id").where(F.contains("text", "keyword")).select("keyword", "id"))
        if wanted.where("keyword = ''").limit(1).count():
            out = out.unionByName(self.texts.select(F.lit("").alias("keyword"), "id"))
        return out.select("keyword", F.col("id").alias(id_name))
