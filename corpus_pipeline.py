"""The corpus pipeline: documents in, packed training sequences out.

1. language ID: documents rejected as being in no known language go;
2. exact dedup: of equal texts the one with the least id stays;
3. MinHash near-dedup: one document of each group of near copies stays;
4. benchmark decontamination: documents that hold a test item go;
5. packing: what is left is cut into sequences of 4,096 tokens (the result is
   one row per piece, see ``socialcart.llm.packing``).

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns they got.  ``run`` writes each result
as Parquet in the shared folder and reads it as the next input, so a lost
executor costs no more than its tasks.  After each stage its handles are
collected, so that Spark drops the stage's broadcasts and shuffle files before
the next one begins.  Null texts go in stage 1 (no letter);
empty tables pass through all stages."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from socialcart.llm.common import load
from socialcart.llm.decontamination import drop_leaking
from socialcart.llm.exact_dedup import drop_exact_copies
from socialcart.llm.language_id import fit, keep_known_languages
from socialcart.llm.near_dedup import drop_near_copies
from socialcart.llm.packing import pack
from socialcart.session import checkpoint_root


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known_languages(docs, fit(docs.select("lang", "text")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaking(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

# a trained model and a tokenizer cannot be written as SQL
ORACLE_SQL = None


def _release(spark: SparkSession) -> None:
    """Spark cleans up after handles that the driver's collectors found dead;
    a driver with room left may not collect for a long time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    root = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        _release(spark)
    return docs
