"""One registered query per operator, each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_formatting import format_conversations
from .common import load
from .decontamination import leaks
from .exact_dedup import exact_copies
from .html_extraction import extract
from .language_id import identify
from .lm_scoring import score
from .merkle import leaf_digest, verify
from .near_dedup import near_copies
from .packing import pack
from .periodic_runs import find_runs, run_digests
from .quality import classify
from .url_filter import judge
from .url_labels import RULES, labelled_urls
from .warc import archive_round_trip


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(load(spark, sf_dir, "pages"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(load(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_conversations(load(spark, sf_dir, "conversations"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(load(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(load(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(load(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(load(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf, changed = leaf_digest(*fields), leaf_digest(*fields[:-1], F.replace("text", F.lit("\n"), F.lit("")))
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    return verify(docs, leaf, F.when(tampered, changed).otherwise(leaf))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(load(spark, sf_dir, "pages"), rules, spark.createDataFrame(labelled_urls(), "url string, label int"))


def tile_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The periodic tail that a tenth of the documents get, chosen and shaped
    by the checksum of the id; a document without id stays as it is."""
    checksum, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or not n or checksum % 10:
        return words
    g = checksum // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + (words[start:start + period] * ((n - start) // period + 1))[:n - start]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(find_runs(load(spark, sf_dir, "documents"), rewrite=tile_tail))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = [op1_html_extraction, op2_exact_dedup, op3_packing, op4_quality, op5_chat_formatting, op6_lm_scoring,
           op7_near_dedup, op8_warc, op9_decontamination, op10_language_id, op11_merkle_manifest, op12_url_filter, op13_periodic_runs]
    return {f.__name__: f for f in ops}
