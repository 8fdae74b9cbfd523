"""Bloom filters as DataFrames: rows of (word, bits), 64 bits to a word.

A key's bits lie in one word, so a probe is one broadcast lookup and one mask
comparison, all in generated code.  The number of words is bounded, so what
is broadcast is (16 bytes a word); a fuller filter only lets more keys through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
PROBES = 3
MAX_WORDS = 2 ** 21


def filter_words(keys: int, bits_per_key: int = BITS_PER_KEY, max_words: int = MAX_WORDS) -> int:
    """Words of a filter for so many keys."""
    return min(max_words, 2 ** max(4, math.ceil(math.log2(max(1, keys * bits_per_key / 64)))))


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bits(key: Column) -> list[Column]:
    """The bit numbers of a key inside its word: PROBES six-bit slices of a
    second hash."""
    h = F.xxhash64(key, F.lit(1))
    return [F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(PROBES)]


def fill(keys: DataFrame, key: str, words: int, least: int = 1) -> DataFrame:
    """The filter of ``keys``: a bit is set if at least ``least`` rows hit
    it, counted per (word, bit) with partial aggregation."""
    hits = keys.select(_word(F.col(key), words).alias("word"),
                       F.explode(F.array_distinct(F.array(*_bits(F.col(key))))).alias("bit"))
    if least > 1:
        hits = hits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return hits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def probe(rows: DataFrame, table: DataFrame, key: str, words: int, name: str = "_possible") -> DataFrame:
    """``rows`` with a boolean ``name``: all bits of the key are set."""
    mask = F.lit(0).cast("long")
    for b in _bits(F.col(key)):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))
    out = rows.withColumn("_word", _word(F.col(key), words)).withColumn("_mask", mask)
    out = out.join(F.broadcast(table.select(F.col("word").alias("_w"), F.col("bits").alias("_b"))),
                   F.col("_word") == F.col("_w"), "left")
    hit = F.coalesce(F.col("_b").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    return out.select(*[F.col(c) for c in rows.columns], hit.alias(name))
