"""Exact dedup: two-pass Bloom filtering.

Pass 1 fills a Bloom filter in which a bit counts as set once at least two
rows have hit it.  A text that occurs twice sets all its bits twice, so pass 2
keeps a row out of the shuffle as soon as one of its bits is not set: such a
row is alone with its text.  Only the rows that the filter lets through are
grouped by their SHA-256 and settled exactly; the rest pass straight through.

The filter is a table of 64-bit words (see ``bloom``) that rows probe with
one broadcast lookup.  Its size follows the number of rows up
to ``max_words``, which bounds what is broadcast (2**21 words, 16 bytes each
as a table).  Beyond ``max_words`` it fills up and lets more unique rows
through: they shuffle (narrow rows: id and digest) and the result is the same.

Defined cases: null text counts as empty; empty texts are copies of each
other; a null id comes after all others, so it stays only if no row of the
group has an id; of rows repeated with the same id and text one is kept
(``group_size`` counts rows); an empty table gives an empty table; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import MAX_WORDS, fill, filter_words, probe
from .common import collapse_space, join_by_key, scratch_table


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with white space collapsed."""
    return F.unhex(F.sha2(collapse_space(text).cast("binary"), 256))


def label_copies(digests: DataFrame, id_col: str = "doc_id", sha: str = "sha",
                 max_words: int = MAX_WORDS) -> DataFrame:
    """(rid, id, sha) → the same rows with ``keep_id``, ``group_size`` and
    ``kept``.  ``digests`` is read more than once, so give a stored table;
    ``rid`` tells its rows apart."""
    total = digests.count()
    words = filter_words(total, max_words=max_words)
    flagged = probe(digests, fill(digests, sha, words, least=2), sha, words)
    alone = flagged.where(~F.col("_possible")).select(
        "rid", id_col, sha, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"))
    possible = flagged.where("_possible").drop("_possible")
    first = F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("rid").alias("rid")))
    groups = possible.groupBy(sha).agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    settled = join_by_key(possible, groups, sha, "n", total).select(
        "rid", id_col, sha, F.col("found.first.id").alias("keep_id"), F.col("found.n").alias("group_size"),
        (F.col("rid") == F.col("found.first.rid")).alias("kept"))
    return alone.unionByName(settled)


def digest_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The narrow table that both passes read: row number, id and digest."""
    return scratch_table(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias(id_col),
                                     digest(F.col(text_col)).alias("sha")), "digests")


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` (lower-case hex)."""
    out = label_copies(digest_table(docs, id_col, text_col), id_col)
    return out.select(id_col, "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    The texts are read twice: once for the filter, once to apply it.  Rows
    that the filter rules out go straight to the output; the others meet by
    digest, combined inside each task first (``min_by``), so a text held by a
    third of all rows sends one row per task."""
    digests = docs.select(digest(F.col(text_col)).alias("sha"))
    words = filter_words(docs.count())
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"),
                         F.col(text_col).alias("text"), digest(F.col(text_col)).alias("sha"))
    flagged = probe(packed, scratch_table(fill(digests, "sha", words, least=2), "repeats"), "sha", words)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("text"))
    settled = flagged.where("_possible").groupBy("sha").agg(F.min_by("row", order).alias("row"))
    return flagged.where(~F.col("_possible")).select("row.*").unionByName(settled.select("row.*"))
