"""URL filters: rules by host and path, and for URLs that no rule fits a
logistic regression on hashed character n-grams.

Rules.  A rule (host, path, verdict) fits its host and all subdomains if the
URL's path starts with the rule's path; of the rules that fit, the longest
(host and path together) decides, then the longer host, then "block".  The
rules' shapes (labels of the host, characters of the path) are few, whatever
the number of rules, so a URL asks for one key a shape and the rules are found
by equi-joins on keys: no URL is compared with a rule that does not fit.  Keys
are counted before the join, so a host with a third of all URLs meets each rule
once and is joined back without one task that holds all its rows.

Model.  Host and path give 3- to 5-grams of bytes in ``BUCKETS`` buckets
(``url_ngrams``).  The weights are learned on the driver from the labelled
URLs: at most ``MAX_LABELLED`` of them, chosen by the hash of the URL.  Scoring
is one pass of numpy over Arrow batches; the broadcast weights have a fixed
size (2 MB).

Defined cases: host and path of a null url, or one without "://", are empty;
so no rule fits and the model scores empty parts; A-Z of the host is
lower-cased, the path stays as it is; a rule with null host or path fits
nothing; rules repeated with both verdicts block; rows repeated with one id
are judged one by one; without labelled URLs each score is 0.5 and a URL passes
(scores above ``threshold`` block); an empty table gives an empty table; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_by_key, lower_ascii, map_arrow, scratch_table
from .url_ngrams import features, fit_logistic, margins, sigmoid

MAX_LABELLED = 20_000
#: Distinct (labels, path characters) of the rules; more are refused.
MAX_SHAPES = 4096
THRESHOLD = 0.5


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host in lower case, path) of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")  # a null url has no place, either
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return lower_ascii(host), path


def _shape(host: Column, path: Column) -> tuple[Column, Column]:
    return F.size(F.split(host, r"\.")), F.length(path)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(rid, rule, verdict) of the URLs (rid, host, path) that a rule fits.
    ``urls`` is read more than once, so give a stored table."""
    known = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        lower_ascii(F.col("host")).alias("host"), "path", "verdict")
    labels, chars = _shape(F.col("host"), F.col("path"))
    shapes = known.select(labels.alias("labels"), chars.alias("chars")).distinct().limit(MAX_SHAPES + 1).collect()
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"the rules have more than {MAX_SHAPES} shapes of host and path")
    own_labels, own_chars = _shape(F.col("host"), F.col("path"))
    keys = [F.when((own_labels >= s["labels"]) & (own_chars >= s["chars"]),
                   F.struct(F.substring_index("host", ".", -s["labels"]).alias("host"),
                            F.substring("path", 1, s["chars"]).alias("path"))) for s in shapes]
    if not keys:
        return urls.select("rid", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    # asked and found: stored, since counting and joining read them
    asked = scratch_table(urls.select("rid", F.explode(F.array_compact(F.array(*keys))).alias("key")), "url-keys")
    order = F.struct(F.length(F.concat("host", "path")).alias("length"), F.length("host").alias("host_length"), "verdict",
                     F.concat("host", "path").alias("rule"))
    # "block" sorts after "allow"
    rule = known.groupBy(F.struct("host", "path").alias("key")).agg(F.max(order).alias("rule"))
    found = scratch_table(asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(rule, "key"), "url-rules")
    best = join_by_key(asked, found, "key", "n", asked.count()).where("found is not null")
    return best.groupBy("rid").agg(F.max("found.rule").alias("best")).select("rid", "best.rule", "best.verdict")


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> np.ndarray:
    """Weights learned from labelled URLs (label 1: block).  Beyond
    ``MAX_LABELLED`` rows those with the least hashes are taken."""
    host, path = url_parts(F.col(url_col))
    rows = labelled.where(F.col(label_col).isNotNull()).select(host.alias("host"), path.alias("path"), F.col(label_col).alias("label"))
    rows = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(MAX_LABELLED).collect()
    found = features([r["host"].encode() for r in rows], [r["path"].encode() for r in rows])
    return fit_logistic(*found, np.array([r["label"] for r in rows], float))


def score_urls(urls: DataFrame, weights: np.ndarray) -> DataFrame:
    """``urls`` (with host and path) and ``score``: the probability that the
    URL is one to block."""
    sent = urls.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    names = urls.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch.column(names.index(c)).cast(pa.binary()).to_pylist() for c in ("host", "path")]
            score = sigmoid(margins(sent.value, *features(*parts), batch.num_rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*names, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
    return map_arrow(urls, run, f"{kinds}, score double")


def judge(pages: DataFrame, rules: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (null if none fits),
    ``verdict`` ("allow" or "block") and the model's ``score``."""
    host, path = url_parts(F.col(url_col))
    urls = scratch_table(pages.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                                      host.alias("host"), path.alias("path")), "urls")
    ruled = match_rules(urls, rules)
    scored = score_urls(urls, fit(labelled)).join(ruled, "rid", "left")
    own = F.when(F.col("score") > threshold, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "score")
