"""Language ID: averaged hashed subword embeddings, linear softmax, SGD,
calibrated rejection.

Training: at most ``TRAIN_PER_LANG`` labelled documents of each language
(fewer if there are many languages: at most ``TRAIN_DOCS`` in all), the ones
with the least hash, whole texts, as counts of hashed subwords made in the
tasks.  A fifth of them calibrates: a temperature on the logits, and the
confidence below which a document is rejected: the ``REJECT_SHARE`` quantile
of the calibration documents, but at most ``REJECT_AT_MOST``, so a clear
prediction is never rejected.

Prediction: one pass over whole texts; nothing shuffles, and what is sent to
the tasks is one number for each bucket and language.

Defined cases: null text, or text without a letter, is `und` with score 0 and
is rejected; with no labelled document every text is `und`; a null id counts
as the empty text in the fold; repeated rows are predicted each; other columns
are not looked at, or pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, text_slices
from .subwords import Scorer, bucket_counts, scores, softmax, temperature, train

UNKNOWN = "und"
TRAIN_PER_LANG = 600
TRAIN_DOCS = 6000
REJECT_SHARE = 0.001
REJECT_AT_MOST = 0.5
BATCH_BYTES = 1_000_000


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def labelled_sample(rows: DataFrame, label: str, per_label: int, most: int) -> DataFrame:
    """At most ``per_label`` rows (label, text) of each label and about
    ``most`` in all, by least hash.  A first cut by a threshold on the hash,
    from the label's count, keeps the ranking small."""
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label).limit(most).collect()
    if not sizes:
        return rows.limit(0)
    take = max(1, min(per_label, most // len(sizes)))
    h = F.pmod(F.xxhash64("text"), F.lit(2 ** 32))
    share = F.coalesce(*[F.when(F.col(label) == r[label], F.lit(min(1.0, (2.0 * take + 50) / r["n"]))) for r in sizes])
    near = rows.withColumn("_h", h).where(F.col("_h") < share * F.lit(float(2 ** 32)))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", "text"))
    return near.withColumn("_r", rank).where(F.col("_r") <= take).drop("_h", "_r")


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # calibrated: one row per bucket
    reject_below: float


def fit(labelled: DataFrame, per_lang: int = TRAIN_PER_LANG, most: int = TRAIN_DOCS) -> LanguageModel:
    """Train on rows (text, lang); the driver receives the bounded sample as
    subword counts."""
    def run(batches):
        for batch in batches:
            found = [bucket_counts(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i].tobytes() for x in found], pa.binary())
                                                                 for i in range(2))], names=["lang", "buckets", "counts"])

    sample = labelled_sample(labelled.select("lang", "text").where("lang is not null and text is not null"), "lang",
                             per_lang, most)
    rows = map_arrow(sample, run, "lang string, buckets binary, counts binary").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.buckets), bytes(r.counts)))
    languages = sorted({r.lang for r in rows})
    if not languages:
        return LanguageModel([], np.zeros((1, 0)), 0.0)
    labels = np.array([languages.index(r.lang) for r in rows])
    buckets = [np.frombuffer(r.buckets, np.int32) for r in rows]
    counts = [np.frombuffer(r.counts, np.int32) for r in rows]
    held = np.arange(len(rows)) % 5 == 4  # calibrates
    some = [i for i in range(len(rows)) if not held[i]] or list(range(len(rows)))
    logits = train([buckets[i] for i in some], [counts[i] for i in some], labels[some], len(languages))
    check = [i for i in range(len(rows)) if held[i] and len(buckets[i])]
    if not check:
        return LanguageModel(languages, logits, 0.0)
    raw = scores(logits, [buckets[i] for i in check], [counts[i] for i in check])
    factor = temperature(raw, labels[check])
    sure = softmax(raw * factor).max(axis=1)
    return LanguageModel(languages, logits * factor, min(REJECT_AT_MOST, float(np.quantile(sure, REJECT_SHARE))))


def _predictor(model: LanguageModel):
    """texts, has_letter → (language, score, rejected) columns."""
    scorer = Scorer(model.logits)
    names = np.array([*model.languages, UNKNOWN], object)

    def predict(texts: list[str | None], letters: list[bool | None]):
        best = np.full(len(texts), len(model.languages))
        score = np.zeros(len(texts))
        if model.languages:
            p = softmax(scorer(texts))
            known = np.array([bool(x) for x in letters], bool)
            best = np.where(known, p.argmax(axis=1), best)
            score = np.where(known, p.max(axis=1), 0.0)
        rejected = (best == len(model.languages)) | (score < model.reject_below)
        return names[best], score, rejected

    return predict


def _has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        ask = _predictor(sent.value)
        for batch in batches:
            for at, some in text_slices(batch.column(1), BATCH_BYTES):
                lang, score, rejected = ask(some, batch.column(2).slice(at, len(some)).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(some)), pa.array(lang, pa.string()),
                                                  pa.array(score), pa.array(rejected)],
                                                 names=["doc_id", "lang_pred", "score", "rejected"])

    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).alias("t"), _has_letter(text_col))
    return map_arrow(own, run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_known_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected documents; rows pass through the tasks
    that read them, all columns kept."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.col(text_col).alias("t"), _has_letter(text_col).alias("l"), F.struct(*docs.columns).alias("row"))

    def run(batches):
        ask = _predictor(sent.value)
        for batch in batches:
            letters = batch.column(1)
            gone = [x for at, some in text_slices(batch.column(0), BATCH_BYTES) for x in ask(some, letters.slice(at, len(some)).to_pylist())[2]]
            yield batch.filter(pa.array([not x for x in gone], pa.bool_())).select(["row"])

    from pyspark.sql.types import StructType

    return map_arrow(packed, run, StructType([packed.schema["row"]])).select("row.*")


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Fit on the documents outside fold ``held_out`` and predict all."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = fit(own.where(fold(F.col("doc_id"), folds) != held_out))
    out = predict(own, model)
    return out.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score", "rejected")
