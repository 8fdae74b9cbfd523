"""Chat formatting: transcripts with missing or mixed speaker markers →
turns with roles → one canonical form.

``fit`` counts, over all labelled conversations outside the held-out fold, how
lines of each role look and follow each other (sums of a few hundred cells);
``parse`` recovers the roles of every transcript by Viterbi (``speaker_hmm``);
``canonical`` writes turns as ``<|im_start|>role`` blocks, with the markers'
characters in the text defused.  A transcript is handled by itself.

The test table has turns, not transcripts, so the query writes transcripts
first, in six styles, with some markers left out (``write_transcripts``).  A
conversation is written in sections of at most ``SECTION`` turn numbers, so no
group is unbounded.

Defined cases: null text is an empty turn (it leaves no line, so it cannot be
recovered); a null conversation id makes each row a transcript of its own;
turns without a number are sections of their own, by hash; rows repeated with
all values equal are one turn; of turns with one number the order is by role,
then text; roles other than system, user and assistant are written without a
marker; without labelled turns the model knows only its prior; other columns
are not looked at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, scratch_table
from .language_id import fold
from .speaker_hmm import SpeakerModel, count_turns, split_turns

SECTION = 256

# How the styles name the roles, before and after the name.
STYLES = [
    ("", ": ", {"system": "System", "user": "User", "assistant": "Assistant"}),
    ("", ": ", {"system": "Instructions", "user": "Human", "assistant": "AI"}),
    ("### ", "\n", {"system": "System", "user": "User", "assistant": "Assistant"}),
    ("<|", "|>\n", {"system": "system", "user": "user", "assistant": "assistant"}),
    ("**", ":** ", {"system": "System", "user": "Customer", "assistant": "Agent"}),
    ("", ": ", {"system": "Context", "user": "Q", "assistant": "A"}),
]
UNMARKED_OF_20 = 3  # so many turns of twenty have no marker

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _marker(style: Column, role: Column) -> Column:
    out = F.lit("")
    for i, (before, after, names) in enumerate(STYLES):
        for name, word in names.items():
            out = F.when((style == i) & (role == name), before + word + after).otherwise(out)
    return out


def write_transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, section, turns, transcript): turns as (role, text, written),
    in order; transcript joins what is written."""
    text = F.coalesce("text", F.lit(""))
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                               F.col("role").cast("string").alias("role"), text.alias("text")).distinct()
    lone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    section = F.when(F.col("turn").isNull(), -1 - F.pmod(F.xxhash64("text"), F.lit(64))).otherwise(
        F.floor(F.col("turn") / SECTION))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(20)) < UNMARKED_OF_20
    # a turn without a marker is set off by a blank line, others mostly are
    tight = ~bare & (F.pmod(F.xxhash64("turn", "conv_id"), F.lit(10)) < 3)
    written = F.concat(F.when(tight, "").otherwise("\n"), F.when(bare, "").otherwise(_marker(style, F.col("role"))), F.col("text"))
    own = own.withColumns({"lone": lone, "section": section, "written": written})
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "written")))
    return (own.groupBy("conv_id", "lone", "section").agg(turns.alias("turns"))
            .select("conv_id", "section", "turns", F.array_join(F.col("turns.written"), "\n").alias("transcript")))


def fit(transcripts: DataFrame) -> SpeakerModel:
    """(turns) with known roles → the model; the driver gets one number for
    each cell of the model's tables."""
    def run(batches):
        for batch in batches:
            counts: dict[tuple[int, int, int], int] = {}
            for turns in batch.column(0).to_pylist():
                count_turns([(t["role"], t["written"]) for t in turns], counts)
            keys = list(counts)
            yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.int32()) for i in range(3)),
                                              pa.array(list(counts.values()), pa.int64())], names=["t", "i", "j", "n"])

    cells = map_arrow(transcripts.select("turns"), run, "t int, i int, j int, n long").groupBy("t", "i", "j").agg(F.sum("n").alias("n"))
    return SpeakerModel.from_counts({(r.t, r.i, r.j): r.n for r in cells.collect()})


def parse(transcripts: DataFrame, model: SpeakerModel, text_col: str = "transcript", out_col: str = "parsed") -> DataFrame:
    """``transcripts`` with ``out_col``: the turns (role, text) of each; null
    text has none.  All other columns are kept."""
    sent = transcripts.sparkSession.sparkContext.broadcast(model)
    kind = "array<struct<role:string,text:string>>"
    arrow = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    packed = transcripts.select(F.struct(*transcripts.columns).alias("row"), F.col(text_col).alias("t"))

    def run(batches):
        for batch in batches:
            found = [[{"role": r, "text": x} for r, x in split_turns(sent.value, t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, arrow)], names=["row", "turns"])

    schema = f"row {packed.schema['row'].dataType.simpleString()}, turns {kind}"
    return map_arrow(packed, run, schema).select("row.*", F.col("turns").alias(out_col))


def canonical(turns: Column) -> Column:
    """The canonical text of (role, text) turns."""
    def block(t: Column) -> Column:
        safe = F.replace(F.replace(t["text"], F.lit(OPEN), F.lit("<| im_start|>")), F.lit(CLOSE), F.lit("<| im_end|>"))
        return F.concat(F.lit(OPEN), t["role"], F.lit("\n"), safe, F.lit(CLOSE + "\n"))

    return F.array_join(F.transform(turns, block), "")


def format_conversations(conversations: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Write transcripts of all conversations, learn from those outside the
    held-out fold, recover all.  Per transcript: conv_id, section, held_out,
    n_turns, roles, formatted, and whether the roles are those of the table."""
    own = scratch_table(write_transcripts(conversations), "transcripts")
    out = fold(F.col("conv_id"), folds) == held_out
    model = fit(own.where(~out))
    done = parse(own.select("conv_id", "section", out.alias("held_out"), F.col("turns.role").alias("true_roles"), "transcript"), model)
    roles = F.col("parsed.role")
    return done.select("conv_id", "section", "held_out", F.size("parsed").cast("long").alias("n_turns"), roles.alias("roles"),
                       canonical(F.col("parsed")).alias("formatted"), roles.eqNullSafe(F.col("true_roles")).alias("roles_match"))
