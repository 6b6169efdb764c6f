"""Line dedup: drop lines that stand in many documents.

Lines are exploded, their normalised keys hashed, documents counted for each hash,
and lines of frequent keys dropped; the rest is reassembled by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, hash128, materialize, need, others, positional, row_key

#: Frequent keys that are sent to every task: at some 100 bytes each in a hashed table, 50 MB.
BROADCAST_KEYS = 500_000


def _key(line: Column) -> Column:
    return F.btrim(ascii_lower(line), F.lit(SPACE))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Return every input row with its text less the lines whose key stands in `min_docs` documents or more.

    The result has all input columns, with `text_col` replaced, plus `n_lines` (before
    dropping) and `n_dropped`; input columns of these two names are replaced, in whatever case;
    other names may differ in case alone.

    A document is a row: rows that repeat count once each.  A null or empty text is one
    empty line and becomes "".  Keys shorter than `min_chars` code points are never
    dropped.  Null ids are allowed.  An empty table gives an empty table.  A very long text is
    handled like others; only its own row and its array of lines must fit into a task.

    The count shuffles two 64-bit hashes per distinct line of a document, combined on the
    map side, so a line of a third of all documents is no hot key.  The frequent keys are
    written and counted: up to BROADCAST_KEYS they go to every task, and lines don't move at
    all; beyond, lines are joined with them by Spark, which splits hot keys.  Texts move
    once, by the row's own key.
    """
    need(docs, id_col, text_col)
    frame, at = positional(docs)
    text = F.coalesce(F.col(at[text_col]).cast("string"), F.lit(""))
    split = F.split(F.col("__el_text"), "\n", -1)
    base = frame.withColumn("__el_text", text).withColumn("__el_key", row_key(F.col(at[id_col]), F.col("__el_text")))
    slim = base.select("__el_key", F.transform(split, _key).alias("__el_lines"))
    long_enough = F.char_length("__el_line") >= min_chars

    once = slim.select(F.explode(F.array_distinct("__el_lines")).alias("__el_line")).where(long_enough)
    h1, h2 = hash128(F.col("__el_line"))
    counted = once.groupBy(h1.alias("__el_h1"), h2.alias("__el_h2")).count()
    frequent = materialize(counted.where(F.col("count") >= min_docs).select("__el_h1", "__el_h2"), "frequent-lines")
    if frequent.count() <= BROADCAST_KEYS:
        frequent = F.broadcast(frequent)

    lines = slim.select("__el_key", F.posexplode("__el_lines").alias("__el_pos", "__el_line")).where(long_enough)
    gone = (
        lines.select("__el_key", "__el_pos", h1.alias("__el_h1"), h2.alias("__el_h2"))
        .join(frequent, ["__el_h1", "__el_h2"], "left_semi")
        .groupBy("__el_key")
        .agg(F.collect_set("__el_pos").alias("__el_gone"))
    )

    n = F.size(split)
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__el_gone"))
    text = F.when(F.col("__el_gone").isNull(), F.col("__el_text")).otherwise(F.array_join(F.transform(kept, lambda p: F.get(split, p)), "\n"))
    out = {name: place for name, place in others(at, "n_lines", "n_dropped").items() if name != text_col}
    return base.join(gone, "__el_key", "left").select(
        *(F.col(place).alias(name) for name, place in out.items()),
        text.alias(text_col),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("__el_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
