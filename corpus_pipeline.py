"""The corpus pipeline: stages over `documents`, each written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all
but the last return the columns of documents, whatever else they hold: columns are named
by place within, so extra ones may clash in all but their exact names.  Null ids and texts,
empty and very long texts, repeated rows and empty tables pass through every stage as its
operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import materialize, need, positional, read_table, release, written
from eventloom.llm.decontaminate import find_leaks
from eventloom.llm.language import UNKNOWN, held_out, identify, train
from eventloom.llm.line_dedup import dedup_lines
from eventloom.llm.near_dedup import near_duplicates
from eventloom.llm.piece_bpe import encode_decode
from eventloom.llm.queries import digest_pieces, tokenizer_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language: a null text, or one without letters.

    Without a label to learn from, only that is looked at.
    """
    need(docs, "doc_id", "text", "lang")
    frame, at = positional(docs)
    model = train(frame.where(~held_out(F.col(at["doc_id"]))), at["text"], at["lang"])
    if not model.languages:
        return frame.where(F.col(at["text"]).rlike(r"\p{L}")).toDF(*docs.columns)
    return identify(frame, model, at["text"]).where(F.col("lang_pred") != UNKNOWN).select(*frame.columns).toDF(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines found in ten documents or more; documents stay, if need be with an empty text."""
    need(docs, "doc_id", "text")
    frame, at = positional(docs)
    out = dedup_lines(frame, at["doc_id"], at["text"], min_docs=10, min_chars=1)
    if "n_chars" in at:
        out = out.withColumn(at["n_chars"], F.char_length(at["text"]).cast(docs.schema["n_chars"].dataType))
    return out.select(*frame.columns).toDF(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) keep the document of least id.

    Documents without an id or a word stay.  Rows that share an id are one document: they stay or go together.
    """
    need(docs, "doc_id", "text")
    frame, at = positional(docs)
    found = near_duplicates(frame, size=5, threshold=0.8, id_col=at["doc_id"], text_col=at["text"])
    gone = found.where("not kept").select(F.col("doc_id").alias("__el_gone")).distinct()
    return frame.join(gone, F.col(at["doc_id"]).cast("long") == F.col("__el_gone"), "left_anti").toDF(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that give away a test item."""
    need(docs, "text")
    frame, at = positional(docs)
    out = find_leaks(frame, read_table(spark, sf_dir, "benchmark"), at["text"])
    return out.where(F.size("leaks") == 0).select(*frame.columns).toDF(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left, and decode it again."""
    need(docs, "doc_id", "text")
    frame, at = positional(docs)
    slim = frame.select(F.col(at["doc_id"]).alias("doc_id"), F.col(at["text"]).alias("text"))
    return digest_pieces(encode_decode(slim, tokenizer_path("piece_bpe_32k.model")))


STAGES = [("language", language_stage), ("lines", line_stage), ("near_duplicates", near_stage), ("benchmark", benchmark_stage), ("pieces", encode_stage)]

#: SQL can't express the sketches' and the encoder's stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, others = read_table(spark, sf_dir, "documents"), set(written(spark))
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark, but=others | {written(spark)[-1]})  # all that the stage was made from
    return STAGES[-1][1](spark, docs, sf_dir)
