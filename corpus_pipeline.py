"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, benchmark decontamination, SentencePiece encoding.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame. ``run`` writes each stage's result to the
shared scratch folder and rereads it as the next stage's documents, so a
lost executor repeats tasks of one stage only; scratch tables of finished
stages are removed. All stages but the last
return the columns of ``documents``.

Documents may have any further columns; a name that a stage needs for itself
gives way to theirs. Only the last stage adds columns: a document's column of
the same name is found there under that name and an underscore.

Rows are rejected for one reason each: a text in which no language can be
told (no letter at all), a copy, a near copy of a document with a smaller
id, a text that covers half of a benchmark item. Nothing else is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import decontaminate, exact_dedup, language_id, sentencepiece_nbest, simhash
from lakeops.llm.common import free_name, scratch_scope, written
from lakeops.llm.queries import BEST, vocabulary
from lakeops.session import delete_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; ``lang`` becomes the predicted one.

    Texts without a letter (NULL and empty among them) are rejected. If no
    row is labelled there is nothing to learn: texts with a letter stay, with
    the ``lang`` they have.
    """
    model = language_id.train(docs)
    if model is None:
        return docs.where(F.rlike(F.col("text"), F.lit(language_id.HAS_LETTER)))
    label, score = free_name(docs, "predicted"), free_name(docs, "score")
    told = language_id.predict(docs, model, label=label, score=score)
    kept = told.where(F.col(label) != language_id.UNDETERMINED)
    return kept.withColumn("lang", F.col(label)).drop(label, score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    with exact_dedup.DigestIndex(spark) as index:
        return exact_dedup.kept_documents(docs, index)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays."""
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ADDED = ("piece_ids", "nbest", "decoded", "n_tokens")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: its columns but the text, the piece ids, the best segmentations, and the decoding check."""
    for name in [c for c in docs.columns if c.lower() in ADDED]:
        docs = docs.withColumnRenamed(name, free_name(docs, f"{name}_"))
    coded = sentencepiece_nbest.encode_nbest(docs, vocabulary("piece_bpe_32k.model"), BEST, ids="piece_ids", keep_text=False)
    return coded.withColumn("n_tokens", F.size("piece_ids").cast("long"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark) as scratch:         # what the stage stored on its way goes with it
            docs, path = written(stage(spark, docs, sf_dir), f"stage-{name}")
            scratch.remove(path)
        if before:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
