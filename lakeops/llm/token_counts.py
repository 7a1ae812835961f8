"""Token counts through a digest cache.

A stored count belongs to the pair (digest of the normalised content, digest
of the tokenizer version). Documents are joined to the cache on both; only
distinct contents without a count are encoded by the tokenizer library, and
their counts are appended. Digests meet the cache first: a delivery that the
cache knows moves no text, and otherwise only misses move, one row per
distinct content (where they are too many to broadcast their digests, all
distinct contents). The join back to documents moves digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import path_exists, scratch_path

from .common import slices_by_bytes, text_or_empty, utf8, written
from .pieces import encoder, kept_in_worker


BROADCAST_MISSES = 100_000           # digests, 3 MB


def tokenizer_version(path: str) -> str:
    """SHA-256 of the tokenizer file: a changed file never meets old counts."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def load_counter(path: str):
    """``Arrow texts -> counts`` by the library that reads ``path`` (.json or .model).

    No begin, end or added special tokens, no truncation, no padding; special
    strings inside texts are handled as the library does by default.
    """
    if path.endswith(".json"):
        pieces = encoder(path, memo_words=600_000)
        return lambda texts: pieces.encode_column(texts, flat=False)[1]
    import sentencepiece
    model = kept_in_worker(f"model:{path}", lambda: sentencepiece.SentencePieceProcessor(model_file=path))
    return lambda texts: np.array([len(ids) for ids in model.encode(texts.to_pylist(), num_threads=1)], np.int64)


def count_tokens(texts: DataFrame, path: str) -> DataFrame:
    """``(digest, n_tokens)`` of ``(digest, content)`` by the library, slice by slice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load_counter(path)
        for batch in slices_by_bytes(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count(batch.column(1)))],
                                             ["digest", "n_tokens"])

    return texts.mapInArrow(run, "digest binary, n_tokens long")


class CountCache:
    """Append-only Parquet folder of ``digest, n_tokens``, one subfolder per tokenizer version."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "llm-token-counts")

    def counts(self, version: str) -> DataFrame:
        """Stored counts; concurrent writers may have stored a digest twice, with the same count."""
        where = f"{self.path}/tokenizer={version}"
        if not path_exists(self.spark, where):
            return self.spark.createDataFrame([], "digest binary, n_tokens long")
        stored = self.spark.read.schema("digest binary, n_tokens long").parquet(where)
        return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, version: str) -> None:
        counts.write.mode("append").parquet(f"{self.path}/tokenizer={version}")


def plain(text_col: str) -> Column:
    """Default normalisation, right for every tokenizer: NULL counts as empty, nothing else changes."""
    return text_or_empty(text_col)


def document_token_counts(docs: DataFrame, tokenizer: str, cache: CountCache | None = None,
                          id_col: str = "doc_id", text_col: str = "text", limit: int = 512,
                          normalise=plain) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer`` is a file path that every executor can read. ``normalise``
    maps the text column's name to the content that is hashed and encoded;
    it must not change the count (a tokenizer that drops white space may
    squeeze it). ``n_bytes`` counts the UTF-8 bytes of the text itself.
    NULL and empty texts have no tokens; repeated rows and ids are counted
    row by row; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    cache = cache or CountCache(spark)
    version = tokenizer_version(tokenizer)
    content = normalise(text_col)
    digest = F.unhex(F.sha2(utf8(content), 256))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(utf8(text_or_empty(text_col)))
                       .cast("long").alias("n_bytes"), digest.alias("digest"))
    distinct, _ = written(rows.select("digest").distinct(), "digests")
    misses, _ = written(distinct.join(cache.counts(version).select("digest"), "digest", "left_anti"), "misses")
    missed = misses.count()
    if missed:
        texts = docs.select(digest.alias("digest"), content.alias("content"))
        if missed <= BROADCAST_MISSES:
            texts = texts.join(F.broadcast(misses), "digest", "left_semi")
        # distinct map-side first, so a text in a third of all rows moves once per task
        texts = texts.dropDuplicates(["digest"])
        if missed > BROADCAST_MISSES:
            texts = texts.join(misses, "digest", "left_semi")
        cache.append(count_tokens(texts.select("digest", "content"), tokenizer), version)
    # the delivery's counts, stored: the join below then shuffles both sides and a text in very many rows can be split
    counts, _ = written(cache.counts(version).join(distinct, "digest", "left_semi"), "counts")
    return (rows.join(counts, "digest")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))


__all__ = ["CountCache", "document_token_counts", "count_tokens", "tokenizer_version"]
