"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by the digest of the normalised
text. A delivery is reduced to one row per digest, the digests the index
does not hold yet are found by a sort-merge anti-join (the index side is
read bucket by bucket, without a shuffle) and appended. Only digests and
ids are shuffled, never texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lakeops.session import path_exists, scratch_path

from .common import few_or_shuffled, free_name, text_or_empty, utf8, written


def text_digest(text_col: str = "text") -> Column:
    """SHA-256 (binary) of the text with each run of ASCII white space as one space; NULL counts as empty.

    The pattern leaves single spaces alone: they are their own replacement.
    """
    squeezed = F.regexp_replace(text_or_empty(text_col), "[\\x20\\x09-\\x0D]{2,}|[\\x09-\\x0D]", " ")
    return F.unhex(F.sha2(utf8(squeezed), 256))


class DigestIndex:
    """The persistent index: ``digest, keep_id, batch`` under ``path``, bucketed and sorted by digest.

    The files outlive the session; opening the same path again attaches to
    them. Beside the data lies the layout they were written with (number of
    buckets, type of the ids): reopening uses it, whatever the session's
    settings, and refuses other wishes. ``buckets`` and ``id_type`` of a new
    index default to ``spark.sql.shuffle.partitions`` and ``bigint``.

    A session sees the files through a table of its own, which ``close``
    (or leaving a ``with`` block) removes; the files stay.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None,
                 id_type: str | None = None):
        self.spark = spark
        self.path = (path or scratch_path(spark, "llm-digest-index")).rstrip("/")
        self.buckets, self.id_type = self._layout(buckets, id_type)
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id {self.id_type}, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}/digests'")

    def _layout(self, buckets: int | None, id_type: str | None) -> tuple[int, str]:
        where, fields = f"{self.path}/layout", "buckets int, id_type string"
        if not path_exists(self.spark, f"{where}/_SUCCESS"):
            wanted = (buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions")), id_type or "bigint")
            self.spark.createDataFrame([wanted], fields).coalesce(1).write.parquet(where)
            return wanted
        stored = tuple(self.spark.read.schema(fields).parquet(where).first())
        for name, wish, value in (("buckets", buckets, stored[0]), ("id_type", id_type, stored[1])):
            if wish is not None and wish != value:
                raise ValueError(f"the index at {self.path} was written with {name} {value}, not {wish}")
        return stored

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def owners(self) -> DataFrame:
        """One row per digest. Writers that ran at the same time may have stored a digest twice: the smallest id owns it."""
        first = F.min(F.struct(F.col("keep_id").isNull().alias("without"), "keep_id", "batch")).alias("o")
        return self.table().groupBy("digest").agg(first).select("digest", "o.keep_id", "o.batch")

    def add(self, groups: DataFrame, batch: str) -> None:
        """Append the digests of ``groups (digest, keep_id)`` that the index does not hold."""
        fresh = groups.join(self.table().hint("merge"), "digest", "left_anti")
        (fresh.select("digest", F.col("keep_id").cast(self.id_type), F.lit(batch).alias("batch"))
         .repartition(self.buckets, "digest").write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
                batch: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    * Of equal texts the row with the smallest id stays; texts the index knew
      before keep the id stored there and nothing of this delivery stays.
    * ``group_size`` counts the rows of this delivery with that text.
    * NULL and empty texts are equal. A NULL id stays only if its whole group
      has none. Of rows that repeat both id and text exactly one is kept.
    * ``batch`` names the delivery: running the same delivery again under the
      same name gives the same result (a job may be repeated after a failure).
    * Other columns are not read, whatever their names; an empty table adds
      nothing and gives no rows.
    """
    batch = batch or uuid.uuid4().hex
    slim = docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"))
    rows, _ = written(slim.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("copies")), "digests")
    groups, _ = written(rows.groupBy("digest").agg(F.min("id").alias("keep_id"),
                                                   F.sum("copies").alias("group_size")), "digest-groups")
    index.add(groups, batch)
    # stored, and joined by merging, so that the join below shuffles both sides (Spark would size the table by its
    # compressed file, and broadcast it) and a text in very many rows can be split
    verdict, _ = written(groups.select("digest", "group_size").join(index.owners().hint("merge"), "digest"), "verdict")
    first = (F.col("batch") == batch) & F.col("id").eqNullSafe(F.col("keep_id"))
    return (rows.join(verdict.hint("merge"), "digest")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast(LongType()), F.col("copies"))))
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (first & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def kept_documents(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
                   batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows that repeat id and text, which are the same document, one stays.
    Rows are told apart by id and digest, and only the keys of rows to drop
    meet the documents: a text moves once at most, and those that repeat id
    and text (found by their count) a second time. Columns keep their names,
    whatever they are.
    """
    batch = batch or uuid.uuid4().hex
    verdict = deduplicate(docs, index, id_col, text_col, batch)
    keys, _ = written(verdict.groupBy(id_col, "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("copies"))
                      .where("not kept or copies > 1")
                      .select(F.col(id_col).alias("id"), F.unhex("text_sha256").alias("digest"), "kept"), "dropped")
    told = free_name(docs, "digest")
    marked = docs.withColumn(told, text_digest(text_col))

    def met(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        return rows.join(some, rows[id_col].eqNullSafe(some["id"]) & (rows[told] == some["digest"]), how)

    # few keys are broadcast and no text moves; many are shuffled, and with them each text once
    rest = met(marked, few_or_shuffled(keys.select("id", "digest")), "left_anti").drop(told)
    repeated = few_or_shuffled(keys.where("kept").select("id", "digest"))
    if not repeated.limit(1).count():
        return rest
    one = met(marked, repeated, "left_semi").dropDuplicates([id_col, told]).drop(told)
    return rest.unionAll(one)


__all__ = ["DigestIndex", "deduplicate", "kept_documents", "text_digest"]
