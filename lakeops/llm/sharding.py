"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows get global numbers in id order. A keyed Feistel network permutes the
smallest even-bit domain that holds them; numbers that land outside the
table walk the cycle until they are inside, which keeps it a permutation of
exactly ``0 .. n - 1``. Shard and slot are arithmetic on the permuted
number, so either direction can be computed without a table: sizes differ
by one at most and slots have no gaps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_or_empty, utf8, written

ROUNDS = 8


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator. Fixed values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> np.ndarray:
    steps = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mix(np.uint64(seed % 2**64) + steps)


def _feistel(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    low, h = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> h, x & low
    for k in keys:
        left, right = right, left ^ (_mix(right ^ k) & low)
    return (right << h) | left     # halves swapped: the same rounds with reversed keys invert


def permute(numbers: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Permute ``numbers`` (each in ``0 .. n - 1``) within ``0 .. n - 1``; ``inverse`` undoes it."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    keys = _keys(seed)[::-1 if inverse else 1]
    out = _feistel(numbers.astype(np.uint64), half, keys)
    outside = np.flatnonzero(out >= n)
    while len(outside):
        out[outside] = _feistel(out[outside], half, keys)
        outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def place(row: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of one global row number."""
    at = int(permute(np.array([row]), n, seed)[0])
    return at % shards, at // shards


def row_of(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The global row number that sits in a shard's slot."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def number_rows(df: DataFrame, order: list[Column], name: str = "row_number",
                partitions: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with a gapless global row number in the given order, and the row count.

    Range partitions are sorted and written once; numbers are the position
    within a partition plus the rows of the partitions before it. No task
    sees more than its partition; the offsets are one row per partition. The
    last sort key is the input position, so one key with very many rows is
    spread over partitions too; rows that tie in ``order`` should therefore
    be interchangeable.
    """
    spark = df.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = df.withColumns({f"__k{i}": c for i, c in enumerate(order)})
    keyed = keyed.withColumn("__tie", F.monotonically_increasing_id())
    names = [f"__k{i}" for i in range(len(order))] + ["__tie"]
    placed = (keyed.repartitionByRange(n, *names).sortWithinPartitions(*names).drop(*names)
              .withColumn("__at", F.monotonically_increasing_id()))
    stored, _ = written(placed, "ordered")
    part = F.shiftright("__at", 33)
    within = F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = (stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("size"))
             .orderBy("__part").collect())           # one row per partition
    total, offsets = 0, []
    for row in sizes:
        offsets.append((row["__part"], total))
        total += row["size"]
    shape = T.StructType([T.StructField("__part", T.LongType()), T.StructField("__before", T.LongType())])
    before = F.broadcast(spark.createDataFrame(offsets, shape))   # at most ``n`` rows
    return (stored.withColumn("__part", part).join(before, "__part")
            .withColumn(name, F.col("__before") + within).drop("__part", "__before", "__at")), total


def shard_rows(df: DataFrame, shards: int, order: list[Column], seed: int = 42) -> DataFrame:
    """``df`` plus ``row_number``, ``shard`` and ``slot``.

    Law ``rows``: shard sizes differ by one at most, slots run from 0 without
    gaps, and (row count, seed, order) decide every place. NULL order values
    come first; an empty table gives no rows; existing columns named like
    the three new ones are refused.
    """
    clash = {"row_number", "shard", "slot"} & set(df.columns)
    if clash:
        raise ValueError(f"columns to be added exist already: {sorted(clash)}")
    numbered, n = number_rows(df, order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = permute(batch.column("row_number").to_numpy(zero_copy_only=False), n, seed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array((at % shards).astype(np.int32)), pa.array(at // shards)],
                [*batch.schema.names, "shard", "slot"])

    schema = T.StructType([*numbered.schema.fields, T.StructField("shard", T.IntegerType()),
                           T.StructField("slot", T.LongType())])
    return numbered.mapInArrow(run, schema)


def assign_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                  seed: int = 42) -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Only ids, sizes and checksums move, not texts. Rows are numbered by id
    (NULL first), then size, checksum and SHA-256 of the text, so ties are
    copies and interchangeable: the result is the same on every run. A NULL
    text has size 16 and the checksum of the empty text; copies of a text
    are ordinary rows and may land in different shards, which the law of
    equal counts demands when one text fills a third of the table. Other
    columns are not read.
    """
    text = utf8(text_or_empty(text_col))
    slim = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("sha"))
    placed = shard_rows(slim, shards, [F.col("id"), F.col("size"), F.col("text_crc32"), F.col("sha")], seed)
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def write_shards(docs: DataFrame, path: str, shards: int = 40, id_col: str = "doc_id", seed: int = 42) -> None:
    """Write whole rows below ``path/shard=K``, each shard's files in slot order."""
    key = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    placed = shard_rows(docs, shards, [F.col(id_col), key], seed)
    (placed.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


__all__ = ["permute", "place", "row_of", "number_rows", "shard_rows", "assign_shards", "write_shards"]
