"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Ids are replaced by their frequency rank, so the most common 256 take one
byte and the next 65,280 two. Four ids share one control byte (two bits
each: bytes minus one); control bytes and data bytes are stored apart, so a
block is decoded without branches: table lookups turn control bytes into
lengths, a running sum into positions, and a gather into ids.

A file is a Parquet part of blocks in ascending id order: any store Spark
can write to will do, and a lost task rewrites only its own part. Each block
holds whole documents: their ids, their token counts, the control bytes and
the data bytes; ``codebook`` beside the blocks holds the rank table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop, slices, slices_by_bytes, text_or_empty, written
from .pieces import encoder

BLOCK_IDS = 1 << 16          # a block closes at the document that reaches so many ids

# lengths of the four ids of a control byte, and their sum
LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
TOTALS = LENGTHS.sum(axis=1)
KEEP = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)    # bytes of an id by its length - 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values; the last group is padded with zeros."""
    full = np.zeros(-(-len(values) // 4) * 4, np.uint32)
    full[:len(values)] = values
    length = (full > 0xFF).astype(np.uint8) + (full > 0xFFFF) + (full > 0xFFFFFF)
    code = length.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    planes = full.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = planes[np.arange(4, dtype=np.uint8) <= length[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of ``pack``."""
    code = np.frombuffer(control, np.uint8)
    length = LENGTHS[code].reshape(-1)[:n]
    start = np.zeros(n, np.int64)
    np.cumsum(length[:-1], out=start[1:])
    padded = np.frombuffer(data + b"\0\0\0\0", np.uint8)
    words = np.lib.stride_tricks.as_strided(padded, (len(padded) - 3, 4), (1, 1))
    return words[start].copy().view("<u4").reshape(-1) & KEEP[length - 1]


def id_width(tokenizer: str) -> str:
    """Unsigned integer type, little-endian, that holds every id of the tokenizer."""
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int | None, id_col: str, text_col: str,
                     width: str) -> DataFrame:
    """``(id, ids)`` per row: the library's ids, then ``end_id``, as integers of type ``width``."""
    extra = 0 if end_id is None else 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(tokenizer)
        for batch in slices_by_bytes(batches, 1):
            ids, counts = pieces.encode_column(batch.column(1))
            ends = np.cumsum(counts)
            if extra:
                ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
            size = np.dtype(width).itemsize
            offsets = np.concatenate(([0], ends * size)).astype(np.int64)
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [
                None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(width))])
            yield pa.RecordBatch.from_arrays([batch.column(0), packed.cast(pa.binary())], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, ids binary"))


def id_counts(tokens: DataFrame, width: str) -> DataFrame:
    """``(token, n)`` over the ``ids`` of all rows, added up within tasks first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in slices(batches):
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), width)
            counts = np.bincount(ids, minlength=len(total))
            counts[:len(total)] += total
            total = counts
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], ["token", "n"])

    return (tokens.select("ids").mapInArrow(run, "token long, n long")
            .groupBy("token").agg(F.sum("n").alias("n")))


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int | None = 2, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Encode every row's whole text and write ``path/blocks`` and ``path/codebook``.

    NULL text counts as empty. Rows go to the files in ascending id order,
    NULL ids first; rows that repeat an id are ordered by their token ids.
    The codebook has a row per id that occurs, so its size is bounded by the
    tokenizer's vocabulary; it is the only thing that visits the driver. An
    empty table writes an empty file set.
    """
    spark = docs.sparkSession
    width = id_width(tokenizer)
    size = np.dtype(width).itemsize
    tokens, tokens_path = written(encode_documents(docs, tokenizer, end_id, id_col, text_col, width), "token-ids",
                                  compression="zstd")
    counted = sorted((-r["n"], r["token"]) for r in id_counts(tokens, width).collect())
    ranked = np.array([token for _, token in counted], np.uint32)
    rank = np.zeros(int(ranked.max()) + 1 if len(ranked) else 1, np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    (spark.createDataFrame([(r, int(t)) for r, t in enumerate(ranked)], "rank long, token long")
     .coalesce(1).write.parquet(f"{path}/codebook"))

    def block(part: int, no: int, rows: list, id_type: pa.DataType) -> pa.RecordBatch:
        control, data = pack(rank[np.frombuffer(b"".join(ids for _, ids in rows), width)])
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([no], pa.int64()),
             pa.array([[doc for doc, _ in rows]], pa.list_(id_type)),
             pa.array([[len(ids) // size for _, ids in rows]], pa.list_(pa.int64())),
             pa.array([control], pa.binary()), pa.array([data], pa.binary())],
            ["part", "block", "doc_ids", "lengths", "control", "data"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, rows, held, part, id_type = 0, [], 0, 0, None
        for batch in slices(batches):
            id_type, part = batch.schema.field(0).type, batch.column(2)[0].as_py()
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows.append((doc, ids))
                held += len(ids) // size
                if held >= BLOCK_IDS:
                    yield block(part, no, rows, id_type)
                    no, rows, held = no + 1, [], 0
        if rows:
            yield block(part, no, rows, id_type)

    kind = tokens.schema["id"].dataType.simpleString()
    schema = f"part int, block long, doc_ids array<{kind}>, lengths array<long>, control binary, data binary"
    tie = F.xxhash64("ids").alias("tie")
    ordered = (tokens.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("id"), tie)
               .sortWithinPartitions(F.col("id"), F.xxhash64("ids")))
    (ordered.withColumn("part", F.spark_partition_id()).mapInArrow(run, schema)
     .write.option("compression", "none").parquet(f"{path}/blocks"))
    drop(docs, tokens_path)


def read_token_files(spark: SparkSession, path: str, id_name: str = "doc_id") -> DataFrame:
    """Per document of the files, in their order: id, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is the
    unsigned CRC-32 of its ids as little-endian unsigned 32-bit integers. All
    three come from the decoded files.
    """
    token = np.array([r["token"] for r in spark.read.parquet(f"{path}/codebook").orderBy("rank").collect()], "<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    # ids before each block: parts first (one row per part), then within a part
    held = blocks.select("part", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = held.groupBy("part").agg(F.sum("n").alias("n"))
    before_part = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("p"))
    within = held.select("part", "block", (F.sum("n").over(Window.partitionBy("part").orderBy("block"))
                                           - F.col("n")).alias("b"))
    starts = within.join(before_part, "part").select("part", "block", (F.col("p") + F.col("b")).alias("at"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            lengths = np.array(row["lengths"], np.int64)
            ids = token[unpack(row["control"], row["data"], int(lengths.sum()))].tobytes()
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(ids[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * len(lengths), pa.int32()), pa.array([row["block"]] * len(lengths), pa.int64()),
                 batch.column(batch.schema.get_field_index("doc_ids")).flatten(), pa.array(ends - lengths),
                 pa.array(lengths), pa.array(crc, pa.int64())],
                ["part", "block", "id", "offset", "n_tokens", "ids_crc32"])

    decoded = blocks.mapInArrow(run, f"part int, block long, id {kind}, offset long, n_tokens long, ids_crc32 long")
    return (decoded.join(starts, ["part", "block"])
            .select(F.col("id").alias(id_name), (F.col("at") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))


def read_token_ids(spark: SparkSession, path: str, id_name: str = "doc_id") -> DataFrame:
    """``(id, ids array<int>)`` of every document in the files."""
    token = np.array([r["token"] for r in spark.read.parquet(f"{path}/codebook").orderBy("rank").collect()], "<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            lengths = np.array(row["lengths"], np.int64)
            ids = token[unpack(row["control"], row["data"], int(lengths.sum()))].astype(np.int32)
            bounds = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_ids")).flatten(),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids))], ["id", "ids"])

    return (blocks.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_name))


__all__ = ["pack", "unpack", "write_token_files", "read_token_files", "read_token_ids", "encode_documents"]
