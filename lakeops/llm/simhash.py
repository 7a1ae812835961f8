"""SimHash near-duplicate groups by multi-index hashing.

A document's fingerprint has 64 bits; a bit is set if over half of its
shingle hashes set it. Two fingerprints link when they differ in at most
``max_bits`` bits; groups are the connected components of the links.

Links are found over the *distinct* fingerprints. The fingerprint is cut
into segments. Pigeonhole: with ``max_bits = s * q + a`` over ``s`` segments,
two linked fingerprints agree up to ``q`` bits in one of the first ``a + 1``
segments, or up to ``q - 1`` bits in one of the others. The table indexes
every fingerprint by its exact segment values; every fingerprint probes the
Hamming ball of that radius around its own segments, fetches the table
matches and verifies the complete distance.

A segment value can be shared by very many different fingerprints (a large
group of near copies). Values with more than ``heavy`` fingerprints leave
the segment index; every fingerprint that probes one is linked through the
ball around the *whole* fingerprint instead: two fingerprints are within
``max_bits`` bits exactly when a ball of radius floor(max_bits / 2) around
one meets a ball of the remaining radius around the other. Members of one
meeting point hang on its smallest member, so no pairs are listed. For an
even ``max_bits`` a shared meeting point proves the link; for an odd one the
two radii differ by one and are kept apart by role.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import few_or_shuffled, free_name, slices, text_or_empty, utf8, written
from .components import connected_components

BITS = 64


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one UTF-8 text as an unsigned integer.

    A-Z are lowered, words are runs without ASCII white space, shingles are
    ``shingle`` words joined by one space, repeats included; fewer words make
    one shingle of them all; no word (NULL, empty, blank) gives zero.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - ends[0]) if len(words) == 1 else np.concatenate(([0], ends[:-1]))
    count = len(words) - shingle + 1
    stops = (ends - 1)[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:count].tolist(), stops)),
                         np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 8192):
        part = np.ascontiguousarray(hashes[at:at + 8192]).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        for low in range(0, len(bits), 255):      # byte counters cannot overflow
            ones += bits[low:low + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shingle: int = 3, seed: int = 42, digest: bool = False) -> DataFrame:
    """``(id, fp)`` per row, ``fp`` the fingerprint's bits as a signed long; on demand ``digest``, the text's SHA-256."""
    kind = docs.schema[id_col].dataType
    extra = [_digest(text_col).alias("digest")] if digest else []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = [fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), *batch.columns[2:]],
                ["id", "fp", *batch.schema.names[2:]])

    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType()),
                           *[T.StructField("digest", T.BinaryType()) for _ in extra]])
    return (docs.select(F.col(id_col).alias("id"), utf8(F.col(text_col)).alias("text"), *extra)
            .mapInArrow(run, schema))


def _digest(text_col: str):
    return F.unhex(F.sha2(utf8(text_or_empty(text_col)), 256))


def segment_plan(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """``(shift, width, radius)`` per segment; radius -1: the segment need not be searched."""
    whole, rest = divmod(max_bits, segments)
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i], whole if i <= rest else whole - 1) for i in range(segments)]


def _masks(width: int, radius: int, least: int = 0) -> list[int]:
    """Bit masks of ``least`` to ``radius`` set bits, as signed longs."""
    made = [sum(1 << b for b in bits) for n in range(least, radius + 1) for bits in combinations(range(width), n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in made]


def _flips(value, masks: list[int]):
    return F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: value.bitwiseXOR(m)))


def _segment(fp, shift: int, width: int):
    return F.shiftrightunsigned(fp, shift).bitwiseAND((1 << width) - 1)


def hamming_links(fps: DataFrame, max_bits: int = 2, segments: int = 2, heavy: int = 64) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of "at most ``max_bits`` bits apart".

    ``fps`` has one column ``fp`` of distinct longs. Every edge joins two
    fingerprints within ``max_bits`` bits, and any two such fingerprints are
    connected through edges.
    """
    table, probes = [], []
    for no, (shift, width, radius) in enumerate(segment_plan(max_bits, segments)):
        if radius < 0:
            continue
        value = _segment(F.col("fp"), shift, width)
        table.append(fps.select(F.lit(no).alias("seg"), value.alias("key"), F.col("fp").alias("b")))
        probes.append(fps.select(F.col("fp").alias("a"), F.lit(no).alias("seg"),
                                 _flips(value, _masks(width, radius)).alias("key")))
    index, probe = table[0], probes[0]
    for t, p in zip(table[1:], probes[1:]):
        index, probe = index.unionAll(t), probe.unionAll(p)
    crowded = (index.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > heavy).select("seg", "key"))
    crowded, _ = written(crowded, "crowded")
    light = index.join(crowded, ["seg", "key"], "left_anti")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # Spark sizes an exploded side by the rows it came from and would broadcast the balls: both sides are shuffled
    found = (probe.join(light.hint("merge"), ["seg", "key"]).where((F.col("a") != F.col("b")) & (apart <= max_bits))
             .select("a", "b"))
    reach = probe.join(crowded, ["seg", "key"], "left_semi").select(F.col("a").alias("fp")).distinct()
    return found.unionAll(_ball_links(reach, max_bits))


def _ball_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links through meeting points of two balls; linear in the fingerprints.

    Even bound: all members of a point are pairwise within the bound, so they
    hang on the smallest. Odd bound: members of the inner ball (radius q) are
    within 2q of each other and within 2q + 1 of those of the outer ball.
    """
    inner = max_bits // 2
    near = fps.select(F.col("fp").alias("a"), _flips(F.col("fp"), _masks(BITS, inner)).alias("point"))
    least = near.groupBy("point").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1 or %d = 1" % (max_bits % 2))
    least = least.hint("merge")                   # the balls are never broadcast, whatever Spark takes their size for
    edges = near.join(least, "point").where("a <> b").select("a", "b")
    if max_bits % 2:
        far = fps.select(F.col("fp").alias("a"),
                         _flips(F.col("fp"), _masks(BITS, inner + 1, inner + 1)).alias("point"))
        edges = edges.unionAll(far.join(least, "point").where("a <> b").select("a", "b"))
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, seed: int = 42, segments: int = 2, heavy: int = 64) -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links, the row's own
    included; a NULL id never becomes one unless its whole group has none.
    NULL, empty and blank texts share fingerprint zero. Rows that repeat an id
    stay separate rows of the result. Other columns are never read; an empty
    table gives an empty result. ``heavy`` only chooses between two exact ways.
    """
    rows, _ = written(with_fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    of_fp = _groups(rows, max_bits, segments, heavy).select("fp", "component_id")
    return (rows.join(of_fp.hint("merge"), "fp")
            .select(F.col("id").alias(id_col),
                    F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def _groups(rows: DataFrame, max_bits: int, segments: int, heavy: int) -> DataFrame:
    """``(fp, component, component_id)`` per distinct fingerprint; ``component`` names the group even without ids."""
    fps, _ = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fps")
    groups = connected_components(hamming_links(fps.select("fp"), max_bits, segments, heavy), "a", "b")
    placed = fps.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return placed.join(smallest, "component").select("fp", "component", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  max_bits: int = 2, seed: int = 42, segments: int = 2, heavy: int = 64) -> DataFrame:
    """One row of ``docs`` per group, with all its columns: that of the group's smallest id, or without id if none has one.

    Rows are told apart by id and text, so rows without an id and rows that
    repeat an id stay if their texts are in different groups. If a group's
    smallest id has several texts in it, the one with the smallest SHA-256
    stays; of rows equal in id and text one stays.
    """
    rows, _ = written(with_fingerprints(docs, id_col, text_col, shingle, seed, digest=True), "fingerprints")
    placed, _ = written(_groups(rows, max_bits, segments, heavy), "groups")
    # equal texts have equal fingerprints: id and digest together name one group
    counted, _ = written(rows.groupBy("id", "digest", "fp").agg(F.count(F.lit(1)).alias("copies"))
                         .join(placed.hint("merge"), "fp").select("id", "digest", "copies", "component", "component_id"), "placed-rows")
    first = (counted.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("component")
             .agg(F.min("digest").alias("first")))
    first, _ = written(first, "group-firsts")
    keys = counted.join(first, "component").select(
        "id", "digest", "copies", (F.col("id").eqNullSafe(F.col("component_id")) & (F.col("digest") == F.col("first"))).alias("stays"))
    # the keys of rows to drop, and of those that repeat id and text: no other row need move
    keys, _ = written(keys.where("not stays or copies > 1").select("id", "digest", "stays"), "dropped")
    told = free_name(docs, "digest")
    marked = docs.withColumn(told, _digest(text_col))

    def met(some: DataFrame, how: str) -> DataFrame:
        return marked.join(some, marked[id_col].eqNullSafe(some["id"]) & (marked[told] == some["digest"]), how)

    rest = met(few_or_shuffled(keys.select("id", "digest")), "left_anti").drop(told)
    repeated = few_or_shuffled(keys.where("stays").select("id", "digest"))
    if not repeated.limit(1).count():
        return rest
    return rest.unionAll(met(repeated, "left_semi").dropDuplicates([id_col, told]).drop(told))


__all__ = ["one_per_group", "fingerprint", "with_fingerprints", "hamming_links", "near_duplicates", "segment_plan"]
