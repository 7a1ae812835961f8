"""Packing documents into fixed windows by minimum bin slack.

A document of many windows fills whole ones by itself; its rest (its
*remaining length*, under one window) is packed with others. All that
packing needs of the corpus is how many rests have each length, at most
``capacity`` numbers however many documents there are. The plan is made from
that histogram on the driver:

* a window takes the longest rest left; a subset-sum dynamic program over
  the lengths left finds the multiset that fills the remaining slack
  closest. The reachable sums are the bits of one integer, a length with
  its count is a few shifts, and counts are read by going back through the
  kept states;
* the multiset is used for as many windows as the counts allow, so one run
  of the program serves very many equal windows;
* a slack that no multiset fills is filled by cutting the longest rest: its
  first tokens close the window, what is left is a rest again;
* what cannot fill a window is packed into windows of powers of two.

So nothing is padded, and rests are cut only where no multiset fits.

A rest's place follows from its length and its rank among the rests of that
length. Ranks come from a range sort of slim rows (a length that a third of
all documents share is spread over many tasks); the token ids join on a
unique row key.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, slices, slices_by_bytes, text_or_empty, written
from .pieces import encoder
from .ranges import Runs, carries, in_order, running_sum
from .token_files import id_width


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum is closest to ``room`` from below.

    Of equal sums the one that the longest lengths reach first.
    """
    reach, mask, kept = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n, c in counts.items() if c > 0 and n <= room), reverse=True):
        kept.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:                                  # 1, 2, 4, ... copies: all numbers of copies up to the count
            take = min(step, left)
            reach |= reach << take * length & mask
            left, step = left - take, 2 * step
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(kept):
        copies = 0
        while not before >> total & 1:
            total -= length
            copies += 1
        if copies:
            chosen[length] = copies
    return chosen


def plan_windows(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Where the rests go: rows ``rest, rank, n, start, length, j, copies, sequence, offset``, sorted by rest and rank.

    A row places ``n`` pieces, of the rests of length ``rest`` with ranks
    from ``rank`` on: tokens ``start`` to ``start + length``. Piece i is
    number ``j + i`` of its kind, of which each window from ``sequence`` on
    takes ``copies``, one after the other from ``offset`` on.
    """
    counts = {length: n for length, n in histogram.items() if length > 0 and n > 0}
    # rests of each length left: runs of neighbouring ranks that have lost the same first tokens
    left = {length: deque([(length, 0, n, 0)]) for length, n in counts.items()}
    total, sequence, rows = sum(length * n for length, n in counts.items()), 0, []

    def take(length: int, n: int, used: int, copies: int, offset: int) -> None:
        """Use the first ``used`` tokens of ``n`` rests of ``length``, ``copies`` in each window."""
        j = 0
        counts[length] -= n
        while n:
            rest, rank, have, start = left[length].popleft()
            now = min(n, have)
            if now < have:
                left[length].appendleft((rest, rank + now, have - now, start))
            rows.append((rest, rank, now, start, used, j, copies, sequence, offset))
            if used < length:
                counts[length - used] = counts.get(length - used, 0) + now
                left.setdefault(length - used, deque()).append((rest, rank, now, start + used))
            n, j = n - now, j + now
        if not counts[length]:
            del counts[length], left[length]

    while counts:
        size = capacity if total >= capacity else 1 << total.bit_length() - 1
        longest = max(counts)
        if longest >= size:                          # only where a window is smaller than a rest left over
            take(longest, 1, size, 1, 0)
            sequence, total = sequence + 1, total - size
            continue
        counts[longest] -= 1
        use = best_fill(counts, size - longest)
        counts[longest] += 1
        use[longest] = use.get(longest, 0) + 1
        slack = size - sum(length * n for length, n in use.items())
        cut = max((n for n, c in counts.items() if c > use.get(n, 0)), default=0) if slack else 0
        needed = {**use, cut: use.get(cut, 0) + 1} if cut else use
        windows = min(counts[length] // n for length, n in needed.items()) if size == capacity else 1
        offset = 0
        for length in sorted(use, reverse=True):
            take(length, windows * use[length], length, use[length], offset)
            offset += length * use[length]
        if cut:
            take(cut, windows, slack, 1, offset)
        sequence, total = sequence + windows, total - windows * size
    return np.array(sorted(rows), np.int64).reshape(-1, 9)


def places(plan: np.ndarray, rest: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces ``row, start, length, sequence, offset`` of rows sorted by rest, their ranks consecutive in each rest."""
    found = [np.zeros((0, 5), np.int64)]
    values, first = np.unique(rest, return_index=True)
    for value, at, until in zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(rest)]):
        a, b = np.searchsorted(plan[:, 0], (value, value + 1))
        low, high = int(rank[at]), int(rank[at]) + until - at
        rows = plan[a:b]
        for _, from_rank, n, start, length, j, copies, sequence, offset in rows[
                (rows[:, 1] < high) & (rows[:, 1] + rows[:, 2] > low)].tolist():
            ranks = np.arange(max(low, from_rank), min(high, from_rank + n))
            no = j + ranks - from_rank
            found.append(np.column_stack([at + ranks - low, np.full(len(ranks), start), np.full(len(ranks), length),
                                          sequence + no // copies, offset + no % copies * length]))
    pieces = np.concatenate(found)
    return tuple(pieces[np.lexsort((pieces[:, 1], pieces[:, 0]))].T)


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> tuple[DataFrame, str, str]:
    """``(key, id, n, ids)`` per row, written: a unique key, and the ids as little-endian integers of the returned width."""
    width = id_width(tokenizer)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, size = encoder(tokenizer), np.dtype(width).itemsize
        for batch in slices_by_bytes(batches, 2):
            ids, counts = pieces.encode_column(batch.column(2))
            ends = np.cumsum(counts)
            ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
            offsets = np.concatenate(([0], ends * size)).astype(np.int64)
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [
                None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(width))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts + 1), packed.cast(pa.binary())],
                                             ["key", "id", "n", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    tokens, path = written(rows.mapInArrow(run, f"key long, id {kind}, n long, ids binary"), "packed-ids", compression="zstd")
    return tokens, path, width


def _placed(tokens: DataFrame, capacity: int) -> DataFrame:
    """``(key, whole, cuts)``: a document's first whole window and, four numbers each, the pieces of its rest."""
    sizes = tokens.select("key", "id", (F.col("n") % capacity).alias("rest"), (F.col("n") / capacity).cast("long").alias("full"))
    counted = {r["rest"]: r["c"] for r in sizes.groupBy("rest").agg(F.count(F.lit(1)).alias("c")).collect()}   # <= capacity rows
    plan = plan_windows(counted, capacity)

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held, whole = Runs(), 0, 0
        for batch in slices(batches, 8192):
            start, on = runs.cut(batch.column(1).to_numpy())
            ranks = running_sum(np.ones(batch.num_rows, np.int64), start, on, held)
            full = batch.column(2).to_numpy()
            wholes = np.cumsum(full) + whole
            held, whole = int(ranks[-1]), int(wholes[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ranks), pa.array(wholes), pa.array(runs.rows(batch.num_rows)),
                 pa.array(np.zeros(batch.num_rows, np.int64))],
                ["key", "rest", "full", "part", "rank", "wholes", "row", "one"])

    ordered = in_order(sizes, "rest", "id", "key").select("key", "rest", "full", "part")
    ranked, _ = written(ordered.mapInArrow(rank, "key long, rest long, full long, part int, rank long, wholes long, row long, one long"),
                        "ranks")
    in_rest = carries(ranked, "rest", ["rank"], lambda a, b: (a[0] + b[0],))
    # whole windows run through all partitions: one key
    in_all = carries(ranked, "one", ["wholes"], lambda a, b: (a[0] + b[0],))
    for carry, on, name in ((in_rest, "rest", "rank"), (in_all, "one", "wholes")):
        if carry is not None:
            ranked = (ranked.join(carry, ["part", on], "left")
                      .withColumn(name, F.col(name) + F.coalesce(f"c_{name}", F.lit(0))).drop(f"c_{name}"))
    total_whole = ranked.agg(F.sum("full")).first()[0] or 0
    plan[:, 7] += total_whole

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            rest, ranks = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            order = np.lexsort((ranks, rest))
            # neighbouring ranks only: a batch may hold the end of one partition and the start of another
            gaps = np.flatnonzero((np.diff(rest[order]) == 0) & (np.diff(ranks[order]) != 1)) + 1
            for part in np.split(order, gaps):
                row, start, length, sequence, offset = places(plan, rest[part], ranks[part] - 1)
                sizes = np.bincount(row, minlength=len(part))
                flat = np.column_stack([start, length, sequence, offset]).reshape(-1)
                cuts = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes) * 4)).astype(np.int32)), pa.array(flat))
                taken = pa.array(part)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(3).take(taken), cuts],
                                                 ["key", "whole", "cuts"])

    return (ranked.select("key", "rest", "rank", (F.col("wholes") - F.col("full")).alias("whole"))
            .mapInArrow(place, "key long, whole long, cuts array<long>"))


def packed_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The pieces of all documents: id, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit
    integers. A document's tokens are those of the library for the whole
    text, without added special tokens, then ``end_id``; ``start`` counts
    its ids before the piece and ``doc_tokens`` all of them. A sequence is
    ``capacity`` ids long, or a power of two below it, without gaps.

    NULL text counts as empty and is one id long. Rows that repeat an id or
    a text are documents of their own; NULL ids are kept. The result depends
    on the rows only, but for the order of rows equal in id and length.
    Other columns are not read; an empty table has no pieces. ``capacity``
    is a power of two.
    """
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")
    tokens, _, width = encoded(docs, tokenizer, end_id, id_col, text_col)
    slots, _ = written(_placed(tokens, capacity), "slots")
    kind = docs.schema[id_col].dataType.simpleString()
    size = np.dtype(width).itemsize

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, 1):
            own = batch.column(1).to_pylist()
            ids = np.frombuffer(b"".join(own), width).astype("<u4")
            n = np.fromiter(map(len, own), np.int64, len(own)) // size
            full = n // capacity
            whole, cuts = batch.column(2).to_numpy(), batch.column(3)
            per = cuts.value_lengths().to_numpy().astype(np.int64) // 4
            rest = cuts.flatten().to_numpy().reshape(-1, 4)
            # pieces row by row: whole windows, then those of the rest
            row = np.repeat(np.arange(len(own)), full + per)
            first = np.cumsum(full + per) - full - per
            no = np.arange(len(row)) - first[row]
            is_whole = no < full[row]
            start, length = no * capacity, np.full(len(row), capacity)
            sequence, offset = whole[row] + no, np.zeros(len(row), np.int64)
            start[~is_whole] = (full * capacity)[row[~is_whole]] + rest[:, 0]
            length[~is_whole], sequence[~is_whole], offset[~is_whole] = rest[:, 1], rest[:, 2], rest[:, 3]
            bounds = pa.py_buffer(np.concatenate(([0], np.cumsum(length) * 4)).astype(np.int64))
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, bounds, pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), packed.cast(pa.binary()),
                 pa.array(n[row]), pa.array(sequence), pa.array(offset)],
                [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return (tokens.select("key", "id", "ids").join(slots, "key").select("id", "ids", "whole", "cuts")
            .mapInArrow(cut, f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"))


def write_sequences(pieces: DataFrame, path: str) -> None:
    """Parquet of whole sequences from ``packed_pieces``: ``sequence_id, ids``, ordered by sequence.

    Pieces of a sequence meet in one row of at most ``capacity`` ids.
    """
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("hex")))),
                                      lambda p: p["hex"]), "")
    (pieces.groupBy("sequence_id").agg(F.unhex(joined).alias("ids"))
     .repartitionByRange(n, "sequence_id").sortWithinPartitions("sequence_id").write.parquet(path))


__all__ = ["best_fill", "plan_windows", "packed_pieces", "write_sequences"]
