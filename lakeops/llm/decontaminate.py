"""Benchmark decontamination by greedy string tiling.

A tile is a run of at least ``min_match`` tokens that a text shares with a
benchmark item, where no token of either lies in two tiles. Greedy string
tiling repeatedly marks the longest match between unmarked tokens; the
running Karp-Rabin variant looks matches up by rolling hashes of the current
search length. Tiles may come in any order, so reordered passages count. A
text is contaminated when tiles cover at least ``threshold`` of an item.

In Spark: every run of ``min_match`` tokens is a seed. Texts give up the
seeds that a bit map of the benchmark's seeds lets through, with the runs of
tokens those seeds cover (no tile lies outside them). An item is looked up by
few of its seeds: going from the seed most texts hold to the rarest, seeds are
left out as long as all those left out cover less than ``threshold`` of the
item. A text that holds left-out seeds alone cannot reach it, so the join on
the others misses no pair, and a phrase that very many texts and items share
lists none. The pairs found are bounded by the tokens that all their shared
seeds cover, and tiled if that bound allows.

Tokens are runs of letters and digits, lowered; in scripts written without
spaces every character is one. An item of fewer than ``min_match`` tokens is
its own seed: it is found where it occurs whole in a text of which it makes
up at least ``threshold`` (a few common words inside a long text prove nothing).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, few_or_shuffled, free_name, slices, text_or_empty, utf8, written

# Scripts written without spaces (Thai, Lao, Tibetan, Burmese, Khmer, kana, Han)
UNSEGMENTED = "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0002fa1f"
WORD = re.compile(rf"[^\W{UNSEGMENTED}]+|[{UNSEGMENTED}]")
GAP = 0                      # between the covered runs of a text; no token has this value
MAP_BITS = 1 << 24           # 2 MB; a benchmark that fills the map only lets more seeds through
_ODD = 0x9E3779B97F4A7C15    # odd multiplier of the rolling hash


def _token(word: str) -> int:
    return (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1) or 1


def tokens(text: str | None, memo: dict) -> np.ndarray:
    """Lower-cased words as 63-bit values, never GAP."""
    words = WORD.findall((text or "").lower())
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def seeds(values: np.ndarray, length: int) -> np.ndarray:
    """Rolling hash of every run of ``length`` tokens."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out *= np.uint64(_ODD)
        out += values[k:k + n]
    out ^= out >> np.uint64(29)
    return out


def item_seeds(values: np.ndarray, min_match: int) -> np.ndarray:
    """An item's seeds by position; a short item is one seed, unlike those of any other length."""
    n = len(values)
    if n >= min_match:
        return seeds(values, min_match)
    return seeds(values, n) ^ np.uint64(n * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) if n else np.zeros(0, np.uint64)


def _bit(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = (hashes * np.uint64(_ODD)) >> np.uint64(64 - MAP_BITS.bit_length() + 1)
    return (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def tile(text: list[int], item: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles ``(text position, item position, length)``, longest first.

    Of matches of equal length the one earliest in the item, then in the
    text, is marked first. GAP never matches.
    """
    free_text, free_item = [True] * len(text), [True] * len(item)
    tiles: list[tuple[int, int, int]] = []
    search = max(min_match, 32)
    while True:
        queue = [(-n, i, t) for n, i, t in _matches(text, item, free_text, free_item, search)]
        heapq.heapify(queue)
        while queue:
            n, i, t = heapq.heappop(queue)
            free = [free_item[i + k] and free_text[t + k] for k in range(-n)]
            if all(free):
                tiles.append((t, i, -n))
                free_item[i:i - n] = free_text[t:t - n] = [False] * -n
                continue
            # what a longer tile left of this match is a match of its own
            for unmarked, group in groupby(range(-n), free.__getitem__):
                rest = list(group) if unmarked else []
                if len(rest) >= search:
                    heapq.heappush(queue, (-len(rest), i + rest[0], t + rest[0]))
        if search == min_match:
            return tiles
        search = max(min_match, search // 2)


def _matches(text, item, free_text, free_item, search):
    """Maximal matches of at least ``search`` unmarked tokens, as (length, item position, text position)."""
    starts: dict[int, list[int]] = {}
    for at, key in _rolling(item, free_item, search):
        starts.setdefault(key, []).append(at)
    found, inside = [], set()
    for at, key in _rolling(text, free_text, search) if starts else ():
        for other in starts.get(key, ()):
            if (other, at) in inside:
                continue
            n = 0
            while (other + n < len(item) and at + n < len(text) and item[other + n] == text[at + n]
                   and free_item[other + n] and free_text[at + n]):
                inside.add((other + n, at + n))
                n += 1
            if n >= search:
                found.append((n, other, at))
    return found


def _rolling(values, free, length):
    """Karp-Rabin hashes of the runs of ``length`` unmarked tokens, rolled along."""
    top = pow(_ODD, length, 1 << 64)
    key, run = 0, 0
    for at, value in enumerate(values):
        if not free[at] or value == GAP:
            key, run = 0, 0
            continue
        key, run = (key * _ODD + value) & 0xFFFFFFFFFFFFFFFF, run + 1
        if run > length:
            key = (key - values[at - length] * top) & 0xFFFFFFFFFFFFFFFF
        if run >= length:
            yield at - length + 1, key


def squeeze(text: list[int], longest: int, periods: int = 8) -> list[int]:
    """``text`` with long runs of a repeated phrase of up to ``periods`` tokens shortened to ``longest`` and two phrases.

    An item of ``longest`` tokens takes no more than so many out of a run, so
    nothing that its tiles could use is lost; a text of one word a million
    times is tiled like a short one.
    """
    for period in range(1, periods + 1):
        if len(text) <= longest + 2 * period:
            break
        values = np.array(text, np.int64)
        same = np.concatenate((np.zeros(period, bool), values[period:] == values[:-period]))
        same &= values != GAP
        at = np.arange(len(values))
        since = at - np.maximum.accumulate(np.where(same, -1, at))       # repeated tokens up to here
        keep = since < longest + period
        if keep.all():
            continue
        # whole phrases go, so what follows the run still follows the same token of the phrase
        ends = np.flatnonzero(same & ~np.concatenate((same[1:], [False])))
        for end in ends.tolist():
            over = int(since[end]) - (longest + period) + 1
            if over > 0:
                keep[end - over + 1:end + 1] = True
                cut = over // period * period
                keep[end - over + 1:end - over + 1 + cut] = False
        text = values[keep].tolist()
    return text


def coverage(text: list[int], item: list[int], min_match: int) -> tuple[float, int]:
    """Share of the item's tokens in tiles, and the number of tiles."""
    tiles = tile(squeeze(text, 2 * len(item) + min_match), item, min_match)
    return sum(t[2] for t in tiles) / max(1, len(item)), len(tiles)


def _benchmark_tokens(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item, tokens)`` of the items that have any."""
    kind = benchmark.schema[item_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(_token)
        for batch in slices(batches):
            lists = [tokens(t, memo).view(np.int64) for t in batch.column(1).to_pylist()]
            keep = pa.array([len(x) > 0 for x in lists])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int64()))],
                                             ["item", "tokens"]).filter(keep)

    return benchmark.select(F.col(item_col).alias("item"), text_or_empty(text_col).alias("text")).mapInArrow(
        run, f"item {kind}, tokens array<long>")


def _item_seeds(items: DataFrame, min_match: int) -> DataFrame:
    """``(hash, item, size, pos)`` of every seed of every item; rows of one item id and text are one item."""
    kind = items.schema["item"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [np.array(x, np.int64).view(np.uint64) for x in batch.column(1).to_pylist()]
            hashes = [item_seeds(x, min_match) for x in rows]
            owner = np.repeat(np.arange(len(rows)), [len(h) for h in hashes])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*hashes, np.zeros(0, np.uint64)]).view(np.int64)), batch.column(2).take(pa.array(owner)),
                 pa.array(np.array([len(x) for x in rows], np.int32)[owner]),
                 pa.array(np.concatenate([np.arange(len(h), dtype=np.int32) for h in hashes] + [np.zeros(0, np.int32)]))],
                ["hash", "key", "size", "pos"])

    return items.select("item", "tokens", "key").mapInArrow(run, "hash long, key long, size int, pos int")


def probe_positions(frequency: list[int], size: int, min_match: int, threshold: float) -> list[int]:
    """The seed positions by which an item must be looked up, given how many texts hold each.

    Left out are the most frequent ones whose tokens together stay under the threshold.
    """
    length, covered, left_out = min(min_match, size), [False] * size, set()
    reached = 0
    for at in sorted(range(len(frequency)), key=lambda i: (-frequency[i], i)):
        more = [k for k in range(at, at + length) if not covered[k]]
        if reached + len(more) >= threshold * size:
            break
        for k in more:
            covered[k] = True
        reached += len(more)
        left_out.add(at)
    return [at for at, n in enumerate(frequency) if n and at not in left_out]


def _probes(item_seed_rows: DataFrame, texts: DataFrame, min_match: int, threshold: float) -> DataFrame:
    """``(hash, key)``: the seeds by which each item is looked up."""
    held = texts.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    told = item_seed_rows.join(held, "hash", "left").groupBy("key", "size").agg(
        F.sort_array(F.collect_list(F.struct("pos", "hash", F.coalesce("n", F.lit(0)).alias("n")))).alias("seeds"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, hashes = [], []
            for key, size, rows in zip(*(batch.column(k).to_pylist() for k in range(3))):
                for at in probe_positions([r["n"] for r in rows], size, min_match, threshold):
                    keys.append(key)
                    hashes.append(rows[at]["hash"])
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(keys, pa.int64())], ["hash", "key"])

    return told.mapInArrow(run, "hash long, key long").distinct()


def _seed_map(seed_rows: DataFrame) -> bytes:
    """Bit map of the benchmark's seeds; its size is fixed, whatever the benchmark's."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros(MAP_BITS // 8, np.uint8)
        for batch in batches:
            byte, bit = _bit(batch.column(0).to_numpy().view(np.uint64))
            np.bitwise_or.at(full, byte, bit)
        used = np.flatnonzero(full)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(full[used].astype(np.int32))], ["byte", "bits"])

    full = np.zeros(MAP_BITS // 8, np.uint8)
    parts = (seed_rows.select("hash").mapInArrow(run, "byte long, bits int")
             .groupBy("byte").agg(F.bit_or("bits").alias("bits")).toPandas())
    full[parts["byte"].to_numpy(np.int64)] = parts["bits"].to_numpy(np.uint8)
    return full.tobytes()


def _text_seeds(docs: DataFrame, text_col: str, min_match: int, threshold: float, seed_map: bytes) -> DataFrame:
    """``(digest, n, hashes, covered)`` of the texts with a seed in the map; ``n`` counts the text's tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, known = Memo(_token), np.frombuffer(seed_map, np.uint8)
        for batch in slices(batches):
            keep, sizes, hashes, covered = [], [], [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                values = tokens(text, memo)
                inside, held = np.zeros(len(values) + 1, np.int32), []
                # seeds of short items count only in texts that they can make up the threshold of
                short = range(1, min_match) if len(values) * threshold <= min_match - 1 else ()
                for length in (*short, min_match):
                    own = seeds(values, length)
                    if length < min_match:
                        own = own ^ np.uint64(length * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
                    byte, bit = _bit(own)
                    hit = np.flatnonzero(known[byte] & bit)
                    if len(hit):
                        held.append(own[hit])
                        np.add.at(inside, hit, 1)
                        np.add.at(inside, hit + length, -1)
                if not held:
                    continue
                inside = np.cumsum(inside[:-1]) > 0
                runs = np.where(inside, values, np.uint64(GAP))
                # one gap between runs is enough
                runs = runs[inside | np.concatenate(([False], inside[:-1]))]
                keep.append(at)
                sizes.append(len(values))
                hashes.append(np.unique(np.concatenate(held)).view(np.int64))
                covered.append(runs.view(np.int64))
            if keep:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keep)), pa.array(sizes, pa.int64()), pa.array(hashes, pa.list_(pa.int64())),
                     pa.array(covered, pa.list_(pa.int64()))], ["digest", "n", "hashes", "covered"])

    digest = F.unhex(F.sha2(utf8(text_or_empty(text_col)), 256)).alias("digest")
    return docs.select(digest, text_or_empty(text_col).alias("text")).mapInArrow(
        run, "digest binary, n long, hashes array<long>, covered array<long>")


def judged(text: list[int], size: int, hashes: np.ndarray, item: list[int], min_match: int, threshold: float) -> tuple[float, int]:
    """Coverage and tiles of a pair; (0, 0) where the shared seeds or, for a short item, the text rule it out."""
    own = item_seeds(np.array(item, np.int64).view(np.uint64), min_match)
    length = min(min_match, len(item))
    inside = np.zeros(len(item) + 1, np.int32)
    at = np.flatnonzero(np.isin(own, hashes))
    np.add.at(inside, at, 1)
    np.add.at(inside, at + length, -1)
    if np.count_nonzero(np.cumsum(inside[:-1])) < threshold * len(item):
        return 0.0, 0
    if len(item) < min_match and len(item) < threshold * size:
        return 0.0, 0
    return coverage(text, item, length)


def candidate_pairs(texts: DataFrame, seed_rows: DataFrame, min_match: int, threshold: float) -> DataFrame:
    """``(digest, key)`` of the texts and items that may reach the threshold."""
    probes, _ = written(_probes(seed_rows, texts, min_match, threshold), "probes")
    # Spark sizes exploded texts by their table: they are never the side to broadcast
    return (texts.select("digest", F.explode("hashes").alias("hash")).join(few_or_shuffled(probes), "hash")
            .select("digest", "key").distinct())


def tiled_pairs(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                item_text: str = "text", min_match: int = 5, threshold: float = 0.5) -> DataFrame:
    """``(digest, item, coverage, tiles)`` of distinct texts and items with coverage of ``threshold`` or more."""
    # rows that share an item id are items of their own
    items = _benchmark_tokens(benchmark, item_col, item_text).withColumn("key", F.monotonically_increasing_id())
    items, _ = written(items, "items")
    seed_rows, _ = written(_item_seeds(items, min_match), "item-seeds")
    found, _ = written(_text_seeds(docs, text_col, min_match, threshold, _seed_map(seed_rows)), "text-seeds")
    texts, _ = written(found.dropDuplicates(["digest"]), "text-seeds")
    pairs, _ = written(candidate_pairs(texts, seed_rows, min_match, threshold), "pairs")
    # the texts' runs of tokens take far more memory than their compressed table, by which Spark sizes them
    joined = (pairs.join(items, "key").join(texts.hint("merge"), "digest").select("digest", "item", "n", "hashes", "covered", "tokens"))
    kind = items.schema["item"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            done = [judged(text, n, np.array(hashes, np.int64).view(np.uint64), item, min_match, threshold)
                    for n, hashes, text, item in zip(*(batch.column(k).to_pylist() for k in range(2, 6)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c for c, _ in done], pa.float64()),
                 pa.array([n for _, n in done], pa.int32())], ["digest", "item", "coverage", "tiles"])

    return (joined.mapInArrow(run, f"digest binary, item {kind}, coverage double, tiles int")
            .where((F.col("coverage") >= threshold) & (F.col("tiles") > 0)))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", min_match: int = 5,
                  threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: id, ``contaminated``, ``item`` covered most, its ``coverage`` and ``tiles``, and ``items``.

    ``items`` counts the benchmark items covered by ``threshold`` or more; of
    equal coverages the smallest item is named. Clean rows have NULL item, 0
    coverage, 0 tiles and 0 items. Texts and items without words (NULL,
    empty) match nothing; for items shorter than ``min_match`` tokens see the
    module. Copies
    are tiled once and repeated rows each get their row; an empty table on
    either side gives clean rows or no rows; other columns are not read.
    """
    pairs = tiled_pairs(docs, benchmark, text_col, item_col, item_text, min_match, threshold)
    most = F.min(F.struct(-F.col("coverage"), F.col("item"), F.col("tiles")))
    best, _ = written(pairs.groupBy("digest").agg(most.alias("m"), F.count(F.lit(1)).cast("int").alias("items"))
                      .select("digest", F.col("m.item").alias("item"), (-F.col("m.col1")).alias("coverage"),
                              F.col("m.tiles").alias("tiles"), "items"), "tiled")
    digest = F.unhex(F.sha2(utf8(text_or_empty(text_col)), 256))
    rows = docs.select(F.col(id_col).alias("id"), digest.alias("digest"))
    return (rows.join(best, "digest", "left")
            .select(F.col("id").alias(id_col), F.col("items").isNotNull().alias("contaminated"), "item",
                    F.coalesce("coverage", F.lit(0.0)).alias("coverage"), F.coalesce("tiles", F.lit(0)).alias("tiles"),
                    F.coalesce("items", F.lit(0)).alias("items")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    item_text: str = "text", min_match: int = 5, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    pairs = tiled_pairs(docs, benchmark, text_col, item_col, item_text, min_match, threshold)
    told = free_name(docs, "digest")
    bad, _ = written(pairs.select(F.col("digest").alias(told)).distinct(), "tiled")
    digest = F.unhex(F.sha2(utf8(text_or_empty(text_col)), 256))
    return docs.withColumn(told, digest).join(bad, told, "left_anti").select(*map(_quoted, docs.columns))


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


__all__ = ["contamination", "clean_documents", "tiled_pairs", "tile", "coverage"]
