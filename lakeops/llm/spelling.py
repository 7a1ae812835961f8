"""Spelling variants by PartEnum signatures.

Two words are near if one inserted, deleted or replaced letter turns one
into the other. A word's letters with their counts are a binary vector (its
dimensions are "the i-th copy of letter c"); one edit changes it in at most
two places. PartEnum makes signatures that any two vectors within Hamming
distance k share: the dimensions are dealt into ``n`` parts, a signature is
the vector without some ``k`` of the parts, and as k differing places touch
at most k parts, the signature that leaves those out is equal. All C(n, k)
choices are enumerated, words are equi-joined on them, and candidates are
verified letter by letter.

Words that are made of the same letters share every signature without being
near, so a key also holds one half of the word: an edit in one half leaves
the other as it is (halves of the shorter word's length). A key can still
be shared by very many words. One with more than ``heavy`` is refined before
the join by what near words share besides: the word less one of its
letters, at every place (a replaced letter leaves both the same remainder,
an inserted one leaves the shorter word). A remainder has at most alphabet
times length words, whatever the corpus. Both ways are exact; ``heavy`` only
chooses between them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, slices, utf8, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DISTANCE = 2                 # places of the vector that one edit changes at most


def words_of(doc_id: str, text: str, modulus: int) -> Counter:
    """Runs of letters with A-Z lowered; of those whose checksum ``modulus`` divides, one letter is gone.

    What a run becomes may be another run of the text: all are judged as they stand there, then counted anew.
    """
    runs = Counter(RUN.findall(text.translate(LOWER)))
    lead = zlib.crc32(f"{doc_id}:".encode())
    thinned = []
    for word in runs:
        h = zlib.crc32(word.encode(), lead)
        if h % modulus == 0:
            thinned.append((word, h % len(word)))
    counts = [runs.pop(word) for word, _ in thinned]
    for (word, at), n in zip(thinned, counts):
        runs[word[:at] + word[at + 1:]] += n
    return runs


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 199,
                min_length: int = 6, min_count: int = 5, held: int = 200_000) -> DataFrame:
    """``(word, n)`` over all documents, of at least ``min_length`` letters and ``min_count`` occurrences.

    Counts are added up within a task (up to ``held`` words at a time), then by word.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in words_of(doc, text, modulus).items():
                    if len(word) >= min_length:
                        total[word] += n
            if len(total) >= held:
                yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.int64())], ["word", "n"])
                total = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def signatures(word: str, parts: int, omitted: list[tuple[int, ...]]) -> list[int]:
    """A signature per choice of parts left out: the sum of the hashes of what is in the others."""
    sums, seen = [0] * parts, Counter()
    for letter in word:
        seen[letter] += 1
        h = xxhash.xxh64_intdigest(f"{letter}{seen[letter]}")
        sums[h % parts] += h
    whole = sum(sums)
    return [(whole - sum(sums[p] for p in out)) * 0x9E3779B97F4A7C15 + no for no, out in enumerate(omitted)]


def join_keys(word: str, length: int, signs: list[int]) -> list[int]:
    """The signatures, each with either half of a word of ``length`` letters (this one, or one without one of its letters)."""
    half = length // 2
    ends = [xxhash.xxh64_intdigest(f"{length}<{word[:half]}"), xxhash.xxh64_intdigest(f"{length}>{word[len(word) - length + half:]}")]
    return [(s ^ e) & 0x7FFFFFFFFFFFFFFF for s in signs for e in ends]


def near_words(words: DataFrame, parts: int = 4, heavy: int = 64) -> DataFrame:
    """``(word, n, near, near_n)`` for every ordered pair of near words of ``words (word, n)``, each pair once."""
    if parts <= DISTANCE:
        raise ValueError(f"more than {DISTANCE} parts are needed")
    omitted = list(combinations(range(parts), DISTANCE))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            own, shorter = [], []
            for word in batch.column(0).to_pylist():
                signs = signatures(word, parts, omitted)
                own.append(join_keys(word, len(word), signs))
                shorter.append(join_keys(word, len(word) - 1, signs))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int64())),
                                              pa.array(shorter, pa.list_(pa.int64()))], ["word", "n", "own", "shorter"])

    signed, _ = written(words.mapInArrow(run, "word string, n long, own array<long>, shorter array<long>"), "signatures")
    # a word stands under the keys of its length; it looks there, and under those of one letter less
    stands = signed.select(F.explode("own").alias("key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    looks = signed.select(F.explode("own").alias("key"), "word", "n")
    looks_below = signed.select(F.explode("shorter").alias("key"), "word", "n")
    crowded, _ = written(stands.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > heavy).select("key"), "crowded")

    def verified(pairs: DataFrame) -> DataFrame:
        return pairs.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")

    all_looks = looks.withColumn("same", F.lit(True)).unionAll(looks_below.withColumn("same", F.lit(False)))
    direct = all_looks.join(stands.join(crowded, "key", "left_anti"), "key").where("not same or word > near")

    # keys of many words: what near words also share is the word less one letter
    size = F.char_length("word")
    gaps = F.array_distinct(F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(
        F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, size))))
    less = looks.join(crowded, "key", "left_semi").select("key", "word", "n", F.explode(gaps).alias("gap"))
    same = less.join(less.select("key", "gap", F.col("word").alias("near"), F.col("n").alias("near_n")), ["key", "gap"]).where("word > near")
    below = looks_below.join(crowded, "key", "left_semi").select("key", "word", "n", F.explode(gaps).alias("near"))
    longer = below.join(stands.join(crowded, "key", "left_semi"), ["key", "near"])
    once, _ = written(verified(direct).unionAll(verified(same)).unionAll(verified(longer)).distinct(), "near-words")
    return once.unionAll(once.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
                                     F.col("n").alias("near_n")))


def _roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """``(word, root)`` for every word with a form: the end of its forms, found by doubling the steps.

    A form is several times as frequent as its word, so there are no circles.
    """
    current, path = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if not current.join(onward, "root", "left_semi").limit(1).count():
            return current
        following, next_path = written(current.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")), "roots")
        drop(current, path)
        current, path = following, next_path
    raise RuntimeError("forms did not end")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 199,
                      min_length: int = 6, min_count: int = 5, ratio: int = 5, parts: int = 4, heavy: int = 64) -> DataFrame:
    """Per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``form`` is the near word of the largest count (ties: the smallest in
    code-point order) if that is at least ``ratio`` times the word's own,
    else NULL; ``root`` follows forms to the last, the word itself without one.

    Of words seen ``modulus`` thins out letters as a planted misspelling,
    decided by id and word (a NULL id counts as empty). NULL and empty texts
    have no words; repeated rows count again; other columns are not read; a
    table without words gives no rows.
    """
    words, _ = written(word_counts(docs, id_col, text_col, modulus, min_length, min_count), "words")
    best = F.min(F.struct(-F.col("near_n"), F.col("near")))
    near = (near_words(words, parts, heavy).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.col1")).alias("near_n"), F.col("b.near").alias("near"), "n"))
    enough = F.col("near_n") >= F.col("n") * ratio
    near, _ = written(near.select("word", "n_near", F.when(enough, F.col("near")).alias("form"),
                                  F.when(enough, F.col("near_n")).alias("form_n")), "forms")
    roots = _roots(near.where("form is not null"))
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"))


__all__ = ["spelling_variants", "near_words", "word_counts", "signatures"]
