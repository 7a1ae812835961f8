"""N-best SentencePiece segmentation and decoding.

A text's lattice has an edge for every vocabulary piece at every place. A
forward Viterbi pass gives the best score of each prefix; these are exact
heuristics for an A-star search backwards from the end, which therefore
completes the segmentations in order of their score and expands nothing
that cannot be among the best.

No piece joins two characters that no piece holds side by side, so the
lattice falls apart there (at word starts, around punctuation): a text's
best segmentation is its parts' best ones in a row, and its further ones
swap a few parts for their next best. Parts repeat, so each task searches a
distinct part once, as far as it remembers, and the work per text is a
lookup per word.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import free_name, slices, text_or_empty
from .pieces import kept_in_worker

SPACE = "▁"                  # how the model writes a space; fixed value
UNKNOWN_PENALTY = 10.0       # below the lowest piece score, as in the public library; fixed value
MET_PLACES = 1 << 21         # bytes by which a worker knows words that it met before


_NO_PIECE = (None, None)


def _trie(scores: dict[str, float]) -> dict[str, tuple]:
    """Per first character the score of the piece that ends there (None: none does) and the same for what may follow."""
    first: dict[str, tuple] = {}
    for piece, score in scores.items():
        level = first
        for char in piece[:-1]:
            own, longer = level.get(char, _NO_PIECE)
            if longer is None:
                longer = {}
                level[char] = own, longer
            level = longer
        if piece:
            level[piece[-1]] = score, level.get(piece[-1], _NO_PIECE)[1]
    return first


def _ids(node: tuple | None) -> tuple[int, ...]:
    """All ids of a node and those behind it."""
    ids: list[int] = []
    while node:
        ids += node[0]
        node = node[1]
    return tuple(ids)


def _rank(found: tuple[float, tuple[int, ...]]) -> tuple[float, tuple[int, ...]]:
    """Best score first, ties by ids from the left."""
    return -found[0], found[1]


class _Words(dict):
    """Number of each word and part of a word seen; its ids, score and gap stand at that number.

    From one text to the next it keeps up to ``limit`` of those that came up
    in a text before (most words are rare; one that is met again is not).
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.kept = make, limit, 0
        self.ids: list[bytes] = []
        self.scores, self.gaps = array("d"), array("d")
        self.new: list[str] = []
        self.met, self.marks = bytearray(MET_PLACES), 0

    def __missing__(self, word: str) -> int:
        ids, score, gap = self.make(word)
        number = self[word] = len(self.ids)
        self.new.append(word)
        self.ids.append(ids)
        self.scores.append(score)
        self.gaps.append(gap)
        return number

    def _met(self, word: str) -> bool:
        """Whether the word, or another with its place, was asked for since the marks were last wiped; marks it."""
        place = hash(word) % MET_PLACES
        if self.met[place]:
            return True
        self.met[place] = 1
        self.marks += 1
        if self.marks > MET_PLACES // 2:
            self.met, self.marks = bytearray(MET_PLACES), 0
        return False

    def trim(self) -> None:
        """Forget the text's new words that no earlier text had or that find no room."""
        kept = self.kept
        found = list(zip(self.new, self.ids[kept:], self.scores[kept:], self.gaps[kept:]))
        del self.ids[kept:], self.scores[kept:], self.gaps[kept:]
        self.new.clear()
        for word, ids, score, gap in found:
            if self.kept < self.limit and self._met(word):
                self[word] = self.kept
                self.kept += 1
                self.ids.append(ids)
                self.scores.append(score)
                self.gaps.append(gap)
            else:
                del self[word]


class PieceLattice:
    """Segmentation under a model file's pieces and scores.

    A character that no piece covers alone becomes its UTF-8 byte pieces (or
    the unknown piece) at a score below every piece's.
    """

    def __init__(self, path: str, memo: int = 250_000):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = model.normalize
        size = model.get_piece_size()
        self.unknown = model.unk_id()
        self.byte_ids = {}
        self.pieces: dict[str, tuple[tuple[int, ...], float]] = {}
        self.bytes_of: list[bytes] = [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = ((i,), model.get_score(i))
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        self.low = min((s for _, s in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.trie = _trie({p: score for p, (_, score) in self.pieces.items()})
        self.joined = {p[k:k + 2] for p in self.pieces for k in range(len(p) - 1)}
        # words can be taken apart at spaces if no piece has a space after another character
        self.by_word = all(SPACE not in p.lstrip(SPACE) for p in self.pieces)
        # a model that changes nothing but spaces; other texts go through its own normaliser
        probe = "ﬁ Ⅷ é́ ａ\n\t ½"
        self.plain = self.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        self.spaces_kept = self.normalize(" a  b ") == SPACE * 2 + "a" + SPACE * 2 + "b" + SPACE
        self.words = _Words(self._word, memo)

    def _fallback(self, char: str) -> tuple[int, ...]:
        if not self.byte_ids:
            return (self.unknown,)
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "replace"))

    def _forward(self, text: str) -> tuple[list[float], list[list[int]]]:
        """Best score of each prefix, and per place where the edges that end there start."""
        size, first, low = len(text), self.trie, self.low
        starts: list[list[int]] = [[] for _ in range(size + 1)]
        best = [0.0] + [-math.inf] * size
        for i, char in enumerate(text):
            here, j = best[i], i + 1
            score, longer = first.get(char, _NO_PIECE)
            if score is None:                                  # no piece covers the character alone
                score = low
            starts[j].append(i)
            if here + score > best[j]:
                best[j] = here + score
            while longer and j < size:
                node = longer.get(text[j])
                if node is None:
                    break
                j += 1
                score, longer = node
                if score is not None:
                    starts[j].append(i)
                    if here + score > best[j]:
                        best[j] = here + score
        return best, starts

    def search(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of normalised text: (score, ids), best first, ties by ids from the left.

        Fewer if the text has fewer; the empty text has one, without ids.
        """
        best, starts = self._forward(text)
        pieces = self.pieces
        # of equal bounds the one nearest to the start goes on, so a tie costs one path at a time;
        # a node is (ids of its piece, node behind it), so paths share what lies behind them
        found: list[tuple[float, tuple[int, ...]]] = []
        heap: list[tuple] = [(-best[-1], len(text), 0, 0.0, None)]
        order, floor = 0, -math.inf
        while heap and -heap[0][0] >= floor:
            if len(found) >= 8 * n:                            # a large tie: its first ones by ids, without listing it
                found.sort(key=_rank)
                level = found[n - 1][0]
                better = [f for f in found if f[0] > level]
                return better + [(level, ids) for ids in self._tied(text, starts, level, n, n - len(better))]
            reach, at, _, score, node = heappop(heap)
            while at:
                onward = None
                for i in starts[at]:
                    own, s = pieces.get(text[i:at]) or (self._fallback(text[i]), self.low)
                    bound = best[i] + s + score
                    if onward is None and bound >= -reach:     # as good as the path was: goes on past the heap
                        onward = i, s + score, (own, node)
                    elif bound >= floor:
                        order += 1
                        heappush(heap, (-bound, i, order, s + score, (own, node)))
                if onward is None:
                    break
                at, score, node = onward
            else:
                found.append((score, _ids(node)))
                if len(found) >= n:
                    floor = score
        return sorted(found, key=_rank)[:n] if len(found) > 1 else found

    def _tied(self, text: str, starts: list[list[int]], level: float, n: int, wanted: int) -> list[tuple[int, ...]]:
        """The first ``wanted`` segmentations by ids from the left among those that score ``level``, an ``n``-th best or better.

        A suffix of such a segmentation has one of the ``n`` best distinct
        scores from its place on (else its better ones would make ``n`` better
        segmentations). With these at hand a walk from the left takes the
        smallest ids first and never a path that misses the level. Pieces
        that start at one place differ in their first id.
        """
        size, pieces = len(text), self.pieces
        edges: list[list[tuple]] = [[] for _ in range(size)]
        for j, opened in enumerate(starts):
            for i in opened:
                own, s = pieces.get(text[i:j]) or (self._fallback(text[i]), self.low)
                edges[i].append((own, s, j))
        rest: list[list[float]] = [[] for _ in range(size)] + [[0.0]]
        for i in range(size - 1, -1, -1):
            edges[i].sort(reverse=True)
            rest[i] = sorted({s + score for _, s, j in edges[i] for score in rest[j]}, reverse=True)[:n]
        tied: list[tuple[int, ...]] = []
        stack: list[tuple] = [(0, level, None)]
        while stack and len(tied) < wanted:
            at, score, node = stack.pop()
            if at == size:
                parts = []
                while node:
                    parts.append(node[0])
                    node = node[1]
                tied.append(tuple(chain.from_iterable(reversed(parts))))
            else:
                stack += [(j, behind, (own, node)) for own, s, j in edges[at] for behind in rest[j] if s + behind == score]
        return tied

    def cut(self, text: str) -> list[str]:
        """Parts of normalised text that no piece joins."""
        joined = [*map(self.joined.__contains__, map(add, text, text[1:]))]
        if False not in joined:
            return [text]
        cuts = [k for k, together in enumerate(joined, 1) if not together]
        return [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)])]

    def _part(self, part: str) -> tuple[bytes, float, float]:
        """Ids of the best segmentation, its score, and the gap to the next.

        The search's first path is the best one, and as its bounds are exact
        the highest bound then left open is the next one's score: at a place
        of the path, that by the second best edge that ends there. So one
        pass keeps the two best scores by which a place is reached.
        """
        size, first, low = len(part), self.trie, self.low
        best = [0.0] + [-math.inf] * size
        second, back = [-math.inf] * (size + 1), [0] * (size + 1)
        for i, char in enumerate(part):
            here, j = best[i], i + 1
            s, longer = first.get(char, _NO_PIECE)
            reach = here + (low if s is None else s)           # as in _forward
            if reach > best[j]:
                second[j], best[j], back[j] = best[j], reach, i
            elif reach > second[j]:
                second[j] = reach
            while longer and j < size:
                node = longer.get(part[j])
                if node is None:
                    break
                j += 1
                s, longer = node
                if s is not None:
                    reach = here + s
                    if reach > best[j]:
                        second[j], best[j], back[j] = best[j], reach, i
                    elif reach > second[j]:
                        second[j] = reach
        pieces, total, left, score, at, path = self.pieces, best[-1], -math.inf, 0.0, size, []
        while at and best[at] + score >= total:
            left = max(left, second[at] + score)
            i = back[at]
            own, s = pieces.get(part[i:at]) or (self._fallback(part[i]), low)
            at, score = i, s + score
            path.append(own)
        if at or left >= total:        # a tie: the ids decide
            found = self.search(part, 2)
            gap = found[0][0] - found[1][0] if len(found) > 1 else math.inf
            return array("I", found[0][1]).tobytes(), found[0][0], gap
        return array("I", chain.from_iterable(reversed(path))).tobytes(), score, score - left

    def _word(self, word: str) -> tuple[bytes, float, float]:
        parts, known = self.cut(word), self.words
        if len(parts) == 1:
            return self._part(word)
        numbers = [known[p] for p in parts]
        return (b"".join([known.ids[k] for k in numbers]), sum([known.scores[k] for k in numbers]),
                min([known.gaps[k] for k in numbers]))

    def split(self, text: str) -> list[str]:
        """Normalised text as words, each with the spaces before it."""
        if not text:
            return []
        if self.by_word and self.plain and "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return [SPACE + w for w in text.split(" ")]
        normal = self.normalize(text)
        if not normal:
            return []
        if not self.by_word:
            return self.cut(normal)
        words, start = [], 0
        for k in range(1, len(normal)):
            if normal[k] == SPACE and normal[k - 1] != SPACE:
                words.append(normal[start:k])
                start = k
        words.append(normal[start:])
        return words

    def encode(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best segmentations of a text: (score, ids as little-endian unsigned 32-bit integers)."""
        words = self.split(text)
        if not words:
            return [(0.0, b"")]
        known = self.words
        numbers = list(map(known.__getitem__, words))
        ids = list(map(known.ids.__getitem__, numbers))
        at = np.array(numbers)
        total = float(np.frombuffer(known.scores)[at].sum())
        results = [(total, b"".join(ids))]
        if n > 1:
            gaps = np.frombuffer(known.gaps)[at]
            # only the n - 1 words with the smallest gaps can differ among the n best
            last = min(n - 2, len(gaps) - 1)
            near = np.flatnonzero(gaps <= np.partition(gaps, last)[last])
            loose = [k for k in near[np.argsort(gaps[near], kind="stable")[:n - 1]].tolist() if gaps[k] < math.inf]
            results += self._swaps(words, ids, total, loose, n)
        known.trim()
        return results

    def _swaps(self, words: list[str], ids: list[bytes], total: float, loose: list[int], n: int) -> list:
        """The second to ``n``-th best: the ``loose`` words' further segmentations, combined by smallest loss."""
        results: list[tuple[float, bytes]] = []
        choices = []
        for k in loose:
            options = self.search(words[k], n)
            choices.append((k, [(options[0][0] - s, array("I", o).tobytes()) for s, o in options]))
        heap, seen = [(0.0, (0,) * len(choices))], {(0,) * len(choices)}
        rank = 0
        while heap and rank < n:
            loss, pick = heappop(heap)
            if rank:
                swapped = ids.copy()
                for (k, options), at in zip(choices, pick):
                    if at:
                        swapped[k] = options[at][1]
                results.append((total - loss, b"".join(swapped)))
            rank += 1
            for c, (_, options) in enumerate(choices):
                following = (*pick[:c], pick[c] + 1, *pick[c + 1:])
                if following[c] < len(options) and following not in seen:
                    seen.add(following)
                    heappush(heap, (sum(o[p][0] for (_, o), p in zip(choices, following)), following))
        return results

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: piece bytes in a row, the space that the model puts in front taken away.

        Byte sequences that are not UTF-8 become replacement characters; ids
        of control pieces give nothing.
        """
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def lattice(path: str, memo: int = 250_000) -> PieceLattice:
    """The worker's lattice of a model file."""
    return kept_in_worker(f"lattice:{path}:{memo}", lambda: PieceLattice(path, memo))


def encode_nbest(docs: DataFrame, model: str, n: int = 3, text_col: str = "text", ids: str | None = "ids",
                 detail: str = "nbest", memo: int = 250_000, keep_text: bool = True) -> DataFrame:
    """``docs`` with all its columns plus the segmentations of each whole text; no shuffle.

    Without ``keep_text`` the text column is left out.

    * ``ids`` (array of int): the best segmentation; None leaves it out;
    * ``detail``: array of up to ``n`` structs ``score, n_pieces, ids_crc32``,
      best first (CRC-32 of the ids as little-endian unsigned 32-bit integers);
    * ``decoded``: whether decoding the best ids gives back the text as the
      model sees it (it writes U+2581 as a space).

    NULL counts as empty; the empty text has one segmentation without ids
    and score 0. ``memo`` bounds the words and parts of words, together,
    whose result a worker keeps (about 300 bytes each); it changes the time
    only. New columns must not exist yet. A tie between segmentations
    of a word goes to the smaller ids, however many share the score; between
    words, to the earlier one. A search takes memory in proportion to the
    length of its part, however long that is.
    """
    new = [c for c in (ids, detail, "decoded") if c]
    clash = set(new) & set(docs.columns)
    if clash:
        raise ValueError(f"columns to be added exist already: {sorted(clash)}")
    # a text goes to the worker once: as the column it is, else as a string beside it
    own = [k for k, f in enumerate(docs.schema.fields) if f.name == text_col and isinstance(f.dataType, T.StringType)]
    ready, at = (docs, own[0]) if len(own) == 1 else (docs.withColumn(free_name(docs, "input"), text_or_empty(text_col)), -1)
    left_out = [] if keep_text else [c.lower() for c in docs.select(text_col).columns]
    passed = [k for k, c in enumerate(docs.columns) if c.lower() not in left_out]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model, memo)
        shape = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64())]))
        for batch in slices(batches):
            best, details, same = [], [], []
            for text in batch.column(at).to_pylist():
                text = text or ""
                found = pieces.encode(text, n)
                values = np.frombuffer(found[0][1], "<u4")
                same.append(pieces.decode(values.tolist()) == seen_text(pieces, text))
                details.append([{"score": s, "n_pieces": len(x) // 4, "ids_crc32": zlib.crc32(x)} for s, x in found])
                if ids:
                    best.append(values.astype(np.int32))
            made = ([pa.array(best, pa.list_(pa.int32()))] if ids else []) + [pa.array(details, shape), pa.array(same)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, passed), *made],
                                             [*map(batch.schema.names.__getitem__, passed), *new])

    entry = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("n_pieces", T.LongType()),
                          T.StructField("ids_crc32", T.LongType())])
    fields = [docs.schema.fields[k] for k in passed] + ([T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else [])
    return ready.mapInArrow(run, T.StructType([*fields, T.StructField(detail, T.ArrayType(entry)),
                                               T.StructField("decoded", T.BooleanType())]))


def seen_text(pieces: PieceLattice, text: str) -> str:
    """What the model sees of a text."""
    if pieces.plain and SPACE not in text and not (text and pieces.spaces_kept is False):
        return text
    normal = pieces.normalize(text).replace(SPACE, " ")
    return normal[1:] if normal.startswith(" ") else normal


def decode_ids(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded_text") -> DataFrame:
    """``rows`` plus the text of an id column; NULL ids give NULL."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model)
        for batch in slices(batches):
            at = batch.schema.get_field_index(ids)
            texts = [None if x is None else pieces.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, text])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())]))


__all__ = ["PieceLattice", "encode_nbest", "decode_ids"]
