"""Encoding many texts with the ``tokenizers`` library, each distinct word once.

Two common layouts split a text at white space before anything else, so the
ids of a text are the ids of its words in a row:

* byte-level with the library's own pattern and no normaliser: a boundary
  lies before every white space that follows something else;
* a ``Split`` pattern that removes white space, after per-character
  normalisation: a boundary lies at every run of white space.

For them words are looked up in a bounded memo that lives as long as the
Python worker, and only words it lacks go through the library, cut by the
tokenizer's own pattern into the pieces that it encodes one by one. Any
other layout, and any text the rule is not proven for, is encoded whole.
"""

from __future__ import annotations

import json
import re
import sys
import types
import unicodedata
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# the pattern of the library's byte-level pre-tokenizer; fixed value
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# any white space before a space, in the syntax of the Arrow functions; a superset of Unicode's
SPACE_BEFORE_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "
CONTROL_SEPARATORS = re.compile("[\x1c-\x1f]")    # white space to some libraries, not to others
LATIN_END = "ɐ"


def kept_in_worker(name: str, make):
    """``make()`` once per Python worker process; later tasks of the worker get the same object."""
    holder = sys.modules.setdefault("_task_kept_objects", types.ModuleType("_task_kept_objects"))
    if name not in holder.__dict__:
        holder.__dict__[name] = make()
    return holder.__dict__[name]


class PieceEncoder:
    """Ids of many texts by a tokenizer file; see the module."""

    def __init__(self, path: str, memo_words: int = 1_100_000):
        import os

        import regex
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark owns the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            layout = json.load(f)
        self.rule, pattern = self._rule(layout)
        self.pattern = regex.compile(pattern) if pattern else None
        self.special = [t["content"] for t in layout.get("added_tokens") or []]
        if any(re.search(r"\s", s) for s in self.special) or any(
                t["lstrip"] or t["rstrip"] for t in layout.get("added_tokens") or []):
            self.rule = None
        self.special_starts = sorted({s[:2] for s in self.special})
        # ids by word, a word after its space being written without it; pieces are words of their own
        self.words: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}        # "spaced" only: what stands without a space before it
        self.memo_words = memo_words

    @staticmethod
    def _rule(layout: dict) -> tuple[str | None, str | None]:
        pre, norm = layout.get("pre_tokenizer") or {}, layout.get("normalizer")
        if layout.get("post_processor") not in (None, {}) and (layout["post_processor"] or {}).get("type") != "ByteLevel":
            return None, None
        if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not norm:
            return "spaced", BYTE_LEVEL_PATTERN
        steps = pre.get("pretokenizers") or []
        norms = [n["type"] for n in (norm or {}).get("normalizers", [])]
        if (len(steps) == 2 and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed"
                and steps[0].get("invert") and "Regex" in steps[0].get("pattern", {})
                and steps[1].get("type") == "ByteLevel" and not steps[1].get("use_regex", True)
                and not steps[1].get("add_prefix_space") and norms == ["NFC", "Replace", "Lowercase"]
                and norm["normalizers"][1].get("pattern") == {"Regex": "\\s+"}
                and norm["normalizers"][1].get("content") == " "):
            return "dropped", steps[0]["pattern"]["Regex"]
        return None, None

    def library(self, texts: Sequence[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _cut(self, word: str) -> list[str] | None:
        """The word's pieces as the library cuts it; None: not proven, encode it whole."""
        for start in self.special_starts:
            if start in word:
                return None
        if CONTROL_SEPARATORS.search(word):
            return None
        if self.rule == "spaced":
            return self.pattern.findall(word)
        low = word.lower()
        if word.isascii():
            return [low] if word.isalpha() else self.pattern.findall(low)
        if max(word) >= LATIN_END or len(low) != len(word) or not unicodedata.is_normalized("NFC", word):
            return None
        return self.pattern.findall(low)

    def _resolve(self, words: list[str], lead: str = "") -> dict[str, bytes]:
        """Ids of ``lead + word`` by word, through the library for pieces that no memo holds."""
        cut = [self._cut(lead + w) for w in words]
        if not lead and self.rule == "spaced":
            apart, inner = self.heads, self.heads
        else:
            apart, inner = (self.heads, self.words) if lead else (self.words, self.words)
        new: dict[str, bytes | None] = {}        # by piece
        for word, pieces in zip(words, cut):
            for p in (lead + word,) if pieces is None else pieces:
                if p not in new and (p[1:] not in inner if lead and p[:1] == lead else p not in apart):
                    new[p] = None
        new.update(zip(new, self.library(list(new))))
        found = {}
        for word, pieces in zip(words, cut):
            found[word] = b"".join([new[p] if p in new else inner[p[1:]] if lead and p[:1] == lead else apart[p]
                                    for p in ((lead + word,) if pieces is None else pieces)])
        # full memos take nothing more: what came early is what is frequent
        if max(len(apart), len(inner)) < self.memo_words:
            for p, ids in new.items():
                if lead and p[:1] == lead:
                    inner[p[1:]] = ids
                else:
                    apart[p] = ids
            inner.update(found)
        return found

    def _looked_up(self, words: pa.StringArray, first: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """Per word its number, and the ids of each number; ``first``: places of words without a space before them."""
        coded = words.dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        distinct = coded.dictionary.to_pylist()
        spaced = self.rule == "spaced"
        ids = list(map(self.words.get, distinct))
        holes = [k for k, known in enumerate(ids) if known is None]
        if holes:
            found = self._resolve([distinct[k] for k in holes], " " if spaced else "")
            for k in holes:
                ids[k] = found[distinct[k]]
        if spaced and len(first):
            starts = words.take(pa.array(first)).to_pylist()
            heads = dict.fromkeys(starts)
            found = self._resolve([w for w in heads if w not in self.heads])
            at = {w: len(ids) + k for k, w in enumerate(heads)}
            number[first] = [at[w] for w in starts]
            ids += [found[w] if w in found else self.heads[w] for w in heads]
        return number, ids

    def _by_words(self, texts: pa.StringArray, flat: bool) -> tuple[np.ndarray | None, np.ndarray]:
        lists = pc.split_pattern(texts, " ") if self.rule == "spaced" else pc.ascii_split_whitespace(texts)
        size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        end = np.cumsum(size)
        number, ids = self._looked_up(lists.flatten(), end - size)
        length = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        n = length[number]
        before = np.concatenate(([0], np.cumsum(n)))
        counts = before[end] - before[end - size]
        if not flat:
            return None, counts
        start = np.cumsum(length) - length
        place = np.repeat(start[number] - before[:-1], n)
        place += np.arange(len(place))
        return np.frombuffer(b"".join(ids), "<u4")[place], counts

    def encode_column(self, texts: pa.StringArray, flat: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """Ids of all texts in a row (None without ``flat``), and the number of ids of each.

        No begin, end or added special tokens; no NULL texts.
        """
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        whole = np.full(len(texts), self.rule is None)
        if self.rule == "spaced":
            whole = pc.match_substring_regex(texts, SPACE_BEFORE_SPACE).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_words(texts, flat)
        counts = np.zeros(len(texts), np.int64)
        direct = [np.frombuffer(x, "<u4") for x in self.library(texts.filter(pa.array(whole)).to_pylist())]
        counts[whole] = [len(x) for x in direct]
        rest, parts = np.zeros(0, "<u4"), []
        if not whole.all():
            rest, counts[~whole] = self._by_words(texts.filter(pa.array(~whole)), flat)
        if not flat:
            return None, counts
        others, at = iter(direct), 0
        for n, alone in zip(counts.tolist(), whole.tolist()):
            parts.append(next(others) if alone else rest[at:at + n])
            at += 0 if alone else n
        return np.concatenate(parts), counts

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if len(texts) else []


def encoder(path: str, **options) -> PieceEncoder:
    """The worker's encoder of a tokenizer file."""
    return kept_in_worker(f"pieces:{path}:{options}", lambda: PieceEncoder(path, **options))


__all__ = ["PieceEncoder", "encoder", "kept_in_worker"]
