"""Licence scan: Dice coefficient over word bigrams against licence templates.

The unit compared is a window of consecutive units, which end at line ends
and at sentence ends: a sentence, a line, a paragraph, a whole text. A notice
between two sentences of a line, or a licence inside a paragraph whose line
ends are gone, is a window of its own. Dice of two bigram multisets of sizes a and b is at most
``2 min(a, b) / (a + b)``, so a template is only compared with windows
between ``t / (2 - t)`` and ``(2 - t) / t`` times its size, for threshold t.
The same bound asks that ``t / (2 - t)`` of a window's bigrams occur in
templates at all, hence in at least one of its units; texts without such a
unit are done after one look-up per word, the others' windows are listed by
array arithmetic and only those that could reach t are compared.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_or_empty
from .licence_templates import TEMPLATES

# words and digits; line ends; sentence ends (a mark before white space or the end)
TOKEN = re.compile(r"[^\W_]+|\r\n|[\n\r\x0b\x0c\x85\u2028\u2029]|[.!?;:\u3002](?=\s|$)")
LINE_ENDS = frozenset(["\r\n", *"\n\r\x0b\x0c\x85\u2028\u2029"])
BREAKS = LINE_ENDS | frozenset(".!?;:\u3002")
LIMIT = 1 << 20                       # characters of all templates, shipped with the tasks


class Templates:
    """Templates as bigram multisets over the vocabulary of all templates."""

    def __init__(self, templates: list[tuple[str, str, str]]):
        if sum(len(t) for _, _, t in templates) > LIMIT:
            raise ValueError("templates are shipped to every task; cut them into several scans")
        words = [[w for w in TOKEN.findall(text.lower()) if w not in BREAKS] for _, _, text in templates]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.width = len(self.vocabulary) + 1
        # numbers of all tokens that matter: words, -1 for a sentence end, -2 for a line end
        self.numbers = self.vocabulary | dict.fromkeys(BREAKS, -1) | dict.fromkeys(LINE_ENDS, -2)
        self.entries = []
        for (name, licence, _), ws in zip(templates, words):
            ids = [self.vocabulary[w] for w in ws]
            bag = Counter(a * self.width + b for a, b in zip(ids, ids[1:]))
            if bag:
                self.entries.append((name, licence, bag, sum(bag.values())))
        self.known = np.zeros(self.width * self.width, bool)
        for _, _, bag, _ in self.entries:
            self.known[list(bag)] = True
        # how often each template has each known bigram
        self.row = np.cumsum(self.known) - 1
        self.sizes = np.array([size for *_, size in self.entries], np.int64)
        self.bags = np.zeros((int(self.known.sum()), len(self.entries)), np.int64)
        for k, (_, _, bag, _) in enumerate(self.entries):
            self.bags[self.row[list(bag)], k] = list(bag.values())


def scan_text(text: str, templates: Templates, threshold: float) -> list[tuple[str, str, float, int, int]]:
    """``(template, licence, dice, first line, last line)``, best first, no two sharing a unit.

    Lines count from 0. Of equal Dice the earlier, then the shorter window,
    then the first template name wins. Texts without two words match nothing.
    """
    found = TOKEN.findall(text.lower())
    if len(found) < 2:
        return []
    lookup = templates.numbers.get
    ids = np.fromiter((lookup(w, 0) for w in found), np.int64, len(found))
    breaks = ids < 0
    unit, line = np.cumsum(breaks)[~breaks], np.cumsum(ids == -2)[~breaks]
    ids = ids[~breaks]
    if len(ids) < 2:
        return []
    bigram = ids[:-1] * templates.width + ids[1:]
    hit = templates.known[bigram] & (ids[:-1] > 0) & (ids[1:] > 0)
    if not hit.any():
        return []
    share = threshold / (2 - threshold)
    # a window that reaches the threshold shares that part of the template with it, hence so does the text
    codes, times = np.unique(bigram[hit], return_counts=True)
    shared = np.minimum(templates.bags[templates.row[codes]], times[:, None]).sum(axis=0)
    possible = np.flatnonzero(shared >= share * templates.sizes - 1e-9).tolist()
    if not possible:
        return []
    _, first = np.unique(unit, return_index=True)              # units with words
    last = np.append(first[1:], len(ids)) - 1                  # their last words
    per_line = np.add.reduceat(np.append(hit, False), first)
    dense = per_line >= share * (last - first)
    if not dense.any():
        return []
    seen = np.concatenate(([0], np.cumsum(hit)))               # hits before a bigram
    dense_before = np.concatenate(([0], np.cumsum(dense)))
    matches = []
    for name, licence, bag, size in map(templates.entries.__getitem__, possible):
        low = max(1, math.ceil(size * share - 1e-9))
        high = math.floor(size / share + 1e-9)
        begin = np.searchsorted(last, first + low)             # first and past-last unit a window may end with
        end = np.searchsorted(last, first + high, side="right")
        counts = np.maximum(end - begin, 0)
        if not counts.any():
            continue
        i = np.repeat(np.arange(len(first)), counts)
        j = np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begin, counts)
        n = last[j] - first[i]
        likely = (dense_before[j + 1] > dense_before[i]) & (
            2 * np.minimum(seen[last[j]] - seen[first[i]], size) >= threshold * (n + size) - 1e-9)
        for a, b in zip(i[likely].tolist(), j[likely].tolist()):
            own = bigram[first[a]:last[b]][hit[first[a]:last[b]]]
            common = sum(min(k, bag[code]) for code, k in Counter(own.tolist()).items() if code in bag)
            dice = 2 * common / (int(last[b] - first[a]) + size)
            if dice >= threshold:
                matches.append((-dice, a, b, name, licence))
    taken, out = [], []
    for dice, a, b, name, licence in sorted(matches):
        if all(b < x or a > y for x, y in taken):
            taken.append((a, b))
            out.append((name, licence, -dice, int(line[first[a]]), int(line[last[b]])))
    return out


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                  templates: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Per row: id and ``matches``, an array of structs ``template, licence, dice, first_line, last_line``.

    Whole texts are compared, after lower-casing and with everything but
    letters and digits as separators. NULL, empty and one-word texts have no
    matches; repeated rows each get their row; other columns are not read;
    an empty table gives no rows. No shuffle.
    """
    prepared = Templates(TEMPLATES if templates is None else templates)
    shape = pa.list_(pa.struct([("template", pa.string()), ("licence", pa.string()), ("dice", pa.float64()),
                                ("first_line", pa.int32()), ("last_line", pa.int32())]))
    names = [shape.value_type.field(k).name for k in range(5)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [[dict(zip(names, m)) for m in scan_text(t, prepared, threshold)]
                    for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, shape)], ["id", "matches"])

    entry = T.StructType([T.StructField("template", T.StringType()), T.StructField("licence", T.StringType()),
                          T.StructField("dice", T.DoubleType()), T.StructField("first_line", T.IntegerType()),
                          T.StructField("last_line", T.IntegerType())])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("matches", T.ArrayType(entry))])
    return (docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, schema).withColumnRenamed("id", id_col))


__all__ = ["scan_licences", "scan_text", "Templates"]
