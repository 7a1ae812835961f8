"""Prefix trie, packing and spelling variants against brute force, with odd rows, hot keys and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import bin_slack, prefix_trie, queries, ranges, spelling
from lakeops.session import scratch_path

SF = "/root/testdata/sf0.001"
WORDS = P.path("word_bpe_49k.json")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ---- running values over a global order -------------------------------------------------------

def test_carries_of_keys_over_many_partitions(spark):
    rows = [(0, "a", 0, 5), (0, "a", 1, 7), (1, "a", 0, 2), (2, "a", 0, 1), (2, "b", 1, 4), (4, "b", 0, 6), (5, "c", 0, 9)]
    frame = spark.createDataFrame(rows, "part int, key string, row long, total long")
    found = ranges.carries(frame, "key", ["total"], lambda a, b: (a[0] + b[0],))
    assert sorted(rows_of(found)) == [(1, "a", 7), (2, "a", 9), (4, "b", 4)]
    assert ranges.carries(frame.where("part = 0"), "key", ["total"], lambda a, b: a) is None
    assert ranges.carries(frame.limit(0), "key", ["total"], lambda a, b: a) is None


# ---- prefix trie ------------------------------------------------------------------------------

def plain_trie(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            digest = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()
            convs[c].append(((t is not None, t or 0, digest), r, x))
    turns = {c: [v[1:] for v in sorted(own)] for c, own in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(c - c % 5 if c >= 0 else c + -c % 5, [])[:h] + own[h:])
    members, below, saved, leaves = defaultdict(list), Counter(), Counter(), Counter()
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    for node in members:
        if node:
            below[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
            leaves[node[:d]] += not below[node]
    ends = {n: ",".join(str(c) for c in sorted(m) if len(built[c]) == len(n)) for n, m in members.items()}
    return [(min(m), len(n), min(members[n[:-1]]) if n else None, len(m), below[n], leaves[n], saved[n],
             hashlib.sha256(ends[n].encode()).hexdigest()) for n, m in members.items()]


@pytest.fixture(scope="module")
def odd_conversations(spark):
    rnd = random.Random(3)
    said = ["", None, "hello", "hello there", "so?", "日本語", "x" * 5000]
    rows = []
    for c in [*range(0, 60), -7, -5, 10**12, 10**12 + 1]:
        for t in range(rnd.randint(1, 14)):
            rows.append((c, t if rnd.random() < 0.9 else None, rnd.choice(["user", "assistant", None]), rnd.choice(said)))
    rows += [(c, t, "user", f"copied {t}") for c in range(100, 140) for t in range(6)]     # a third of all are copies
    rows += [(200, t, "user", str(t % 7)) for t in range(900)]                             # one has very many turns
    rows += [(310, 0, "u", "x"), (310, 1, "u", "y"), (315, 0, "u", "y"), (315, 1, "u", "x")]
    rows += [(201, None, None, None)] * 3 + [(None, 1, "user", "of none"), (203, 1, "u", "a"), (203, 1, "u", "b"), (203, 1, "u", "a")]
    rnd.shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "conv_id long, turn long, role string, text string, digest string, depth int")
    return frame.repartition(5)


def test_prefix_trie(odd_conversations):
    rows = rows_of(odd_conversations.select("conv_id", "turn", "role", "text"))
    got = prefix_trie.prefix_trie(odd_conversations)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(rows_of(got), key=str) == sorted(plain_trie(rows), key=str)
    assert rows_of(prefix_trie.prefix_trie(odd_conversations.limit(0))) == []


def test_a_chance_meeting_is_found_and_done_again(odd_conversations, monkeypatch):
    # with x = 1 a fingerprint does not see the order of turns: 310 and 315 meet
    real, tries = prefix_trie.draw_bases, []

    def weak(seed, attempt):
        tries.append(attempt)
        return [1, 1, 1, 1] if attempt == 0 else real(seed, attempt)

    monkeypatch.setattr(prefix_trie, "draw_bases", weak)
    rows = rows_of(odd_conversations.select("conv_id", "turn", "role", "text"))
    assert sorted(rows_of(prefix_trie.prefix_trie(odd_conversations)), key=str) == sorted(plain_trie(rows), key=str)
    assert tries == [0, 1]


def test_members_digest_of_members_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 400)
    rnd = random.Random(1)
    ids = rnd.sample(range(-10**6, 10**12), 30_000)
    rows = [(3, 1, 2, 3, 4, c) for c in ids[:29_000]] + [(3, 1, 2, 3, k % 50, c) for k, c in enumerate(ids[29_000:])]
    schema = "depth long, f0 int, f1 int, f2 int, f3 int, conv long"
    got = rows_of(prefix_trie.members_digest(spark.createDataFrame(rows, schema)))
    want = defaultdict(list)
    for r in rows:
        want[r[:5]].append(r[5])
    assert sorted(got) == sorted((*n, hashlib.sha256(",".join(map(str, sorted(m))).encode()).hexdigest()) for n, m in want.items())


# ---- packing ----------------------------------------------------------------------------------

def test_best_fill_is_the_closest_multiset():
    rnd = random.Random(2)
    for _ in range(200):
        counts = {rnd.randint(1, 20): rnd.randint(0, 3) for _ in range(rnd.randint(0, 5))}
        room = rnd.randint(0, 40)
        items = [n for n, c in counts.items() for _ in range(c)]
        sums = {sum(s) for k in range(len(items) + 1) for s in combinations(items, k)}
        chosen = bin_slack.best_fill(counts, room)
        assert all(0 < c <= counts[n] for n, c in chosen.items())
        assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= room)


def check_plan(histogram, capacity):
    plan = bin_slack.plan_windows(dict(histogram), capacity)
    windows, pieces = defaultdict(list), defaultdict(list)
    for rest, rank, n, start, length, j, copies, sequence, offset in plan.tolist():
        for i in range(n):
            windows[sequence + (j + i) // copies].append((offset + (j + i) % copies * length, length))
            pieces[rest, rank + i].append((start, length))
    sizes = []
    for spans in (*windows.values(), *pieces.values()):
        spans.sort()
        assert [a for a, _ in spans] == np.cumsum([0, *(n for _, n in spans[:-1])]).tolist()
    sizes = [sum(n for _, n in spans) for _, spans in sorted(windows.items())]
    assert sorted(windows) == list(range(len(windows)))
    assert all(size == capacity for size in sizes[:sum(n * c for n, c in histogram.items()) // capacity])
    assert all(size & size - 1 == 0 for size in sizes)
    assert {k: sum(n for _, n in s) for k, s in pieces.items()} == {(n, r): n for n, c in histogram.items() for r in range(c) if n}
    return plan


@pytest.mark.parametrize("capacity", [1, 2, 8, 64, 4096])
def test_plans_place_every_token_without_padding(capacity):
    rnd = random.Random(capacity)
    for _ in range(20):
        histogram = Counter()
        for _ in range(rnd.randint(0, 60)):
            histogram[rnd.choice([rnd.randrange(capacity), 3 * capacity // 4])] += rnd.choice([1, 2, 50])
        check_plan(histogram, capacity)


def test_a_plan_does_not_grow_with_the_documents():
    few = check_plan(Counter({3000: 40, 1000: 30, 96: 20, 1: 7}), 4096)
    many = bin_slack.plan_windows({3000: 4 * 10**9, 1000: 3 * 10**9, 96: 2 * 10**9, 1: 7 * 10**8}, 4096)
    assert len(many) < 40 * len(few)


def check_pieces(got, docs, end_id, capacity):
    """``docs``: texts by position; ``got``: rows with ids."""
    library = Tokenizer.from_file(WORDS)
    want = Counter()
    for i, text in docs:
        want[i, np.array([*library.encode(text or "", add_special_tokens=False).ids, end_id], "<u4").tobytes()] += 1
    sequences, found = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        found[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
    for spans in sequences.values():
        spans.sort()
        assert [a for a, _ in spans] == np.cumsum([0, *(n for _, n in spans[:-1])]).tolist()
        total = sum(n for _, n in spans)
        assert total <= capacity and total & total - 1 == 0
    assert sorted(sequences) == list(range(len(sequences)))
    return want, found


def test_packed_pieces(spark, odd_docs, no_docs):
    docs = rows_of(odd_docs.select("doc_id", "text"))
    pieces = bin_slack.packed_pieces(odd_docs, WORDS, 256)
    got = pieces.collect()
    want, found = check_pieces(got, docs, 2, 256)
    whole = Counter()
    for (i, n), parts in found.items():
        # rows that repeat an id and a length meet here: their pieces are told apart by their starts
        copies = sum(c for (j, ids), c in want.items() if j == i and len(ids) == 4 * n)
        assert sum(len(p) for _, p in parts) == 4 * n * copies
        if copies == 1:
            whole[i, b"".join(p for _, p in sorted(parts))] += 1
    assert whole == Counter({k: c for k, c in want.items()
                             if sum(n for (j, ids), n in want.items() if j == k[0] and len(ids) == len(k[1])) == 1})
    assert rows_of(bin_slack.packed_pieces(no_docs, WORDS, 256)) == []
    with pytest.raises(ValueError):
        bin_slack.packed_pieces(odd_docs, WORDS, 100)
    path = scratch_path(spark, "sequences")
    bin_slack.write_sequences(pieces, path)
    stored = {r.sequence_id: bytes(r.ids) for r in spark.read.parquet(path).collect()}
    joined = defaultdict(list)
    for r in got:
        joined[r.sequence_id].append((r.offset, bytes(r.ids)))
    assert stored == {s: b"".join(p for _, p in sorted(parts)) for s, parts in joined.items()}


def test_a_length_that_most_documents_share(spark):
    docs = spark.createDataFrame([(i, None if i % 3 else "one two " * (i % 7)) for i in range(3000)], "doc_id long, text string").repartition(7)
    got = bin_slack.packed_pieces(docs, WORDS, 64).collect()
    want, found = check_pieces(got, rows_of(docs), 2, 64)
    assert Counter((i, b"".join(p for _, p in sorted(parts))) for (i, _), parts in found.items()) == want


# ---- spelling variants ------------------------------------------------------------------------

def plain_words(docs, modulus, min_length, min_count):
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run[:h % len(run)] + run[h % len(run) + 1:] if h % modulus == 0 else run] += 1
    return {w: n for w, n in count.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1:] or a[i + 1:] == b[i + 1:] and len(a) == len(b)


def plain_variants(words, ratio):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return [(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()]


@pytest.mark.parametrize("heavy", [64, 1])
@pytest.mark.parametrize("parts", [3, 4])
def test_near_words_are_those_of_all_pairs(spark, heavy, parts):
    rnd = random.Random(heavy + parts)
    words = set()
    for _ in range(60):
        word = "".join(rnd.choice("abéÿ") for _ in range(rnd.randint(1, 7)))
        words |= {word, word[1:] or "a", word + "a", "".join(rnd.sample(word, len(word))), word[:2] + "b" + word[2:]}
    frame = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    got = rows_of(spelling.near_words(frame, parts, heavy).select("word", "near"))
    assert sorted(got) == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_spelling_variants(spark, odd_docs, no_docs):
    rnd = random.Random(9)
    base = ["variant", "spelling", "Straßen", "niñería", "colours"]
    texts = []
    for _ in range(300):
        word = rnd.choice(base)
        for _ in range(rnd.choice([0, 0, 0, 0, 1, 2])):
            at = rnd.randrange(len(word) + 1)
            word = rnd.choice([word[:at] + "x" + word[at:], word[:at] + word[at + 1:], word[:at] + "é" + word[at + 1:]])
        texts.append(" ".join([word.upper() if rnd.random() < 0.2 else word] * rnd.choice([1, 5, 30])))
    docs = odd_docs.select("doc_id", "text").unionAll(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    for ratio, modulus in ((5, 199), (2, 3)):
        got = rows_of(spelling.spelling_variants(docs, modulus=modulus, ratio=ratio))
        words = plain_words(rows_of(docs), modulus, 6, 5)
        assert sorted(got) == sorted(plain_variants(words, ratio))
    assert any(r[1] and r[2] != r[1] for r in got)          # a form that has a form
    assert rows_of(spelling.spelling_variants(no_docs)) == []
    assert rows_of(spelling.spelling_variants(docs.where("text is null"))) == []


def test_counts_that_fill_the_memo(spark, odd_docs):
    got = dict(rows_of(spelling.word_counts(odd_docs, min_length=1, min_count=1, held=3)))
    assert got == plain_words(rows_of(odd_docs.select("doc_id", "text")), 199, 1, 1)


def test_a_thinned_run_that_is_another_run_is_thinned_once(spark):
    def crc(i, run):
        return zlib.crc32(f"{i}:{run}".encode())

    # ids under which a run loses a letter and what is left stands in the text too and loses one itself
    whole, docs = "misspellings", []
    for i in range(300_000):
        if crc(i, whole) % 199 == 0:
            at = crc(i, whole) % len(whole)
            less = whole[:at] + whole[at + 1:]
            if crc(i, less) % 199 == 0:
                docs += [(i, f"{whole} {less} {less} " * 3), (i, f"{less} {whole} " * 5)]
    assert docs
    words = plain_words(docs, 199, 6, 5)
    got = rows_of(spelling.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert sorted(got) == sorted(plain_variants(words, 5))

    rnd = random.Random(3)
    for modulus in (1, 2, 3):
        texts = [(i, " ".join("".join(rnd.choice("abÉ") for _ in range(rnd.randint(1, 4))) for _ in range(30))) for i in range(200)]
        total = Counter()
        for i, text in texts:
            total.update(spelling.words_of(str(i), text, modulus))
        assert {w: n for w, n in total.items() if w} == plain_words(texts, modulus, 1, 1)


# ---- the registered queries -------------------------------------------------------------------

def test_op12_covers_every_document(spark):
    rows = queries.op12_bin_slack(spark, SF)
    tokens = rows.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("whole")).where("n <> whole")
    assert tokens.count() == 0
    assert rows.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
