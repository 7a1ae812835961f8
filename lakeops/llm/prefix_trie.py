"""Prefix trie of rebuilt conversations by composable monoid fingerprints.

A rebuilt conversation is a head of another conversation followed by a
suffix of its own. Nothing is rebuilt: a sequence of turns t0 t1 ... has the
fingerprint (length, sum of t_i x^i mod P), and fingerprints compose,

    (n, a) * (m, b) = (n + m, a + x^n b),

so the prefix of a rebuilt conversation has the fingerprint of a head of the
base composed with a segment of the own turns, and a segment is the quotient
of two own prefixes. Four lanes (four x, P = 2^31 - 1) make 124 bits. Every
conversation gives one slim row per depth: which node it passes, that node's
parent, and the reference of its last turn (source conversation and place)
with that turn's SHA-256.

Rows of equal depth and fingerprint form a node. Each group is verified: all
its rows must have the same parent group and refer to turns of equal
content, which by induction proves equal sequences. If a group fails, two
sequences met by chance, and everything is done again with other x.

Subtree sums need no walk over levels. A node belongs to its smallest
member's chain: the deepest nodes of that conversation, from some depth on.
The nodes below v lie on chains of members of v. So the leaves below v are
the members that end in a leaf as its smallest member, and a sum over the
subtree is the sum of the members' whole chains less what v's own chain
holds above v: two aggregations of the rows and one running sum.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, slices, text_or_empty, written
from .ranges import Runs, carries, in_order, running_sum

P = (1 << 31) - 1
LANES = 4
NODE = ["depth", "f0", "f1", "f2", "f3"]
PARENT = ["p0", "p1", "p2", "p3"]
DIGEST = ["d0", "d1", "d2", "d3"]
CHUNK, STEP = 1 << 16, 1 << 11      # characters that move at a time; ids joined at a time
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def remainder_base(conv: Column) -> Column:
    return conv - conv % 5


def checksum_head(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int")


def own_prefixes(turns: DataFrame, bases: list[int]) -> tuple[DataFrame, str]:
    """``(conv, pos, f.., p.., d.., n_bytes)`` per turn: fingerprints of the own prefix with (f) and without (p) it.

    ``turns`` has ``conv, turn, digest, n_bytes``; written, with its folder.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 4096
        x = np.array(bases, np.uint64)
        powers = np.ones((width, LANES), np.uint64)
        for i in range(1, width):
            powers[i] = powers[i - 1] * x % P
        runs, n, held = Runs(), 0, np.zeros(LANES, np.uint64)
        for batch in slices(batches, width):
            digests = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, 32)
            start, on = runs.cut(batch.column(0).to_numpy())
            at = np.arange(batch.num_rows)
            pos = at - start + np.where(on, n, 0)
            weight = powers[at - start]
            weight[on] = weight[on] * np.array([pow(b, n, P) for b in bases], np.uint64) % P
            value = digests[:, :16].copy().view("<u4").astype(np.uint64) % P * weight % P
            total = np.cumsum(value, axis=0)
            total -= np.where((start > 0)[:, None], total[start - 1], 0).astype(np.uint64)
            total[on] += held
            total %= P
            before = (total + np.uint64(P) - value) % P
            n, held = int(pos[-1]) + 1, total[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pos), batch.column(3), pa.array(runs.rows(batch.num_rows)),
                 *(pa.array(total[:, k].astype(np.int32)) for k in range(LANES)),
                 *(pa.array(before[:, k].astype(np.int32)) for k in range(LANES)),
                 *(pa.array(digests[:, 8 * k:8 * k + 8].copy().view("<i8").reshape(-1)) for k in range(4)),
                 batch.column(2)],
                ["conv", "pos", "part", "row", *NODE[1:], *PARENT, *DIGEST, "n_bytes"])

    names = ", ".join([*(f"{c} int" for c in (*NODE[1:], *PARENT)), *(f"{c} long" for c in DIGEST)])
    ordered = in_order(turns.select("conv", "digest", "n_bytes", "turn"), "conv", "turn", "digest")
    local, local_path = written(ordered.select("conv", "digest", "n_bytes", "part").mapInArrow(
        run, f"conv long, pos long, part int, row long, {names}, n_bytes long"), "own-prefixes")

    def compose(a: tuple, b: tuple) -> tuple:
        return (a[0] + b[0] + 1, *((p + pow(x, a[0] + 1, P) * q) % P for x, p, q in zip(bases, a[1:], b[1:])))

    found = carries(local, "conv", ["pos", *NODE[1:]], compose)
    if found is None:
        return local.drop("part", "row"), local_path
    rows = [(r["part"], r["conv"], r["c_pos"] + 1, *(r[f"c_f{k}"] for k in range(LANES)),
             *(pow(b, r["c_pos"] + 1, P) for b in bases)) for r in found.collect()]
    lanes = ", ".join([f"c{k} long" for k in range(LANES)] + [f"s{k} long" for k in range(LANES)])
    carry = F.broadcast(local.sparkSession.createDataFrame(rows, f"part int, conv long, n long, {lanes}"))

    def moved(name: str, k: int) -> Column:
        added = (F.col(f"c{k}") + F.col(f"s{k}") * F.col(name)) % P
        return F.when(F.col("n").isNull(), F.col(name)).otherwise(added).cast("int").alias(name)

    whole = local.join(carry, ["part", "conv"], "left").select(
        "conv", (F.col("pos") + F.coalesce("n", F.lit(0))).alias("pos"),
        *(moved(f"f{k}", k) for k in range(LANES)), *(moved(f"p{k}", k) for k in range(LANES)), *DIGEST, "n_bytes")
    result, path = written(whole, "own-prefixes")
    drop(local, local_path)
    return result, path


def passed_nodes(own: DataFrame, bases: list[int], base_of, head_of, max_head: int) -> DataFrame:
    """``(conv, depth, f.., p.., d.., n_bytes, ends)``: the nodes that each rebuilt conversation passes, root included."""
    lanes = [*NODE[1:], *PARENT, *DIGEST]
    first = F.when(F.col("pos") < max_head, F.struct("pos", *lanes, "n_bytes"))
    firsts, _ = written(own.groupBy("conv").agg((F.max("pos") + 1).alias("size"), F.sort_array(F.collect_list(first)).alias("first")),
                        "first-turns")
    heads = firsts.select(F.col("conv").alias("base"), F.col("first").alias("head"))
    joined = (firsts.withColumns({"base": base_of(F.col("conv")), "h": head_of(F.col("conv")).cast("int")})
              .join(heads, "base", "left"))
    m = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0)))
    joined = joined.withColumn("m", F.when(F.col("head").isNull(), 0).otherwise(m))
    # lane k of the rebuilt prefix: o + s * (lane k of the own prefix), s = x^(m - h)
    shrink = [[pow(pow(b, -1, P), j, P) for j in range(max_head + 1)] for b in bases]

    def scale(k: int) -> Column:
        return F.element_at(F.array(*(F.lit(v).cast("long") for v in shrink[k])), F.col("h") - F.col("m") + 1)

    def at(turns: str, n: str, k: int) -> Column:
        return F.when(F.col(n) > 0, F.coalesce(F.get(turns, F.col(n) - 1)[f"f{k}"], F.lit(0))).otherwise(0).cast("long")

    offsets = [((at("head", "m", k) + P - scale(k) * at("first", "h", k) % P) % P).cast("int").alias(f"o{k}") for k in range(LANES)]
    length = F.col("m") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    joints, _ = written(joined.select("conv", "h", "m", length.alias("length"), *offsets,
                                      F.slice("head", 1, F.greatest(F.col("m"), F.lit(0))).alias("head")), "joints")

    ends = (F.col("depth") == F.col("length")).alias("ends")
    root = joints.select("conv", F.lit(0).cast("long").alias("depth"), *(F.lit(0).alias(c) for c in (*NODE[1:], *PARENT)),
                         *(F.lit(0).cast("long").alias(c) for c in (*DIGEST, "n_bytes")), (F.col("length") == 0).alias("ends"))
    from_base = (joints.select("conv", "length", F.explode("head").alias("t"))
                 .select("conv", "length", (F.col("t.pos") + 1).alias("depth"), *(F.col(f"t.{c}").alias(c) for c in lanes), "t.n_bytes")
                 .select("conv", "depth", *lanes, "n_bytes", ends))

    def composed(name: str, k: int) -> Column:
        return ((F.col(f"o{k}") + scale(k) * F.col(name)) % P).cast("int").alias(name)

    from_own = (own.join(joints.drop("head"), "conv").where("pos >= h")
                .select("conv", "length", (F.col("m") + F.col("pos") - F.col("h") + 1).alias("depth"),
                        *(composed(f"f{k}", k) for k in range(LANES)), *(composed(f"p{k}", k) for k in range(LANES)),
                        *DIGEST, "n_bytes")
                .select("conv", "depth", *lanes, "n_bytes", ends))
    return root.unionAll(from_base).unionAll(from_own)


def members_digest(ended: DataFrame) -> DataFrame:
    """``(depth, f.., ends_sha256)`` of ``(depth, f.., conv)``: SHA-256 of the ids, ascending, comma-joined.

    A node's members are sorted over as many tasks as they fill. Nodes that
    lie inside one task are hashed there; of the others (two per task, and
    those of over a chunk) the joined digits move on, in chunks, to be hashed
    in order as a stream: SHA-256 of one text has no parallel form.
    """
    key = np.dtype([("depth", "<i8"), *((c, "<i4") for c in NODE[1:])])
    names = [*NODE, "first", "sha", "chunk"]
    schema = ", ".join(["depth long", *(f"{c} int" for c in NODE[1:]), "first long, sha string, chunk string"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, kept, size, first, pieces, leading = None, [], 0, None, 0, True

        def flush(edge: bool):
            text = ",".join(kept)
            sha = None if edge or pieces else hashlib.sha256(text.encode()).hexdigest()
            return (*node, first, sha, text if sha is None else None)

        for batch in slices(batches, 8192):
            keys = np.empty(batch.num_rows, key)
            for k, c in enumerate(NODE):
                keys[c] = batch.column(k).to_numpy()
            convs, out = batch.column(len(NODE)).to_pylist(), []
            cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])).tolist()
            for a, b in zip(cuts, cuts[1:]):
                here = tuple(keys[a].tolist())
                if here != node:
                    if kept:
                        out.append(flush(leading))
                    leading = leading and node is None
                    node, kept, size, pieces = here, [], 0, 0
                for at in range(a, b, STEP):
                    part = convs[at:min(b, at + STEP)]
                    first = first if kept else part[0]
                    kept += map(str, part)
                    size += 20 * len(part)
                    if size >= CHUNK:
                        out.append(flush(True))
                        kept, size, pieces = [], 0, pieces + 1
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=arrow)
        if kept:
            yield pa.RecordBatch.from_pylist([dict(zip(names, flush(True)))], schema=arrow)

    arrow = pa.schema([("depth", pa.int64()), *((c, pa.int32()) for c in NODE[1:]), ("first", pa.int64()),
                       ("sha", pa.string()), ("chunk", pa.string())])
    order = [*NODE, "conv"]
    hashed, _ = written(in_order(ended.select(*order), *order).drop("part").mapInArrow(run, schema), "ends")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in slices(batches):
            out = []
            for row in batch.to_pylist():
                here = tuple(row[c] for c in NODE)
                if here != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = here, hashlib.sha256(row["chunk"].encode())
                else:
                    state.update(b"," + row["chunk"].encode())
            yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), r)) for r in out], schema=last)
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), (*node, state.hexdigest())))], schema=last)

    last = pa.schema([("depth", pa.int64()), *((c, pa.int32()) for c in NODE[1:]), ("ends_sha256", pa.string())])
    open_ones = (hashed.where("sha is null").select(*NODE, "first", "chunk").repartition(*NODE)
                 .sortWithinPartitions(*NODE, "first"))
    rest = open_ones.mapInArrow(join, ", ".join(["depth long", *(f"{c} int" for c in NODE[1:]), "ends_sha256 string"]))
    return hashed.where("sha is not null").select(*NODE, F.col("sha").alias("ends_sha256")).unionAll(rest)


def _chains(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``above``: the sum of ``weight`` over the same chain's nodes above each."""
    fields = nodes.schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held = Runs(), 0
        for batch in slices(batches, 8192):
            weight = batch.column(fields.index("weight")).to_numpy()
            start, on = runs.cut(batch.column(fields.index("conv_id")).to_numpy())
            total = running_sum(weight, start, on, held)
            held = int(total[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total), pa.array(runs.rows(batch.num_rows))],
                                             [*fields, "part", "total", "row"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields), "part int, total long, row long"])
    local, _ = written(in_order(nodes, "conv_id", "depth").mapInArrow(run, schema), "chains")
    carry = carries(local, "conv_id", ["total"], lambda a, b: (a[0] + b[0],))
    above = F.col("total") - F.col("weight")
    if carry is None:
        return local.select(*fields, above.alias("above"))
    return (local.join(carry, ["part", "conv_id"], "left")
            .select(*fields, (above + F.coalesce("c_total", F.lit(0))).alias("above")))


def draw_bases(seed: int, attempt: int) -> list[int]:
    rnd = random.Random(f"{seed}:{attempt}")
    return [rnd.randrange(1 << 16, P - 1) for _ in range(LANES)]


def _verified_rows(turns: DataFrame, base_of, head_of, max_head: int, seed: int, attempts: int):
    """The passed nodes and their groups, all groups proven equal."""
    for attempt in range(attempts):
        bases = draw_bases(seed, attempt)
        own, own_path = own_prefixes(turns, bases)
        rows, rows_path = written(passed_nodes(own, bases, base_of, head_of, max_head), "passed-nodes")
        same = [*PARENT, *DIGEST]
        groups, groups_path = written(
            rows.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"),
                                    F.max("n_bytes").alias("n_bytes"), *(F.min(c).alias(c) for c in same),
                                    *(F.max(c).alias(f"most_{c}") for c in same)), "groups")
        mixed = " or ".join(f"{c} <> most_{c}" for c in same)
        if not groups.where(mixed).limit(1).count():
            drop(rows, own_path)
            return rows, groups.select(*NODE, *PARENT, "n_convs", "conv_id", "n_bytes")
        drop(rows, own_path, rows_path, groups_path)
    raise RuntimeError("fingerprints met by chance in every attempt")


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", base_of=remainder_base, head_of=checksum_head, max_head: int = 8,
                seed: int = 11, attempts: int = 5) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    ``base_of`` and ``head_of`` map the conversation's id to the conversation
    whose head it takes and to the head's length, at most ``max_head``.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``
    (NULL for the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (over the subtree: other members times bytes of the last
    text) and ``ends_sha256`` of the members that end here.

    Turns are ordered by their number, NULL first; turns that share a number
    by the SHA-256 of role and text (repeated rows are turns of their own).
    NULL role or text counts as empty. Rows without a conversation id belong
    to none and are left out. Other columns are not read, whatever their
    names. An empty table gives no rows, not even a root.
    """
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = (conversations.where(F.col(conv_col).isNotNull())
             .select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                     F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
                     F.octet_length(text).cast("long").alias("n_bytes")))
    rows, groups = _verified_rows(turns, base_of, head_of, max_head, seed, attempts)

    children = (groups.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *(F.col(p).alias(f) for p, f in zip(PARENT, NODE[1:])))
                .agg(F.count(F.lit(1)).alias("n_children")))
    nodes, _ = written(groups.join(children, NODE, "left").select(
        *NODE, *PARENT, "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("weight")), "nodes")

    # per chain: its whole weight, and whether it ends in a leaf
    chains, _ = written(nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.sum("weight").alias("chain"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("long").alias("leaf")), "chain-sums")
    below = (rows.select("conv", *NODE).join(chains, "conv").groupBy(*NODE)
             .agg(F.sum("chain").alias("chain"), F.sum("leaf").alias("n_leaves")))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *(F.col(f).alias(p) for f, p in zip(NODE[1:], PARENT)),
                           F.col("conv_id").alias("parent_conv_id"))
    return (_chains(nodes).join(below, NODE).join(parents, ["depth", *PARENT], "left")
            .join(members_digest(rows.where("ends").select(*NODE, "conv")), NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    (F.col("chain") - F.col("above")).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256")))


__all__ = ["prefix_trie", "own_prefixes", "passed_nodes", "members_digest"]
