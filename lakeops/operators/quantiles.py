"""Exact quantiles per group with bounded memory.

Spark's exact ``percentile`` / ``percentile_disc`` keep one (value, count)
entry per distinct value of a group and merge them in the one task that
finishes the group: a hot group with unbounded distinct values (amounts, ids)
would pull an unbounded map into one task. Two ways do without:

**Sketch and bracket** (``method="exact"``, the default), two scans:

1. a mergeable sketch per group (``percentile_approx``: bounded, merged from
   map-side partials) gives, for every wanted rank, two values between which
   the rank's value lies: the sketch's quantiles a few error bounds below and
   above. A group of no more rows than the sketch's accuracy needs no bracket;
2. the second scan counts, per group and wanted rank, the rows below the
   bracket (one number) and the rows inside it by value. Both aggregate
   partially before the only shuffle; rows above the bracket go nowhere.
   Inside the bracket are 6 / accuracy of the group's rows, and a running
   count over their distinct values finds the value.

The result is proven, not assumed: if the rank did not fall into its bracket
the query fails instead of answering.

**Radix selection** (``method="radix"``), four counting passes of 16 bits of
a sortable 64-bit key over the rows counted per (group, value): every value
maps to a key that sorts like it (see ``double_key_columns``), a pass counts
rows per bucket of the next 16 bits, at most 65 536 per group, and keeps the
bucket that holds the rank. It needs no sketch and its last bucket holds one
key only, at the price of more passes.

Ranks follow Spark's (and the SQL standard's) definitions: discrete
quantile p = the value at 1-based rank max(1, ceil(p * n)); continuous
quantile p = linear interpolation between the values at 0-based ranks
floor((n - 1) * p) and ceil((n - 1) * p), with the same arithmetic as
Spark's ``percentile``. NULL values are ignored; a group without values gets
NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType

from lakeops.functions.schema import quote

DIGIT_BITS = 16
INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
MAX_PASSES = 64 // DIGIT_BITS

# Keys of the special doubles (their IEEE-754 bit patterns, as Java gives them).
_NAN_KEY = 0x7FF8000000000000
_INF_KEY = 0x7FF0000000000000


def double_key_columns(v: str) -> list[list[str]]:
    """Projections (applied in order) ending in ``__q_k``: a BIGINT key that
    sorts like the double column ``v`` (0 for NULL; callers drop NULL values).

    For a >= 0 the key is the IEEE-754 bit pattern: (biased exponent << 52) |
    mantissa. ``log2`` gives the exponent up to one unit, corrected by one
    comparison each way with the exact power of two; ``a / 2^e`` is exact, so
    are ``- 1`` and ``* 2^52``. Negative values get the negated pattern, -0.0
    and 0.0 the key 0, NaN the largest key (Spark sorts NaN last). Each step
    is its own projection so ``log2`` and ``power`` run once per row.
    """
    return [
        [f"abs({v}) AS __q_a", f"({v} >= 0D) AS __q_pos"],
        ["CASE WHEN __q_a > 0D AND __q_a < double('infinity') "
         "THEN CAST(floor(log2(__q_a)) AS INT) END AS __q_e0"],
        ["power(2D, __q_e0) AS __q_p0"],
        ["CASE WHEN __q_p0 > __q_a THEN __q_e0 - 1 WHEN __q_p0 * 2D <= __q_a THEN __q_e0 + 1 "
         "ELSE __q_e0 END AS __q_e",
         "CASE WHEN __q_p0 > __q_a THEN power(2D, __q_e0 - 1) WHEN __q_p0 * 2D <= __q_a "
         "THEN __q_p0 * 2D ELSE __q_p0 END AS __q_p"],
        [f"CASE WHEN isnan(__q_a) THEN {_NAN_KEY}L"
         f" WHEN __q_a = double('infinity') THEN {_INF_KEY}L"
         " WHEN __q_a = 0D THEN 0L"
         # subnormal: a * 2^1022 * 2^52 is the mantissa itself, exactly
         " WHEN __q_e < -1022 THEN CAST(__q_a * power(2D, 1022) * power(2D, 52) AS BIGINT)"
         " ELSE shiftleft(CAST(__q_e + 1023 AS BIGINT), 52)"
         " + CAST((__q_a / __q_p - 1D) * power(2D, 52) AS BIGINT) END AS __q_bits"],
        # non-nullable (rows with a NULL value are dropped before): joins on
        # the key infer no IS NOT NULL filter that would inline the steps above
        ["coalesce(CASE WHEN __q_pos THEN __q_bits ELSE -__q_bits END, 0L) AS __q_k"],
    ]


def with_key(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``__q_v`` = the value and ``__q_k`` = its sort key."""
    t = df.schema[column].dataType
    names = [quote(k) for k in keep]
    out = df.selectExpr(*names, f"{quote(column)} AS __q_v")
    if isinstance(t, INTEGRAL):
        return out.selectExpr("*", "coalesce(CAST(__q_v AS BIGINT), 0L) AS __q_k")
    if isinstance(t, (FloatType, DoubleType)):
        out = out.selectExpr("*", "CAST(__q_v AS DOUBLE) AS __q_dv")
        for step in double_key_columns("__q_dv"):
            out = out.selectExpr("*", *step)
        return out.selectExpr(*names, "__q_v", "__q_k")
    raise TypeError(f"exact quantiles need a numeric column, {column!r} is {t.simpleString()}")


def _targets(probs: Mapping[str, float], continuous: bool):
    """(target id, SQL of its 1-based rank from n) for every rank needed."""
    out = []
    for name, p in probs.items():
        if not 0.0 <= float(p) <= 1.0:
            raise ValueError(f"quantile {name!r}: {p} is not in [0, 1]")
        p = float(p)
        if continuous:
            out.append(f"greatest(1L, CAST(floor((__q_n - 1) * {p!r}D) AS BIGINT) + 1)")
            out.append(f"greatest(1L, CAST(ceil((__q_n - 1) * {p!r}D) AS BIGINT) + 1)")
        else:
            out.append(f"greatest(1L, CAST(ceil({p!r}D * __q_n) AS BIGINT))")
    return out


def _pick(counts: DataFrame, part: list[str]) -> DataFrame:
    """Keep, per (group, target), the bucket holding the target's rank and
    turn the rank into the rank inside that bucket."""
    w = Window.partitionBy(*part).orderBy("__q_d").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("__q_cum", F.sum("__q_c").over(w))
    return (cum.where(F.expr("__q_cum - __q_c < __q_r AND __q_r <= __q_cum"))
            .withColumn("__q_r", F.expr("__q_r - (__q_cum - __q_c)"))
            .drop("__q_cum"))


def select_ranks(df: DataFrame, column: str, probs: Mapping[str, float], by: Sequence[str] = (),
                 continuous: bool = False, bounded_groups: bool = False) -> DataFrame:
    """Long form (by..., __q_t, __q_v, __q_n): the value at every target rank.

    ``bounded_groups``: the caller knows that the groups are few by
    construction (a flag, a band), so the per-pass lookup - one row per group
    and target - is broadcast. By default no hint is given and adaptive
    execution broadcasts it when its measured size allows, else joins by
    group with skew splitting.
    """
    by = list(by)
    for b in by:
        if b.startswith("__q_"):
            raise ValueError(f"group column {b!r} uses the reserved prefix __q_")
    gb = [F.col(b) for b in by]
    vt = "double" if continuous else df.schema[column].dataType.simpleString()
    # rows per (group, value), counted once: every pass reads this same shuffle
    # (Spark reuses it), so the source is scanned once and the keys are made
    # once per distinct value and task
    values = (df.where(F.col(column).isNotNull()).groupBy(*dict.fromkeys([*by, column]))
              .agg(F.expr("count(1) AS __q_w")))
    rows = with_key(values, column, [*by, "__q_w"]).withColumn("__q_v", F.col("__q_v").cast(vt))

    def bucket_counts(frame: DataFrame, keys: list[str], shift: int) -> DataFrame:
        return (frame.groupBy(*keys, F.expr(f"shiftright(__q_k, {shift})").alias("__q_d"))
                .agg(F.expr("sum(__q_w) AS __q_c"), F.expr("min(__q_v) AS __q_m")))

    shifts = [64 - DIGIT_BITS * (j + 1) for j in range(MAX_PASSES)]     # 48, 32, 16, 0
    # pass 1: top 16 bits of the key, group sizes, then every target's bucket
    first = bucket_counts(rows, by, shifts[0])
    first = first.withColumn("__q_n", F.sum("__q_c").over(Window.partitionBy(*gb)))
    ranks = _targets(probs, continuous)
    spec = ", ".join(f"named_struct('t', {i}, 'r', {r})" for i, r in enumerate(ranks))
    first = (first.withColumn("__q_x", F.expr(f"explode(array({spec}))"))
             .withColumn("__q_t", F.col("__q_x.t")).withColumn("__q_r", F.col("__q_x.r"))
             .drop("__q_x"))
    part = by + ["__q_t"]
    found = _pick(first, part)

    # passes 2..4: the rows of the chosen bucket are those whose key has the
    # bucket's prefix - an equi-join of (group, key prefix) with one row per
    # (group, target); counted by the next 16 bits.
    keep = part + ["__q_n", "__q_r"]
    for prev, shift in zip(shifts, shifts[1:]):
        look = found.select(*[F.col(b).alias(f"__q_b{i}") for i, b in enumerate(by)],
                            F.col("__q_d").alias("__q_pfx"), "__q_t", "__q_n", "__q_r")
        if bounded_groups:
            look = F.broadcast(look)
        x = rows.withColumn("__q_pfx", F.expr(f"shiftright(__q_k, {prev})")).alias("__q_x")
        u = look.alias("__q_u")
        cond = [F.col(f"__q_x.{quote(b)}").eqNullSafe(F.col(f"__q_u.__q_b{i}")) for i, b in enumerate(by)]
        cond.append(F.col("__q_x.__q_pfx") == F.col("__q_u.__q_pfx"))
        cand = x.join(u, reduce(lambda a, b: a & b, cond), "inner").select(
            *[F.col(f"__q_x.{quote(b)}") for b in by], "__q_x.__q_k", "__q_x.__q_v", "__q_x.__q_w",
            "__q_u.__q_t", "__q_u.__q_n", "__q_u.__q_r")
        found = _pick(bucket_counts(cand, keep, shift), part)

    return found.select(*by, "__q_t", F.col("__q_m").alias("__q_v"), "__q_n")


def bracket_ranks(df: DataFrame, column: str, probs: Mapping[str, float], by: Sequence[str] = (),
                  continuous: bool = False, bounded_groups: bool = False, accuracy: int = 10_000) -> DataFrame:
    """As ``select_ranks``, by a sketch and one counting pass between its brackets."""
    by = list(by)
    for b in by:
        if b.startswith("__q_"):
            raise ValueError(f"group column {b!r} uses the reserved prefix __q_")
    names = [quote(b) for b in by]
    kind = df.schema[column].dataType
    vt = "double" if continuous else kind.simpleString()
    rows = df.where(F.col(column).isNotNull()).selectExpr(
        *names, f"CAST({quote(column)} AS {vt}) AS __q_v", f"CAST({quote(column)} AS DOUBLE) AS __q_d")
    if isinstance(kind, (FloatType, DoubleType)):
        # a sketch has no place for NaN, which sorts after infinity: it stands beside it there
        rows = rows.withColumn("__q_d", F.expr("CASE WHEN isnan(__q_d) THEN double('infinity') ELSE __q_d END"))
    ranks = _targets(probs, continuous)
    per = 2 if continuous else 1                     # ranks per quantile
    margin = 3.0 / accuracy                          # the sketch errs by one at most, neighbouring ranks by another
    points = [max(0.0, float(p) - margin) for p in probs.values()] + [min(1.0, float(p) + margin) for p in probs.values()]
    sketched = rows.groupBy(*by).agg(
        F.expr("count(1) AS __q_n"),
        F.expr(f"percentile_approx(__q_d, array({', '.join(f'{p!r}D' for p in points)}), {int(accuracy)}) AS __q_s"))
    spans = []
    for i, r in enumerate(ranks):
        at = i // per
        lo = f"__q_s[{at}]" if points[at] > 0 else "double('-infinity')"
        hi = f"__q_s[{len(probs) + at}]" if points[len(probs) + at] < 1 else "double('infinity')"
        spans.append(f"named_struct('t', {i}, 'r', {r}, "
                     f"'lo', CASE WHEN __q_n <= {int(accuracy)} THEN double('-infinity') ELSE {lo} END, "
                     f"'hi', CASE WHEN __q_n <= {int(accuracy)} THEN double('infinity') ELSE {hi} END)")
    brackets = sketched.selectExpr(*(f"{n} AS __q_b{i}" for i, n in enumerate(names)), "__q_n", f"array({', '.join(spans)}) AS __q_x")
    if by:
        look = F.broadcast(brackets) if bounded_groups else brackets
        same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__q_b{i}")) for i, b in enumerate(by)])
        met = rows.join(look, same)
    else:
        one = brackets.select(F.struct("__q_n", "__q_x").alias("__q_s")).scalar()
        met = rows.withColumn("__q_s", one).selectExpr("__q_v", "__q_d", "__q_s.__q_n AS __q_n", "__q_s.__q_x AS __q_x")
    # a NULL value stands for all rows below the bracket
    met = met.selectExpr(*names, "__q_n", "explode(transform(filter(__q_x, x -> __q_d <= x.hi), "
                         "x -> named_struct('t', x.t, 'r', x.r, 'v', CASE WHEN __q_d >= x.lo THEN __q_v END))) AS __q_e")
    met = met.selectExpr(*names, "__q_n", "__q_e.t AS __q_t", "__q_e.r AS __q_r", "__q_e.v AS __q_v")
    counts = met.groupBy(*by, "__q_n", "__q_t", "__q_r", "__q_v").agg(F.expr("count(1) AS __q_c"))
    w = Window.partitionBy(*by, "__q_t").orderBy(F.col("__q_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = (counts.withColumn("__q_cum", F.sum("__q_c").over(w))
             .groupBy(*by, "__q_t", "__q_n", "__q_r")
             .agg(F.expr("max(CASE WHEN __q_cum - __q_c < __q_r AND __q_r <= __q_cum THEN __q_v END) AS __q_m"),
                  F.expr("max(CASE WHEN __q_v IS NULL THEN __q_c ELSE 0L END) AS __q_below"),
                  F.expr("sum(__q_c) AS __q_all")))
    proven = ("CASE WHEN __q_below >= __q_r OR __q_all < __q_r "
              "THEN raise_error('a rank lies outside its bracket: use a higher accuracy') ELSE __q_m END")
    return found.selectExpr(*names, "__q_t", f"{proven} AS __q_v", "__q_n")


def exact_quantiles(df: DataFrame, column: str, probs: Mapping[str, float], by: Sequence[str] = (),
                    continuous: bool = False, bounded_groups: bool = False, ranks=select_ranks) -> DataFrame:
    """One row per group of ``by`` (exactly one row when ``by`` is empty) with
    one column per entry of ``probs``: the exact quantile of ``column``.

    ``ranks`` selects them (``select_ranks`` or ``bracket_ranks``). Discrete
    quantiles keep the column's type; continuous ones are doubles. Groups
    whose values are all NULL are absent (grouped) or NULL (global).
    """
    by = list(by)
    long = ranks(df, column, probs, by, continuous, bounded_groups)
    aggs = []
    for j, name in enumerate(probs):
        if continuous:
            lo, hi = f"max(CASE WHEN __q_t = {2 * j} THEN __q_v END)", f"max(CASE WHEN __q_t = {2 * j + 1} THEN __q_v END)"
            pos = f"((max(__q_n) - 1) * {float(probs[name])!r}D)"
            aggs.append(f"CASE WHEN floor({pos}) = ceil({pos}) OR {lo} = {hi} THEN {lo} "
                        f"ELSE (ceil({pos}) - {pos}) * {lo} + ({pos} - floor({pos})) * {hi} END "
                        f"AS {quote(name)}")
        else:
            aggs.append(f"max(CASE WHEN __q_t = {j} THEN __q_v END) AS {quote(name)}")
    if by:
        return long.groupBy(*by).agg(*[F.expr(a) for a in aggs])
    return long.selectExpr(*aggs)


def quantile_frame(df: DataFrame, column: str, probs: Mapping[str, float], by: Sequence[str] = (),
                   method: str = "exact", accuracy: int = 10_000, continuous: bool = False,
                   bounded_groups: bool = False) -> DataFrame:
    """Quantiles of ``column`` per group of ``by`` (one row when ``by`` is empty).

    Methods (all but ``approx`` exact, with equal results):

    * ``exact`` (default): sketch and bracket, for any numeric type; two
      scans, bounded memory whatever the group's size or distinct values.
    * ``radix``: the radix selection - four passes, no sketch; integer and
      floating-point columns.
    * ``disc``: Spark's ``percentile_disc`` / ``percentile`` in one
      aggregate; its buffer holds one entry per distinct value of a group.
    * ``approx``: ``percentile_approx`` with ``accuracy`` - one pass,
      bounded buffer, rank error up to n / accuracy.
    """
    if method == "exact":
        def within(*args):
            return bracket_ranks(*args, accuracy=accuracy)
        return exact_quantiles(df, column, probs, by, continuous, bounded_groups, within)
    if method == "radix":
        return exact_quantiles(df, column, probs, by, continuous, bounded_groups)
    c, t = quote(column), df.schema[column].dataType.simpleString()
    aggs = []
    for name, p in probs.items():
        p = float(p)
        if method == "disc":
            e = (f"percentile({c}, {p!r}D)" if continuous
                 else f"CAST(percentile_disc({p!r}D) WITHIN GROUP (ORDER BY {c}) AS {t})")
        elif method == "approx":
            e = f"percentile_approx({c}, {p!r}D, {int(accuracy)})"
            e = f"CAST({e} AS DOUBLE)" if continuous else e
        else:
            raise ValueError(f"unknown quantile method {method!r}")
        aggs.append(F.expr(f"{e} AS {quote(name)}"))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def attach_groups(main: DataFrame, quantiles: DataFrame, by: Sequence[str],
                  bounded_groups: bool = False) -> DataFrame:
    """``main`` (one row per group) with the quantile columns of its group;
    NULL-safe on the group keys (a NULL flag is a group of its own)."""
    by = list(by)
    q = quantiles.select(*[F.col(b).alias(f"__q_j{i}") for i, b in enumerate(by)],
                         *[c for c in quantiles.columns if c not in by])
    if bounded_groups:
        q = F.broadcast(q)
    cond = reduce(lambda a, b: a & b, [main[b].eqNullSafe(q[f"__q_j{i}"]) for i, b in enumerate(by)])
    return main.join(q, cond, "left").drop(*[f"__q_j{i}" for i in range(len(by))])


def attach_row(main: DataFrame, one_row: DataFrame) -> DataFrame:
    """``main`` with the columns of a one-row frame, as one scalar subquery
    (evaluated once, inlined as a literal; no join)."""
    s = one_row.select(F.struct(*one_row.columns).alias("__q_s")).scalar()
    return main.withColumns({c: s[c] for c in one_row.columns})
