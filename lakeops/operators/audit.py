"""Structural and value-quality audits.

All reports are small aggregates. Each groupBy runs partial aggregation on
the executors before the shuffle, so a value held by a third of all rows
(a hot vendor, a NULL flag) costs one buffer per task, not a hot reducer.
Reports are informative: nothing here changes or removes rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeops.functions import expressions as X
from lakeops.functions.schema import quote, sql_literal, try_cast_sql
from lakeops.operators.quality import DEFAULT_ACCURACY, DEFAULT_METHOD
from lakeops.operators.quantiles import attach_groups, quantile_frame
from lakeops.session import scratch_path


# --------------------------------------------------------------------------
# counts, duplicates, volumes
# --------------------------------------------------------------------------

def rows_by_source(df: DataFrame, source: str = "tipo", total_label: str = "total") -> DataFrame:
    """Rows per source plus a total row: a rollup of the counts, so no row is read or moved twice."""
    q = quote(source)
    return (df.groupBy(source).agg(F.expr("count(1) AS _n")).rollup(source)
            .agg(F.expr("coalesce(sum(_n), 0L) AS registros"), F.expr(f"grouping({q}) AS _g"))
            .selectExpr(f"CASE WHEN _g = 1 THEN {sql_literal(total_label)} ELSE {q} END AS fonte",
                        "registros"))


# pairs of hashes seen more than once that may be broadcast (16 bytes each, about 64 MB)
BROADCAST_PAIRS = 4_000_000


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Total rows, distinct full rows and the difference, as one row.

    Two phases. The first counts rows per pair of 64-bit hashes and writes
    the pairs seen more than once below the shared checkpoint folder (it runs
    now); rows of all other pairs are distinct. The second compares in full
    only the rows of the written pairs, found in place: see ``_repeated``.
    """
    marked, twice, once = _hash_pairs(df, df.columns)
    doubtful = _repeated(marked, twice).groupBy(*df.columns).agg(F.expr("count(1) AS _n"))
    parts = doubtful.selectExpr("_n AS r", "1L AS d")
    return (parts.selectExpr(f"coalesce(sum(r), 0L) + {once}L AS registros", f"coalesce(sum(d), 0L) + {once}L AS registros_distintos")
            .selectExpr("registros", "registros_distintos", "registros - registros_distintos AS duplicados"))


def key_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Groups of the logical key that occur more than once.

    As in ``exact_duplicates``, keys are shuffled only where their hashes repeat.
    """
    marked, twice, _ = _hash_pairs(df.select(*key), key)
    return (_repeated(marked, twice).groupBy(*key).agg(F.expr("count(1) AS count"))
            .where(F.expr("count > 1")))


def _hash_pairs(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame, int]:
    """``df`` with two hashes of ``columns``, the pairs seen more than once (written), and the number of the others."""
    cols = ", ".join(quote(c) for c in columns)
    marked = df.selectExpr("*", f"xxhash64({cols}) AS _h1", f"xxhash64('second', {cols}) AS _h2")
    sizes = marked.groupBy("_h1", "_h2").agg(F.expr("count(1) AS _n"))
    seen = Observation("hash_pairs")
    path = scratch_path(df.sparkSession, "repeated-hashes")
    (sizes.observe(seen, F.expr("count(1) AS pairs"), F.expr("count_if(_n = 1) AS once"))
     .where("_n > 1").select("_h1", "_h2").write.parquet(path))
    return marked, df.sparkSession.read.schema("_h1 long, _h2 long").parquet(path), int(seen.get["once"])


def _repeated(marked: DataFrame, twice: DataFrame) -> DataFrame:
    """Rows of ``marked`` whose pair is in ``twice``, without moving any other row in full.

    Few pairs are broadcast (their number is known by now). Beyond that a
    bit map of the pairs, of a fixed 64 MB, is broadcast: it keeps a row of no
    written pair out of the shuffle but for chance hits, and the join that
    follows is exact.
    """
    pairs = twice.count()
    if pairs <= BROADCAST_PAIRS:
        return marked.join(F.broadcast(twice), ["_h1", "_h2"], "left_semi")
    return _in_bit_map(marked, twice).join(twice, ["_h1", "_h2"], "left_semi")


MAP_ROWS = 1 << 14                  # of 4 KB each (32 768 bits), as bitmap_construct_agg makes them


def _in_bit_map(marked: DataFrame, twice: DataFrame) -> DataFrame:
    """Rows of ``marked`` whose first hash falls on a set bit of the map of the first hashes of ``twice``."""
    row = f"pmod(shiftrightunsigned(_h1, 15), {MAP_ROWS}L)"
    held = (twice.selectExpr(f"{row} AS _row", "CAST(_h1 & 32767 AS INT) AS _bit").distinct()
            .groupBy("_row").agg(F.expr("bitmap_construct_agg(_bit) AS _map")))
    byte = "CAST(conv(hex(substring(_map, _bit DIV 8 + 1, 1)), 16, 10) AS INT)"
    return (marked.selectExpr("*", f"{row} AS _row", "CAST(_h1 & 32767 AS INT) AS _bit").join(F.broadcast(held), "_row")
            .where(f"getbit({byte}, _bit % 8) = 1").drop("_row", "_bit", "_map"))


def volume_by(df: DataFrame, column: str = "VendorID") -> DataFrame:
    return df.groupBy(column).agg(F.expr("count(1) AS total_registros"))


def value_distribution(df: DataFrame, column: str = "passenger_count") -> DataFrame:
    """Frequency of each value, NULL and 0 included."""
    return df.groupBy(column).agg(F.expr("count(1) AS count"))


# --------------------------------------------------------------------------
# rates and stats by flag
# --------------------------------------------------------------------------

def rate_by(df: DataFrame, dim: str, predicate: Column, name: str,
            where: Column | None = None, digits: int = 2) -> DataFrame:
    """Per ``dim``: total rows, rows where ``predicate`` holds, and the percentage."""
    if where is not None:
        df = df.where(where)
    return (df.groupBy(dim)
            .agg(F.count(F.lit(1)).alias("total"), X.count_if(predicate).alias(name))
            .withColumn(f"pct_{name}", X.pct(F.col(name), F.col("total"), digits)))


def null_rate_by(df: DataFrame, dim: str, column: str = "passenger_count",
                 where: Column | None = None) -> DataFrame:
    return rate_by(df, dim, F.col(column).isNull(), f"{column}_nulo", where)


def zero_rate_by(df: DataFrame, dim: str, column: str = "passenger_count",
                 where: Column | None = None) -> DataFrame:
    return rate_by(df, dim, F.col(column) == 0, f"{column}_zero", where)


def stats_by_flag(df: DataFrame, flag: Column, flag_name: str, value: str = "total_amount",
                  method: str = DEFAULT_METHOD, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Per value of a (three-valued) flag: rows, mean and median.

    At most three groups (true, false, NULL), so the median's lookups are
    broadcast; a group holding most rows is still split over every task.
    """
    flagged = df.withColumn(flag_name, flag)
    main = flagged.groupBy(flag_name).agg(F.count(F.lit(1)).alias("total"),
                                          F.avg(value).alias(f"{value}_medio"))
    med = quantile_frame(flagged, value, {f"{value}_mediano": 0.5}, [flag_name], method, accuracy,
                         bounded_groups=True)
    return attach_groups(main, med, [flag_name], bounded_groups=True)


def amount_by_null_flag(df: DataFrame, column: str = "passenger_count", value: str = "total_amount",
                        method: str = DEFAULT_METHOD, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    return stats_by_flag(df, F.col(column).isNull(), f"{column}_nulo", value, method, accuracy)


def amount_by_zero_flag(df: DataFrame, column: str = "passenger_count", value: str = "total_amount",
                        method: str = DEFAULT_METHOD, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    return stats_by_flag(df, F.col(column) == 0, f"{column}_zero", value, method, accuracy)


# --------------------------------------------------------------------------
# cast loss
# --------------------------------------------------------------------------

def cast_loss(frames: DataFrame | Sequence[DataFrame], schema: Mapping[str, str]) -> DataFrame:
    """Per column: non-NULL values before and after ``try_cast`` to the target.

    Several frames (files whose types differ) are measured each in its own
    types and added up per column: no union coerces a value before it is
    counted. A column that a frame lacks adds nothing.
    """
    frames = [frames] if isinstance(frames, DataFrame) else list(frames)
    counts = reduce(DataFrame.unionAll, [_cast_counts(df, schema) for df in frames])
    return (counts.groupBy("coluna").agg(F.expr("sum(antes) AS antes"), F.expr("sum(depois) AS depois"))
            .selectExpr("coluna", "antes", "depois", "antes - depois AS perdidos",
                        "CASE WHEN antes > 0 THEN round((antes - depois) / antes * 100, 4) ELSE 0.0D END AS pct_perdido"))


def _cast_counts(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """``(coluna, antes, depois)`` of one frame.

    One scan: both counts are computed side by side in a single aggregate, then
    unpivoted to one row per column. Run it on the raw columns (before any
    adapter cast) so that losses in those casts are visible too.
    """
    cols = [c for c in schema if c in df.columns]
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(f"count({quote(c)}) AS b{i}")
        aggs.append(f"count({try_cast_sql(df, c, schema[c])}) AS a{i}")
    wide = df.selectExpr(*aggs)          # a global aggregate, one JVM call
    stack = ", ".join(f"{sql_literal(c)}, b{i}, a{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (coluna, antes, depois)")
