"""Column builders shared by the operators (all JVM-side, codegen-friendly).

Expressions are written as Spark SQL text and turned into a Column with one
``F.expr`` call: the same Catalyst expression as the equivalent chain of
``F.*`` calls, built with one call to the JVM instead of one per node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions import labels as L
from lakeops.functions.schema import quote, sql_literal


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_if(pred: Column) -> Column:
    """Count of rows where ``pred`` is true (NULL counts as not true)."""
    return F.sum(pred.cast("int"))


def count_if_sql(pred: str) -> str:
    """SQL text of ``count_if``: NULL when every row of the group is NULL."""
    return f"sum(CAST(({pred}) AS INT))"


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part / whole * 100, digits)


def duration_minutes_sql(start: str, end: str) -> str:
    """Whole-second difference ``end - start`` in minutes, as a double."""
    return f"((unix_timestamp({quote(end)}) - unix_timestamp({quote(start)})) / 60.0D)"


def duration_minutes(start: str, end: str) -> Column:
    return F.expr(duration_minutes_sql(start, end))


def duration_band_sql(minutes: str) -> str:
    m = quote(minutes)
    whens = " ".join(f"WHEN {m} < {upper} THEN {sql_literal(label)}" for upper, label in L.DURATION_BANDS)
    return f"CASE {whens} ELSE {sql_literal(L.DURATION_BAND_LAST)} END"


def duration_band(minutes: str) -> Column:
    return F.expr(duration_band_sql(minutes))


def timestamp_problem_sql(start: str, end: str) -> str:
    s, e = quote(start), quote(end)
    return (f"CASE WHEN {s} IS NULL THEN {sql_literal(L.PICKUP_NULL)} "
            f"WHEN {e} IS NULL THEN {sql_literal(L.DROPOFF_NULL)} "
            f"WHEN {e} < {s} THEN {sql_literal(L.DROPOFF_BEFORE_PICKUP)} "
            f"ELSE {sql_literal(L.VALID)} END")


def timestamp_problem(start: str, end: str) -> Column:
    return F.expr(timestamp_problem_sql(start, end))


def recomposed_total_sql(components: Sequence[str]) -> str:
    """Sum of the components with NULL read as 0.0, added left to right."""
    return "(" + " + ".join(f"coalesce({quote(c)}, 0.0D)" for c in components) + ")"


def recomposed_total(components: Sequence[str]) -> Column:
    return F.expr(recomposed_total_sql(components))


def outside(value: str | Column, lower: Column, upper: Column) -> Column:
    v = col(value)
    return (v < lower) | (v > upper)


# Accuracy of percentile_approx when the approximate quantile method is
# chosen (Spark's default; 1/accuracy is the relative rank error).
APPROX_ACCURACY = 10_000
