"""One counting cube, and the counting reports as roll-ups of it.

``trip_cube`` reads the typed trips once and counts them on the finest keys
that any counting report groups by: service, vendor, subtype, flag, payment
type, delivered month, corrected date and timestamp problem. Its measures
are additive (counts) or minima and maxima, so every report is a sum over
fewer keys. The cube's size follows from the keys' domains (a few thousand
cells a month), not from the rows: written once, it serves all reports
without another scan of the trips. Partial aggregation makes a vendor or
service with most of the rows a buffer per task, like any other.

The reports equal the operators of ``audit`` and ``quality`` on the trips,
names, types and NULLs included (a sum of sums is NULL where all rows were).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import expressions as X
from lakeops.functions import labels as L
from lakeops.functions.schema import AMOUNT_COMPONENTS, quote, sql_literal
from lakeops.operators.quality import period_condition

SERVICE, VENDOR, SUBTYPE, FLAG, PAYMENT = "tipo", "VendorID", "trip_type", "store_and_fwd_flag", "payment_type"
KEYS = (SERVICE, VENDOR, SUBTYPE, FLAG, PAYMENT, "year", "month", "data_corrida", "problema_timestamp")


def trip_cube(typed: DataFrame, value: str = "passenger_count", amount: str = "total_amount",
              start: str = "pickup_datetime", end: str = "dropoff_datetime",
              components: Sequence[str] = AMOUNT_COMPONENTS, tolerance: float = L.RECOMPOSE_TOLERANCE) -> DataFrame:
    """Counts of typed trips (date parts of the delivered start, nothing repaired yet) per cell of ``KEYS``.

    ``year`` and ``month`` are the delivered ones; ``data_corrida`` is the
    date of the corrected start, min(start, end).
    """
    s, e, a = quote(start), quote(end), quote(amount)
    rows = typed.selectExpr(
        *(quote(k) for k in KEYS[:-2]), f"to_date(least({s}, {e})) AS data_corrida", f"{X.timestamp_problem_sql(start, end)} AS problema_timestamp",
        f"{quote(value)} AS _value", f"{a} AS _amount", f"{s} AS _s", f"{e} AS _e", f"{e} < {s} AS _inv",
        f"{X.duration_minutes_sql(end, start)} AS _gap", "least({0}, {1}) AS _first".format(s, e), "greatest({0}, {1}) AS _last".format(s, e),
        f"CASE WHEN {a} < 0 THEN abs({a} - {X.recomposed_total_sql(components)}) <= {float(tolerance)!r}D END AS _adds_up")
    measures = {
        "registros": "count(1)",
        "valor_nulo": X.count_if_sql("_value IS NULL"),
        "valor_zero": X.count_if_sql("_value = 0"),
        "ate_1_min": X.count_if_sql("_inv AND _gap <= 1"),
        "de_1_a_5_min": X.count_if_sql("_inv AND _gap > 1 AND _gap <= 5"),
        "de_5_a_60_min": X.count_if_sql("_inv AND _gap > 5 AND _gap <= 60"),
        "acima_60_min": X.count_if_sql("_inv AND _gap > 60"),
        "ainda_invertidos": X.count_if_sql("_last < _first"),
        "pickup_alterado": X.count_if_sql("_s <> _first"),
        "dropoff_alterado": X.count_if_sql("_e <> _last"),
        "negativos": X.count_if_sql("_amount < 0"),
        "negativos_min": "min(CASE WHEN _amount < 0 THEN _amount END)",
        "negativos_max": "max(CASE WHEN _amount < 0 THEN _amount END)",
        "negativos_sem_diferenca": X.count_if_sql("_adds_up"),
    }
    return rows.groupBy(*KEYS).agg(*(F.expr(f"{e} AS {name}") for name, e in measures.items()))


def _total(name: str, alias: str | None = None) -> str:
    return f"sum({name}) AS {alias or name}"


def _rolled(cube: DataFrame, by: Sequence[str], *totals: str) -> DataFrame:
    return cube.groupBy(*by).agg(*map(F.expr, totals))


def rows_by_source(cube: DataFrame, total_label: str = "total") -> DataFrame:
    return (cube.rollup(SERVICE).agg(F.expr(_total("registros")), F.expr(f"grouping({SERVICE}) AS _g"))
            .selectExpr(f"CASE WHEN _g = 1 THEN {sql_literal(total_label)} ELSE {SERVICE} END AS fonte",
                        "coalesce(registros, 0L) AS registros"))


def volume_by(cube: DataFrame, column: str = VENDOR) -> DataFrame:
    return _rolled(cube, [column], _total("registros", "total_registros"))


def rates_by(cube: DataFrame, dim: str, measure: str, name: str, service: str | None = None) -> DataFrame:
    """Rows, rows with the measured value (``valor_nulo`` or ``valor_zero``) and their percentage, per ``dim``."""
    cells = cube if service is None else cube.where(F.col(SERVICE) == service)
    return (_rolled(cells, [dim], _total("registros", "total"), _total(measure, name))
            .withColumn(f"pct_{name}", X.pct(F.col(name), F.col("total"))))


def rate_bundle(cube: DataFrame, column: str = "passenger_count", subtype_service: str = "green") -> DataFrame:
    """The NULL and zero rates by vendor, by subtype (one service) and by flag, in long form: one pass over the cells."""
    cells = cube.selectExpr(
        f"explode(filter(array(named_struct('d', '{VENDOR}', 'v', CAST({VENDOR} AS STRING)), "
        f"CASE WHEN {SERVICE} = {sql_literal(subtype_service)} THEN named_struct('d', '{SUBTYPE}', 'v', CAST({SUBTYPE} AS STRING)) END, "
        f"named_struct('d', '{FLAG}', 'v', CAST({FLAG} AS STRING))), x -> x IS NOT NULL)) AS x",
        "registros", "valor_nulo", "valor_zero")
    out = _rolled(cells.selectExpr("x.d AS dimensao", "x.v AS valor", "registros", "valor_nulo", "valor_zero"), ["dimensao", "valor"],
                  _total("registros", "total"), _total("valor_nulo", f"{column}_nulo"), _total("valor_zero", f"{column}_zero"))
    return out.withColumns({f"pct_{column}_{k}": X.pct(F.col(f"{column}_{k}"), F.col("total")) for k in ("nulo", "zero")})


def timestamp_problems(cube: DataFrame) -> DataFrame:
    return _rolled(cube.where(F.expr(f"problema_timestamp <> {sql_literal(L.VALID)}")), ["year", "month", "problema_timestamp"],
                   _total("registros", "total_registros"))


def timestamp_bundle(cube: DataFrame) -> DataFrame:
    """One row: inverted trips, those with a flag, gap buckets, still inverted and changed after the correction."""
    inverted = f"problema_timestamp = {sql_literal(L.DROPOFF_BEFORE_PICKUP)}"
    return cube.selectExpr(
        f"coalesce(sum(CASE WHEN {inverted} THEN registros END), 0L) AS total_inconsistentes",
        f"coalesce(sum(CASE WHEN {inverted} AND {FLAG} IS NOT NULL THEN registros END), 0L) AS store_and_fwd_flag_preenchido",
        *map(_total, ("ate_1_min", "de_1_a_5_min", "de_5_a_60_min", "acima_60_min", "ainda_invertidos", "pickup_alterado",
                      "dropoff_alterado")))


def period_scope_counts(cube: DataFrame, months, mode: str = "range") -> DataFrame:
    flagged = cube.withColumn("fora_do_periodo", ~period_condition(months, "data_corrida", mode))
    return _rolled(flagged, ["fora_do_periodo"], _total("registros", "total"))


def _corrected_month(cube: DataFrame) -> DataFrame:
    return cube.withColumns({"year": F.expr("year(data_corrida)"), "month": F.expr("month(data_corrida)")})


def out_of_period_detail(cube: DataFrame, months, mode: str = "range") -> DataFrame:
    outside = _corrected_month(cube).where(~period_condition(months, "data_corrida", mode))
    return _rolled(outside, [SERVICE, "year", "month"], _total("registros", "total"))


def scoped(cube: DataFrame, months, mode: str = "range") -> DataFrame:
    """The cells inside the period, with the corrected date's year and month."""
    return _corrected_month(cube).where(period_condition(months, "data_corrida", mode))


def negatives_summary(cells: DataFrame) -> DataFrame:
    return cells.selectExpr("coalesce(sum(negativos), 0L) AS total_negativos", "min(negativos_min) AS valor_minimo",
                            "max(negativos_max) AS valor_maximo")


def negatives_by(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Negative trips per group (groups without any absent)."""
    return _rolled(cells.where("negativos > 0"), by, _total("negativos", "count"))


def negatives_by_vendor(cells: DataFrame) -> DataFrame:
    return _rolled(cells, [VENDOR], _total("negativos", "total_negativos"))


def recompose_check(cells: DataFrame) -> DataFrame:
    """Negative trips whose components add up, and those whose do not."""
    parts = (f"stack(2, {sql_literal(L.RECOMPOSE_OK)}, negativos_sem_diferenca, "
             f"{sql_literal(L.RECOMPOSE_DIFF)}, negativos - negativos_sem_diferenca) AS (validacao, n)")
    return _rolled(cells.where("negativos > 0").selectExpr(parts).where("n > 0"), ["validacao"], _total("n", "count"))
