"""Repairs and the reports that justify them.

Repairs: median imputation, start/end ordering, period scoping. Reports:
timestamp problems, outliers by IQR and duration band, negative amounts and
whether their components add up. None caches; all are lazy.

The imputation median is a scalar subquery (``DataFrame.scalar()``): Spark
evaluates the one-row aggregate once, with partial aggregation on every
executor, and inlines the value. So are the IQR bounds, unless the caller
passes ``bounds``; the silver job computes them once for its reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions import labels as L
from lakeops.functions import expressions as X
from lakeops.functions.periods import month_bounds, month_tuple, validate_months
from lakeops.functions.schema import AMOUNT_COMPONENTS, quote, sql_literal
from lakeops.operators.quantiles import attach_groups, attach_row, quantile_frame

# Quantiles are exact by default (``method="exact"``: sketch and bracket,
# memory bounded per group); ``method="disc"`` is Spark's percentile_disc /
# percentile, ``method="approx"`` percentile_approx with this accuracy.
DEFAULT_METHOD = "exact"
DEFAULT_ACCURACY = X.APPROX_ACCURACY


# --------------------------------------------------------------------------
# date parts and timestamp ordering
# --------------------------------------------------------------------------

def add_date_parts(df: DataFrame, ts: str, date_col: str = "data_corrida",
                   year_col: str = "year", month_col: str = "month") -> DataFrame:
    """Derive a date, its year and its month (ints) from a timestamp."""
    t = quote(ts)
    return df.withColumns({date_col: F.expr(f"to_date({t})"), year_col: F.expr(f"year({t})"),
                           month_col: F.expr(f"month({t})")})


def order_timestamps(df: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime",
                     out_start: str = "pickup_datetime_tratado",
                     out_end: str = "dropoff_datetime_tratado",
                     date_col: str = "data_corrida", year_col: str = "year",
                     month_col: str = "month") -> DataFrame:
    """Corrected start = least(start, end), end = greatest; re-derive date parts.

    ``least``/``greatest`` skip NULLs, so a single missing endpoint makes both
    corrected values equal the present one. The date parts are recomputed from
    the corrected start, so an inverted trip crossing midnight lands on the
    right day and partition.
    """
    s, e = quote(start), quote(end)
    df = df.withColumns({out_start: F.expr(f"least({s}, {e})"), out_end: F.expr(f"greatest({s}, {e})")})
    return add_date_parts(df, out_start, date_col, year_col, month_col)


def label_timestamp_problems(df: DataFrame, start: str = "pickup_datetime",
                             end: str = "dropoff_datetime",
                             out: str = "problema_timestamp") -> DataFrame:
    return df.withColumn(out, X.timestamp_problem(start, end))


def timestamp_problems(df: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime",
                       by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Rows with a NULL endpoint or end < start, counted by month and problem."""
    labelled = label_timestamp_problems(df, start, end)
    return (labelled.where(F.expr(f"problema_timestamp <> {sql_literal(L.VALID)}"))
            .groupBy(*by, "problema_timestamp")
            .agg(F.expr("count(1) AS total_registros")))


def inverted_flag_fill(df: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime",
                       flag: str = "store_and_fwd_flag") -> DataFrame:
    """Inverted rows and how many of them have ``flag`` filled."""
    return (df.where(F.expr(f"{quote(end)} < {quote(start)}"))
            .selectExpr("count(1) AS total_inconsistentes",
                        f"count({quote(flag)}) AS store_and_fwd_flag_preenchido"))


def inverted_gap_buckets(df: DataFrame, start: str = "pickup_datetime",
                         end: str = "dropoff_datetime") -> DataFrame:
    """Inverted rows by size of the gap: <=1, (1,5], (5,60], >60 minutes."""
    return (df.where(F.expr(f"{quote(end)} < {quote(start)}"))
            .selectExpr(f"{X.duration_minutes_sql(end, start)} AS gap")
            .selectExpr(f"{X.count_if_sql('gap <= 1')} AS ate_1_min",
                        f"{X.count_if_sql('gap > 1 AND gap <= 5')} AS de_1_a_5_min",
                        f"{X.count_if_sql('gap > 5 AND gap <= 60')} AS de_5_a_60_min",
                        f"{X.count_if_sql('gap > 60')} AS acima_60_min"))


def inverted_residual(df: DataFrame, start: str = "pickup_datetime_tratado",
                      end: str = "dropoff_datetime_tratado") -> DataFrame:
    """Rows still inverted after the correction (expected 0), as one row."""
    return df.selectExpr(f"{X.count_if_sql(f'{quote(end)} < {quote(start)}')} AS ainda_invertidos")


def timestamps_changed(df: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime",
                       out_start: str = "pickup_datetime_tratado",
                       out_end: str = "dropoff_datetime_tratado") -> DataFrame:
    return df.selectExpr(
        f"{X.count_if_sql(f'{quote(start)} <> {quote(out_start)}')} AS pickup_alterado",
        f"{X.count_if_sql(f'{quote(end)} <> {quote(out_end)}')} AS dropoff_alterado")


# --------------------------------------------------------------------------
# imputation
# --------------------------------------------------------------------------

def valid_median(df: DataFrame, column: str, method: str = DEFAULT_METHOD,
                 accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """One-row frame: median of the values > 0 (lower middle for an even count)."""
    return quantile_frame(df.where(F.expr(f"{quote(column)} > 0")), column, {"mediana": 0.5},
                          method=method, accuracy=accuracy)


def impute_median(df: DataFrame, column: str = "passenger_count", out: str | None = None,
                  method: str = DEFAULT_METHOD, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Replace NULL or 0 in ``column`` by the median of its values > 0.

    The median comes from the same batch (it depends on which rows are in the
    frame). When no value is > 0 the median is NULL and the column is left as
    it is, so the residual report shows the NULLs/zeros instead of failing.
    """
    median = valid_median(df, column, method, accuracy).scalar()
    c = F.col(column)
    missing = c.isNull() | (c == 0)
    replaced = F.when(missing, F.coalesce(median.cast(df.schema[column].dataType), c)).otherwise(c)
    return df.withColumn(out or column, replaced)


def impute_before_after(df: DataFrame, column: str = "passenger_count",
                        method: str = DEFAULT_METHOD, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Mean and median of ``column`` before and after imputation, one pass."""
    after = f"{column}__imputed"
    imputed = impute_median(df, column, out=after, method=method, accuracy=accuracy)
    means = imputed.agg(F.avg(column).alias("media_antes"), F.avg(after).alias("media_depois"))
    # both medians in one selection: the two columns stacked, grouped by side
    stacked = imputed.selectExpr(f"stack(2, 0, {quote(column)}, 1, {quote(after)}) AS (__side, __val)")
    med = quantile_frame(stacked, "__val", {"m": 0.5}, ["__side"], method, accuracy, bounded_groups=True)
    med = med.selectExpr("max(CASE WHEN __side = 0 THEN m END) AS mediana_antes",
                         "max(CASE WHEN __side = 1 THEN m END) AS mediana_depois")
    return attach_row(means, med).select("media_antes", "mediana_antes", "media_depois",
                                         "mediana_depois")


def impute_residual(df: DataFrame, column: str = "passenger_count") -> DataFrame:
    c = quote(column)
    return df.selectExpr(f"{X.count_if_sql(f'{c} IS NULL')} AS nulos_remanescentes",
                         f"{X.count_if_sql(f'{c} = 0')} AS zeros_remanescentes")


# --------------------------------------------------------------------------
# period scoping
# --------------------------------------------------------------------------

def period_condition(months, date_col: str = "data_corrida", mode: str = "range") -> Column:
    """True inside the requested period, NULL for a NULL date.

    ``range``: ``[first day of min month, first day after max month)`` - a
    month inside a gap of the list counts as inside. ``exact``: only the
    listed months.
    """
    d = quote(date_col)
    if mode == "range":
        lo, hi = month_bounds(months)
        return F.expr(f"({d} >= DATE '{lo.isoformat()}' AND {d} < DATE '{hi.isoformat()}')")
    if mode == "exact":
        keys = [y * 100 + m for y, m in (month_tuple(s) for s in validate_months(months))]
        return F.expr(f"(year({d}) * 100 + month({d})) IN ({', '.join(map(str, keys))})")
    raise ValueError(f"unknown period mode {mode!r}")


def flag_out_of_period(df: DataFrame, months, date_col: str = "data_corrida",
                       out: str = "fora_do_periodo", mode: str = "range") -> DataFrame:
    return df.withColumn(out, ~period_condition(months, date_col, mode))


def filter_period(df: DataFrame, months, date_col: str = "data_corrida",
                  mode: str = "range") -> DataFrame:
    """Keep rows inside the period; NULL dates are dropped."""
    return df.where(period_condition(months, date_col, mode))


def period_scope_counts(df: DataFrame, months, date_col: str = "data_corrida",
                        mode: str = "range") -> DataFrame:
    flagged = flag_out_of_period(df, months, date_col, mode=mode)
    return flagged.groupBy("fora_do_periodo").agg(F.expr("count(1) AS total"))


def out_of_period_detail(df: DataFrame, months, date_col: str = "data_corrida",
                         by: Sequence[str] = ("tipo", "year", "month"),
                         mode: str = "range") -> DataFrame:
    return (df.where(~period_condition(months, date_col, mode))
            .groupBy(*by).agg(F.expr("count(1) AS total")))


# --------------------------------------------------------------------------
# IQR outliers and duration bands
# --------------------------------------------------------------------------

def numeric_summary(df: DataFrame, column: str = "total_amount", method: str = DEFAULT_METHOD,
                    accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """count, mean, stddev, min, quartiles, max of one column, typed."""
    c = quote(column)
    main = df.selectExpr(f"count({c}) AS count", f"avg({c}) AS mean", f"stddev_samp({c}) AS stddev",
                         f"min({c}) AS min", f"max({c}) AS max")
    q = quantile_frame(df, column, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, method=method,
                       accuracy=accuracy)
    return attach_row(main, q).select("count", "mean", "stddev", "min", "p25", "p50", "p75", "max")


def iqr_bounds(df: DataFrame, column: str = "total_amount", factor: float = 1.5,
               method: str = DEFAULT_METHOD, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """One row: q1, q3, iqr, lower = q1 - factor*iqr, upper = q3 + factor*iqr."""
    q = quantile_frame(df, column, {"q1": 0.25, "q3": 0.75}, method=method, accuracy=accuracy)
    return iqr_from_quartiles(q, factor)


def iqr_from_quartiles(q: DataFrame, factor: float = 1.5) -> DataFrame:
    """The bounds row from a frame with quartile columns ``q1`` and ``q3``."""
    f = f"CAST({float(factor)!r} AS DOUBLE)"
    return q.selectExpr("q1", "q3", "q3 - q1 AS iqr", f"q1 - {f} * (q3 - q1) AS limite_inferior",
                        f"q3 + {f} * (q3 - q1) AS limite_superior")


def flag_outliers(df: DataFrame, column: str = "total_amount", out: str = "outlier",
                  factor: float = 1.5, method: str = DEFAULT_METHOD,
                  accuracy: int = DEFAULT_ACCURACY,
                  bounds_from: DataFrame | None = None, bounds: tuple | None = None) -> DataFrame:
    """Boolean ``out``: value outside the IQR bounds (NULL value -> NULL).

    ``bounds`` (lower, upper) are used as given; otherwise they are those of
    ``bounds_from`` (default: ``df``), a scalar subquery that Spark runs once
    and shares between the scans of one plan. No job runs here.
    """
    if bounds is None:
        found = iqr_bounds(bounds_from if bounds_from is not None else df, column, factor, method, accuracy)
        both = found.select(F.struct("limite_inferior", "limite_superior").alias("b")).scalar()
        bounds = (both["limite_inferior"], both["limite_superior"])
    else:
        bounds = tuple(F.lit(b) for b in bounds)
    lo, hi = (b.cast("double") for b in bounds)
    return df.withColumn(out, X.outside(F.col(column).cast("double"), lo, hi))


def iqr_outlier_counts(df: DataFrame, column: str = "total_amount",
                       method: str = DEFAULT_METHOD, accuracy: int = DEFAULT_ACCURACY,
                       bounds: tuple | None = None) -> DataFrame:
    return (flag_outliers(df, column, method=method, accuracy=accuracy, bounds=bounds)
            .groupBy("outlier").agg(F.expr("count(1) AS count")))


def top_outliers(df: DataFrame, column: str = "total_amount", k: int = 20,
                 columns: Sequence[str] = ("tipo", "year", "month", "pickup_datetime",
                                           "passenger_count", "trip_distance", "fare_amount",
                                           "tip_amount", "tolls_amount", "airport_fee",
                                           "total_amount"),
                 tie_break: Sequence[str] = (), method: str = DEFAULT_METHOD,
                 accuracy: int = DEFAULT_ACCURACY, bounds: tuple | None = None) -> DataFrame:
    """The ``k`` largest outliers (top-k: TakeOrderedAndProject, no full sort)."""
    flagged = flag_outliers(df, column, method=method, accuracy=accuracy,
                            bounds=bounds).where(F.col("outlier"))
    order = [F.col(column).desc()] + [F.col(c).asc_nulls_last() for c in tie_break]
    return flagged.orderBy(*order).limit(k).select(*columns)


def trip_duration(df: DataFrame, start: str = "pickup_datetime_tratado",
                  end: str = "dropoff_datetime_tratado", out: str = "duracao_minutos") -> DataFrame:
    """Duration in minutes (whole seconds / 60); only trips with duration > 0."""
    return df.withColumn(out, X.duration_minutes(start, end)).where(F.expr(f"{quote(out)} > 0"))


def outliers_by_band(df: DataFrame, amount: str = "total_amount",
                     start: str = "pickup_datetime_tratado", end: str = "dropoff_datetime_tratado",
                     method: str = DEFAULT_METHOD, accuracy: int = DEFAULT_ACCURACY,
                     bounds: tuple | None = None) -> DataFrame:
    """Per duration band: trips, mean duration, mean/max amount, outlier count,
    mean and exact median of the outliers' amounts.

    The IQR bounds are computed over all rows of ``df`` (not only rows with a
    positive duration). The median of the outliers is the continuous one
    (interpolated), selected exactly per band (five bands: their brackets are
    broadcast).
    """
    timed = trip_duration(df, start, end)
    flagged = flag_outliers(timed, amount, method=method, accuracy=accuracy, bounds_from=df,
                            bounds=bounds)
    banded = flagged.withColumn("faixa_duracao", X.duration_band("duracao_minutos"))
    a = quote(amount)
    main = (banded.groupBy("faixa_duracao")
            .agg(F.expr("count(1) AS corridas"),
                 F.expr("avg(duracao_minutos) AS duracao_media"),
                 F.expr(f"avg({a}) AS total_medio"),
                 F.expr(f"max({a}) AS maior_total"),
                 F.expr(f"{X.count_if_sql('outlier')} AS qtd_outliers"),
                 F.expr(f"avg(CASE WHEN outlier THEN {a} END) AS total_medio_outlier")))
    med = quantile_frame(banded.where(F.col("outlier")), amount, {"total_mediano_outlier": 0.5},
                         ["faixa_duracao"], method, accuracy, continuous=True, bounded_groups=True)
    return attach_groups(main, med, ["faixa_duracao"], bounded_groups=True)


# --------------------------------------------------------------------------
# negative amounts and recomposition
# --------------------------------------------------------------------------

def negatives(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    return df.where(F.expr(f"{quote(amount)} < 0"))


def negatives_summary(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    a = quote(amount)
    return negatives(df, amount).selectExpr("count(1) AS total_negativos",
                                            f"min({a}) AS valor_minimo", f"max({a}) AS valor_maximo")


def negatives_by(df: DataFrame, by: Sequence[str], amount: str = "total_amount") -> DataFrame:
    """Negative rows counted per group (groups without negatives absent)."""
    return negatives(df, amount).groupBy(*by).agg(F.expr("count(1) AS count"))


def negatives_by_vendor(df: DataFrame, vendor: str = "VendorID",
                        amount: str = "total_amount") -> DataFrame:
    """Negatives per vendor, vendors without any shown with 0."""
    return df.groupBy(vendor).agg(F.expr(f"{X.count_if_sql(f'{quote(amount)} < 0')} AS total_negativos"))


def with_recomposition(df: DataFrame, amount: str = "total_amount",
                       components: Sequence[str] = AMOUNT_COMPONENTS) -> DataFrame:
    return df.withColumn("total_calculado", X.recomposed_total(components))


def recompose_check(df: DataFrame, amount: str = "total_amount",
                    components: Sequence[str] = AMOUNT_COMPONENTS,
                    tolerance: float = L.RECOMPOSE_TOLERANCE) -> DataFrame:
    """Negative rows: do the components add up to the total (within tolerance)?"""
    neg = with_recomposition(negatives(df, amount), amount, components)
    label = (f"CASE WHEN abs({quote(amount)} - total_calculado) <= {float(tolerance)!r}D "
             f"THEN {sql_literal(L.RECOMPOSE_OK)} ELSE {sql_literal(L.RECOMPOSE_DIFF)} END")
    return neg.withColumn("validacao", F.expr(label)).groupBy("validacao").agg(F.expr("count(1) AS count"))


def recompose_mismatch(df: DataFrame, amount: str = "total_amount",
                       components: Sequence[str] = AMOUNT_COMPONENTS,
                       tolerance: float = L.RECOMPOSE_TOLERANCE,
                       columns: Sequence[str] = ("year", "month", "pickup_datetime")) -> DataFrame:
    """Detail of the negative rows whose components do not add up."""
    neg = with_recomposition(negatives(df, amount), amount, components)
    neg = neg.withColumn("diferenca", F.expr(f"round({quote(amount)} - total_calculado, 4)"))
    return (neg.where(F.expr(f"abs(diferenca) > {float(tolerance)!r}D"))
            .select(*columns, *components, amount, "total_calculado", "diferenca"))
