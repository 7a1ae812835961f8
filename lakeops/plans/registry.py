"""Registered queries: one per operator, each paired with its oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the base tables under
``sf_dir`` (trips are derived from ``events``; ``lineitem`` and ``orders``
serve the generic operators) and returns a lazy DataFrame over the whole
tables. Doubles that come out of a floating-point sum or mean are rounded on
both sides (sums depend on row order); counts are ``bigint`` and date parts
``int`` on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.schema import TRIP_KEY
from lakeops.operators import audit as A
from lakeops.operators import cube as C
from lakeops.operators import metrics as M
from lakeops.operators import quality as Q
from lakeops.plans.oracle_sql import with_base
from lakeops.plans.silver import QUERY_MONTHS, conform_services, raw_from_events, stages_from_events
from lakeops.sources import events_trips as E
from lakeops.sources.services import SERVICE_A, SERVICE_B, standardize
from lakeops.functions.schema import conform

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _st(spark, sf_dir):
    return stages_from_events(spark, sf_dir)


# Fixed month used by the single-month questions (the events-derived trips
# cover 2024-01 to 2024-05).
QUESTION_YEAR, QUESTION_MONTH = 2024, 3
SUMMARY_SERVICE, SUMMARY_YEAR, SUMMARY_MONTH = "yellow", 2024, 2

# Generic conform / cast-loss target for lineitem: narrowing casts, one
# column that cannot convert at all.
LINEITEM_TARGET = {
    "l_orderkey": "int",
    "l_linenumber": "int",
    "l_quantity": "int",
    "l_extendedprice": "double",
    "l_returnflag": "string",
    "l_linestatus": "int",
    "l_shipdate": "date",
}
LINEITEM_TARGET_SQL = {
    "l_orderkey": "INTEGER", "l_linenumber": "INTEGER", "l_quantity": "INTEGER",
    "l_extendedprice": "DOUBLE", "l_returnflag": "VARCHAR", "l_linestatus": "INTEGER",
    "l_shipdate": "DATE",
}

# ---------------------------------------------------------------------------
# metrics and business questions
# ---------------------------------------------------------------------------


@register("hourly_metrics", with_base("""
SELECT tipo, year, month, hora_do_dia, qtd_corridas,
       round(soma_total_amount, 2) AS soma_total_amount, soma_passenger_count
  FROM metrics"""))
def q_hourly_metrics(spark, sf_dir):
    return rounded(_st(spark, sf_dir).metrics, ["soma_total_amount"], 2)


@register("mean_amount_by_month", with_base("""
SELECT year, month, round(sum(soma_total_amount) / sum(qtd_corridas), 2) AS media_total_amount
  FROM metrics WHERE tipo = 'yellow' GROUP BY year, month"""))
def q_mean_amount_by_month(spark, sf_dir):
    return M.mean_amount_by_month(_st(spark, sf_dir).metrics, "yellow")


@register("mean_amount_all_services", with_base("""
SELECT year, month, round(sum(soma_total_amount) / sum(qtd_corridas), 2) AS media_total_amount
  FROM metrics GROUP BY year, month"""))
def q_mean_amount_all_services(spark, sf_dir):
    return M.mean_amount_by_month(_st(spark, sf_dir).metrics, None)


@register("mean_amount_by_service_month", with_base("""
SELECT tipo, year, month, round(sum(soma_total_amount) / sum(qtd_corridas), 2) AS media_total_amount
  FROM metrics GROUP BY tipo, year, month"""))
def q_mean_amount_by_service_month(spark, sf_dir):
    return M.mean_amount_by_service_month(_st(spark, sf_dir).metrics)


@register("mean_passengers_by_hour", with_base(f"""
SELECT hora_do_dia, round(sum(soma_passenger_count) / sum(qtd_corridas), 2) AS media_passenger_count
  FROM metrics WHERE year = {QUESTION_YEAR} AND month = {QUESTION_MONTH} GROUP BY hora_do_dia"""))
def q_mean_passengers_by_hour(spark, sf_dir):
    return M.mean_passengers_by_hour(_st(spark, sf_dir).metrics, QUESTION_YEAR, QUESTION_MONTH)


@register("mean_passengers_by_hour_latest", with_base("""
SELECT hora_do_dia, round(sum(soma_passenger_count) / sum(qtd_corridas), 2) AS media_passenger_count
  FROM metrics
 WHERE year * 100 + month = (SELECT max(year * 100 + month) FROM metrics)
 GROUP BY hora_do_dia"""))
def q_mean_passengers_by_hour_latest(spark, sf_dir):
    return M.mean_passengers_by_hour_latest(_st(spark, sf_dir).metrics)


@register("metrics_coverage", with_base("""
SELECT CAST(min(year * 100 + month) AS INTEGER) AS de,
       CAST(max(year * 100 + month) AS INTEGER) AS ate,
       CAST(sum(qtd_corridas) AS BIGINT) AS total_corridas,
       count(DISTINCT year * 100 + month) AS meses
  FROM metrics"""))
def q_metrics_coverage(spark, sf_dir):
    return M.metrics_coverage(_st(spark, sf_dir).metrics)


@register("available_months", with_base("""
SELECT DISTINCT year, month FROM metrics"""))
def q_available_months(spark, sf_dir):
    return M.available_months(_st(spark, sf_dir).metrics)


@register("month_trip_summary", with_base(f"""
SELECT count(*) AS qtd_corridas,
       round(avg(total_amount), 2) AS media_total_amount,
       round(avg(passenger_count), 2) AS media_passenger_count
  FROM serving
 WHERE tipo = '{SUMMARY_SERVICE}' AND year = {SUMMARY_YEAR} AND month = {SUMMARY_MONTH}"""))
def q_month_trip_summary(spark, sf_dir):
    return M.month_trip_summary(_st(spark, sf_dir).serving, SUMMARY_SERVICE, SUMMARY_YEAR, SUMMARY_MONTH)


@register("mean_of_sums_check", with_base("""
SELECT coalesce(a.year, b.year) AS year, coalesce(a.month, b.month) AS month,
       round(a.m, 6) AS media_metricas, round(b.m, 6) AS media_viagens,
       round(abs(a.m - b.m), 6) AS diferenca
  FROM (SELECT year, month, sum(soma_total_amount) / sum(qtd_corridas) AS m
          FROM metrics WHERE tipo = 'yellow' GROUP BY year, month) a
  FULL JOIN (SELECT year, month, sum(total_amount) / count(*) AS m
               FROM serving WHERE tipo = 'yellow' GROUP BY year, month) b
    ON a.year = b.year AND a.month = b.month"""))
def q_mean_of_sums_check(spark, sf_dir):
    st = _st(spark, sf_dir)
    return M.mean_of_sums_check(st.metrics, st.serving, "yellow")


@register("serving_trips", with_base("SELECT * FROM serving"))
def q_serving_trips(spark, sf_dir):
    return _st(spark, sf_dir).serving


# ---------------------------------------------------------------------------
# adapters, conform, union, date parts
# ---------------------------------------------------------------------------


@register("standardize_service_a", with_base("""
SELECT CAST(vendor_id AS INTEGER) AS VendorID,
       pickup_datetime, dropoff_datetime,
       CAST(passenger_count AS BIGINT) AS passenger_count,
       trip_distance,
       CAST(ratecode_id AS BIGINT) AS RatecodeID,
       store_and_fwd_flag,
       pu_location_id AS PULocationID, do_location_id AS DOLocationID,
       CAST(payment_type AS BIGINT) AS payment_type,
       fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
       total_amount, congestion_surcharge,
       CAST(airport_fee AS DOUBLE) AS airport_fee,
       0e0 AS ehail_fee, CAST(0 AS BIGINT) AS trip_type, 'yellow' AS tipo
  FROM trips WHERE tipo = 'yellow'"""))
def q_standardize_service_a(spark, sf_dir):
    return standardize(raw_from_events(spark, sf_dir)["yellow"], SERVICE_A)


@register("standardize_service_b", with_base("""
SELECT CAST(vendor_id AS INTEGER) AS VendorID,
       pickup_datetime, dropoff_datetime, store_and_fwd_flag,
       CAST(ratecode_id AS BIGINT) AS RatecodeID,
       pu_location_id AS PULocationID, do_location_id AS DOLocationID,
       CAST(passenger_count AS BIGINT) AS passenger_count,
       trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
       CAST(NULL AS DOUBLE) AS ehail_fee,
       improvement_surcharge, total_amount,
       CAST(payment_type AS BIGINT) AS payment_type,
       CAST(trip_type AS BIGINT) AS trip_type,
       congestion_surcharge, 0e0 AS airport_fee, 'green' AS tipo
  FROM trips WHERE tipo = 'green'"""))
def q_standardize_service_b(spark, sf_dir):
    return standardize(raw_from_events(spark, sf_dir)["green"], SERVICE_B)


@register("union_services", with_base("SELECT * FROM conformed"))
def q_union_services(spark, sf_dir):
    return conform_services(raw_from_events(spark, sf_dir))


@register("date_parts", with_base("SELECT * FROM typed"))
def q_date_parts(spark, sf_dir):
    return _st(spark, sf_dir).typed


def _lineitem_conform_sql() -> str:
    cols = ",\n       ".join(f"TRY_CAST({c} AS {t}) AS {c}" for c, t in LINEITEM_TARGET_SQL.items())
    return f"SELECT {cols}\n  FROM lineitem"


def _lineitem_cast_loss_sql() -> str:
    parts = []
    for c, t in LINEITEM_TARGET_SQL.items():
        parts.append(
            f"SELECT '{c}' AS coluna, count({c}) AS antes, count(TRY_CAST({c} AS {t})) AS depois,\n"
            f"       count({c}) - count(TRY_CAST({c} AS {t})) AS perdidos,\n"
            f"       CASE WHEN count({c}) > 0 THEN round((count({c}) - count(TRY_CAST({c} AS {t})))"
            f" / count({c}) * 100, 4) ELSE 0e0 END AS pct_perdido\n  FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("conform_schema", _lineitem_conform_sql())
def q_conform_schema(spark, sf_dir):
    return conform(E.read_table(spark, sf_dir, "lineitem"), LINEITEM_TARGET)


@register("cast_loss", _lineitem_cast_loss_sql())
def q_cast_loss(spark, sf_dir):
    return A.cast_loss(E.read_table(spark, sf_dir, "lineitem"), LINEITEM_TARGET)


# The part of lineitem delivered as text in the mixed-type scenario, and the text no number can be.
MIXED = """
SELECT 'l_linenumber' AS coluna, count(*) AS antes, count(*) FILTER (l_returnflag <> 'R') AS depois,
       count(*) FILTER (l_returnflag = 'R') AS perdidos,
       round(count(*) FILTER (l_returnflag = 'R') / count(*) * 100, 4) AS pct_perdido
  FROM lineitem
UNION ALL
SELECT 'l_quantity' AS coluna, count(*) AS antes, count(*) AS depois, 0 AS perdidos, 0e0 AS pct_perdido
  FROM lineitem"""


@register("cast_loss_mixed_types", MIXED)
def q_cast_loss_mixed_types(spark, sf_dir):
    """Deliveries of one column as integer and as text, part of it not a number."""
    rows = E.read_table(spark, sf_dir, "lineitem")
    typed = rows.where("l_returnflag = 'A'").selectExpr("CAST(l_linenumber AS BIGINT) AS l_linenumber", "l_quantity")
    text = rows.where("l_returnflag <> 'A'").selectExpr(
        "CASE WHEN l_returnflag = 'R' THEN 'abc' ELSE CAST(l_linenumber AS STRING) END AS l_linenumber",
        "CAST(l_quantity AS STRING) AS l_quantity")
    return A.cast_loss([typed, text], {"l_linenumber": "int", "l_quantity": "double"})


@register("exact_duplicates_lineitem", """
SELECT (SELECT count(*) FROM lineitem) AS registros,
       (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem))
           AS registros_distintos,
       (SELECT count(*) FROM lineitem)
       - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem))
           AS duplicados""")
def q_exact_duplicates_lineitem(spark, sf_dir):
    """A projection of lineitem in which most rows repeat."""
    return A.exact_duplicates(E.read_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount"))


@register("key_duplicates_orders", """
SELECT o_custkey, o_orderdate, count(*) AS count
  FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1""")
def q_key_duplicates_orders(spark, sf_dir):
    """Customers with several orders on a day."""
    return A.key_duplicates(E.read_table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


# ---------------------------------------------------------------------------
# structural audit and value quality (typed stage: before any repair)
# ---------------------------------------------------------------------------


@register("rows_by_source", with_base("""
SELECT tipo AS fonte, count(*) AS registros FROM typed GROUP BY tipo
UNION ALL
SELECT 'total' AS fonte, count(*) AS registros FROM typed"""))
def q_rows_by_source(spark, sf_dir):
    return A.rows_by_source(_st(spark, sf_dir).typed)


@register("exact_duplicates", with_base("""
SELECT count(*) AS registros,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM typed)) AS registros_distintos,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM typed)) AS duplicados
  FROM typed"""))
def q_exact_duplicates(spark, sf_dir):
    return A.exact_duplicates(_st(spark, sf_dir).typed)


@register("key_duplicates", with_base(f"""
SELECT {', '.join(TRIP_KEY)}, count(*) AS count
  FROM typed GROUP BY {', '.join(TRIP_KEY)} HAVING count(*) > 1"""))
def q_key_duplicates(spark, sf_dir):
    return A.key_duplicates(_st(spark, sf_dir).typed, TRIP_KEY)


@register("volume_by_key", with_base("""
SELECT VendorID, count(*) AS total_registros FROM typed GROUP BY VendorID"""))
def q_volume_by_key(spark, sf_dir):
    return A.volume_by(_st(spark, sf_dir).typed, "VendorID")


@register("value_distribution", with_base("""
SELECT passenger_count, count(*) AS count FROM typed GROUP BY passenger_count"""))
def q_value_distribution(spark, sf_dir):
    return A.value_distribution(_st(spark, sf_dir).typed, "passenger_count")


def _rate_sql(dim: str, pred: str, name: str, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return with_base(f"""
SELECT {dim}, count(*) AS total,
       CAST(sum(CAST({pred} AS INTEGER)) AS BIGINT) AS {name},
       round(sum(CAST({pred} AS INTEGER)) / count(*) * 100, 2) AS pct_{name}
  FROM typed{w} GROUP BY {dim}""")


def _green():
    return F.col("tipo") == "green"


@register("null_rate_by_vendor", _rate_sql("VendorID", "passenger_count IS NULL", "passenger_count_nulo"))
def q_null_rate_by_vendor(spark, sf_dir):
    return A.null_rate_by(_st(spark, sf_dir).typed, "VendorID")


@register("null_rate_by_subtype", _rate_sql("trip_type", "passenger_count IS NULL",
                                            "passenger_count_nulo", "tipo = 'green'"))
def q_null_rate_by_subtype(spark, sf_dir):
    return A.null_rate_by(_st(spark, sf_dir).typed, "trip_type", where=_green())


@register("null_rate_by_flag", _rate_sql("store_and_fwd_flag", "passenger_count IS NULL",
                                         "passenger_count_nulo"))
def q_null_rate_by_flag(spark, sf_dir):
    return A.null_rate_by(_st(spark, sf_dir).typed, "store_and_fwd_flag")


@register("zero_rate_by_vendor", _rate_sql("VendorID", "passenger_count = 0", "passenger_count_zero"))
def q_zero_rate_by_vendor(spark, sf_dir):
    return A.zero_rate_by(_st(spark, sf_dir).typed, "VendorID")


@register("zero_rate_by_subtype", _rate_sql("trip_type", "passenger_count = 0",
                                            "passenger_count_zero", "tipo = 'green'"))
def q_zero_rate_by_subtype(spark, sf_dir):
    return A.zero_rate_by(_st(spark, sf_dir).typed, "trip_type", where=_green())


@register("zero_rate_by_flag", _rate_sql("store_and_fwd_flag", "passenger_count = 0",
                                         "passenger_count_zero"))
def q_zero_rate_by_flag(spark, sf_dir):
    return A.zero_rate_by(_st(spark, sf_dir).typed, "store_and_fwd_flag")


def _stats_flag_sql(flag: str, name: str) -> str:
    return with_base(f"""
SELECT {flag} AS {name}, count(*) AS total,
       round(avg(total_amount), 4) AS total_amount_medio,
       quantile_disc(total_amount, 0.5) AS total_amount_mediano
  FROM typed GROUP BY {flag}""")


@register("amount_by_null_flag", _stats_flag_sql("passenger_count IS NULL", "passenger_count_nulo"))
def q_amount_by_null_flag(spark, sf_dir):
    return rounded(A.amount_by_null_flag(_st(spark, sf_dir).typed), ["total_amount_medio"])


@register("amount_by_zero_flag", _stats_flag_sql("passenger_count = 0", "passenger_count_zero"))
def q_amount_by_zero_flag(spark, sf_dir):
    return rounded(A.amount_by_zero_flag(_st(spark, sf_dir).typed), ["total_amount_medio"])


@register("impute_before_after", with_base("""
SELECT round(avg(passenger_count), 4) AS media_antes,
       quantile_disc(passenger_count, 0.5) AS mediana_antes,
       round(avg(pc), 4) AS media_depois,
       quantile_disc(pc, 0.5) AS mediana_depois
  FROM (SELECT passenger_count,
               CASE WHEN passenger_count IS NULL OR passenger_count = 0
                    THEN coalesce((SELECT m FROM median_pc), passenger_count)
                    ELSE passenger_count END AS pc
          FROM typed)"""))
def q_impute_before_after(spark, sf_dir):
    return rounded(Q.impute_before_after(_st(spark, sf_dir).typed), ["media_antes", "media_depois"])


@register("impute_median", with_base("SELECT * FROM imputed"))
def q_impute_median(spark, sf_dir):
    return _st(spark, sf_dir).imputed


@register("impute_residual", with_base("""
SELECT CAST(sum(CAST(passenger_count IS NULL AS INTEGER)) AS BIGINT) AS nulos_remanescentes,
       CAST(sum(CAST(passenger_count = 0 AS INTEGER)) AS BIGINT) AS zeros_remanescentes
  FROM imputed"""))
def q_impute_residual(spark, sf_dir):
    return Q.impute_residual(_st(spark, sf_dir).imputed)


# ---------------------------------------------------------------------------
# timestamps
# ---------------------------------------------------------------------------

_PROBLEM_SQL = """CASE WHEN pickup_datetime IS NULL THEN 'pickup_nulo'
            WHEN dropoff_datetime IS NULL THEN 'dropoff_nulo'
            WHEN dropoff_datetime < pickup_datetime THEN 'dropoff_menor_que_pickup'
            ELSE 'valido' END"""


@register("timestamp_problem_label", with_base(f"""
SELECT *, {_PROBLEM_SQL} AS problema_timestamp FROM imputed"""))
def q_timestamp_problem_label(spark, sf_dir):
    return Q.label_timestamp_problems(_st(spark, sf_dir).imputed)


@register("timestamp_problems", with_base(f"""
SELECT year, month, problema_timestamp, count(*) AS total_registros
  FROM (SELECT year, month, {_PROBLEM_SQL} AS problema_timestamp FROM imputed)
 WHERE problema_timestamp <> 'valido'
 GROUP BY year, month, problema_timestamp"""))
def q_timestamp_problems(spark, sf_dir):
    return Q.timestamp_problems(_st(spark, sf_dir).imputed)


@register("inverted_flag_fill", with_base("""
SELECT count(*) AS total_inconsistentes, count(store_and_fwd_flag) AS store_and_fwd_flag_preenchido
  FROM imputed WHERE dropoff_datetime < pickup_datetime"""))
def q_inverted_flag_fill(spark, sf_dir):
    return Q.inverted_flag_fill(_st(spark, sf_dir).imputed)


@register("inverted_gap_buckets", with_base("""
SELECT CAST(sum(CAST(gap <= 1 AS INTEGER)) AS BIGINT) AS ate_1_min,
       CAST(sum(CAST(gap > 1 AND gap <= 5 AS INTEGER)) AS BIGINT) AS de_1_a_5_min,
       CAST(sum(CAST(gap > 5 AND gap <= 60 AS INTEGER)) AS BIGINT) AS de_5_a_60_min,
       CAST(sum(CAST(gap > 60 AS INTEGER)) AS BIGINT) AS acima_60_min
  FROM (SELECT (floor(epoch(pickup_datetime)) - floor(epoch(dropoff_datetime))) / 60e0 AS gap
          FROM imputed WHERE dropoff_datetime < pickup_datetime)"""))
def q_inverted_gap_buckets(spark, sf_dir):
    return Q.inverted_gap_buckets(_st(spark, sf_dir).imputed)


@register("order_timestamps", with_base("SELECT * FROM repaired"))
def q_order_timestamps(spark, sf_dir):
    return _st(spark, sf_dir).repaired


@register("inverted_residual", with_base("""
SELECT CAST(sum(CAST(dropoff_datetime_tratado < pickup_datetime_tratado AS INTEGER)) AS BIGINT)
       AS ainda_invertidos
  FROM repaired"""))
def q_inverted_residual(spark, sf_dir):
    return Q.inverted_residual(_st(spark, sf_dir).repaired)


@register("timestamps_changed", with_base("""
SELECT CAST(sum(CAST(pickup_datetime <> pickup_datetime_tratado AS INTEGER)) AS BIGINT) AS pickup_alterado,
       CAST(sum(CAST(dropoff_datetime <> dropoff_datetime_tratado AS INTEGER)) AS BIGINT) AS dropoff_alterado
  FROM repaired"""))
def q_timestamps_changed(spark, sf_dir):
    return Q.timestamps_changed(_st(spark, sf_dir).repaired)


# ---------------------------------------------------------------------------
# period scope
# ---------------------------------------------------------------------------


def _in_period_sql() -> str:
    from lakeops.functions.periods import month_bounds_text
    lo, hi = month_bounds_text(QUERY_MONTHS)
    return f"(data_corrida >= DATE '{lo}' AND data_corrida < DATE '{hi}')"


@register("period_scope_counts", with_base(f"""
SELECT NOT {_in_period_sql()} AS fora_do_periodo, count(*) AS total
  FROM repaired GROUP BY NOT {_in_period_sql()}"""))
def q_period_scope_counts(spark, sf_dir):
    return Q.period_scope_counts(_st(spark, sf_dir).repaired, QUERY_MONTHS)


@register("out_of_period_detail", with_base(f"""
SELECT tipo, year, month, count(*) AS total
  FROM repaired WHERE NOT {_in_period_sql()} GROUP BY tipo, year, month"""))
def q_out_of_period_detail(spark, sf_dir):
    return Q.out_of_period_detail(_st(spark, sf_dir).repaired, QUERY_MONTHS)


@register("filter_period", with_base("SELECT * FROM scoped"))
def q_filter_period(spark, sf_dir):
    return _st(spark, sf_dir).scoped


# ---------------------------------------------------------------------------
# amounts: summary, IQR, duration bands
# ---------------------------------------------------------------------------


@register("numeric_summary", with_base("""
SELECT count(total_amount) AS count, round(avg(total_amount), 4) AS mean,
       round(stddev_samp(total_amount), 4) AS stddev, min(total_amount) AS min,
       quantile_disc(total_amount, 0.25) AS p25, quantile_disc(total_amount, 0.5) AS p50,
       quantile_disc(total_amount, 0.75) AS p75, max(total_amount) AS max
  FROM scoped"""))
def q_numeric_summary(spark, sf_dir):
    return rounded(Q.numeric_summary(_st(spark, sf_dir).scoped), ["mean", "stddev"])


@register("iqr_bounds", with_base("""
SELECT q1, q3, round(iqr, 4) AS iqr, round(lo, 4) AS limite_inferior, round(hi, 4) AS limite_superior
  FROM bounds"""))
def q_iqr_bounds(spark, sf_dir):
    return rounded(Q.iqr_bounds(_st(spark, sf_dir).scoped), ["iqr", "limite_inferior", "limite_superior"])


@register("iqr_outlier_counts", with_base("""
SELECT (total_amount < lo OR total_amount > hi) AS outlier, count(*) AS count
  FROM scoped, bounds GROUP BY (total_amount < lo OR total_amount > hi)"""))
def q_iqr_outlier_counts(spark, sf_dir):
    return Q.iqr_outlier_counts(_st(spark, sf_dir).scoped)


TOP_COLUMNS = ("tipo", "year", "month", "pickup_datetime", "passenger_count", "trip_distance",
               "fare_amount", "tip_amount", "tolls_amount", "airport_fee", "total_amount")
TOP_TIE_BREAK = ("pickup_datetime", "tipo", "passenger_count", "trip_distance", "fare_amount",
                 "tip_amount", "tolls_amount", "airport_fee", "year", "month")


@register("top_outliers", with_base(f"""
SELECT {', '.join(TOP_COLUMNS)}
  FROM scoped, bounds
 WHERE total_amount < lo OR total_amount > hi
 ORDER BY total_amount DESC, {', '.join(c + ' ASC NULLS LAST' for c in TOP_TIE_BREAK)}
 LIMIT 20"""))
def q_top_outliers(spark, sf_dir):
    return Q.top_outliers(_st(spark, sf_dir).scoped, k=20, columns=TOP_COLUMNS,
                          tie_break=TOP_TIE_BREAK)


@register("trip_duration", with_base("SELECT * FROM timed WHERE duracao_minutos > 0"))
def q_trip_duration(spark, sf_dir):
    return Q.trip_duration(_st(spark, sf_dir).scoped)


@register("outliers_by_band", with_base("""
SELECT CASE WHEN duracao_minutos < 10 THEN '<10 min'
            WHEN duracao_minutos < 20 THEN '10-20 min'
            WHEN duracao_minutos < 30 THEN '20-30 min'
            WHEN duracao_minutos < 60 THEN '30-60 min'
            ELSE '>60 min' END AS faixa_duracao,
       count(*) AS corridas,
       round(avg(duracao_minutos), 4) AS duracao_media,
       round(avg(total_amount), 4) AS total_medio,
       max(total_amount) AS maior_total,
       CAST(sum(CAST(o AS INTEGER)) AS BIGINT) AS qtd_outliers,
       round(avg(CASE WHEN o THEN total_amount END), 4) AS total_medio_outlier,
       round(quantile_cont(CASE WHEN o THEN total_amount END, 0.5), 4) AS total_mediano_outlier
  FROM (SELECT t.*, (total_amount < lo OR total_amount > hi) AS o
          FROM timed t, bounds WHERE duracao_minutos > 0)
 GROUP BY 1"""))
def q_outliers_by_band(spark, sf_dir):
    return rounded(Q.outliers_by_band(_st(spark, sf_dir).scoped),
                   ["duracao_media", "total_medio", "total_medio_outlier", "total_mediano_outlier"])


# ---------------------------------------------------------------------------
# negatives and recomposition
# ---------------------------------------------------------------------------


@register("negatives_summary", with_base("""
SELECT count(*) AS total_negativos, min(total_amount) AS valor_minimo, max(total_amount) AS valor_maximo
  FROM scoped WHERE total_amount < 0"""))
def q_negatives_summary(spark, sf_dir):
    return Q.negatives_summary(_st(spark, sf_dir).scoped)


@register("negatives_by_month", with_base("""
SELECT year, month, count(*) AS count FROM scoped WHERE total_amount < 0 GROUP BY year, month"""))
def q_negatives_by_month(spark, sf_dir):
    return Q.negatives_by(_st(spark, sf_dir).scoped, ["year", "month"])


@register("negatives_by_date", with_base("""
SELECT data_corrida, count(*) AS count FROM scoped WHERE total_amount < 0 GROUP BY data_corrida"""))
def q_negatives_by_date(spark, sf_dir):
    return Q.negatives_by(_st(spark, sf_dir).scoped, ["data_corrida"])


@register("negatives_by_vendor", with_base("""
SELECT VendorID, CAST(sum(CAST(total_amount < 0 AS INTEGER)) AS BIGINT) AS total_negativos
  FROM scoped GROUP BY VendorID"""))
def q_negatives_by_vendor(spark, sf_dir):
    return Q.negatives_by_vendor(_st(spark, sf_dir).scoped)


@register("negatives_by_payment", with_base("""
SELECT payment_type, count(*) AS count FROM scoped WHERE total_amount < 0 GROUP BY payment_type"""))
def q_negatives_by_payment(spark, sf_dir):
    return Q.negatives_by(_st(spark, sf_dir).scoped, ["payment_type"])


@register("recompose_total", with_base("""
SELECT s.*, coalesce(fare_amount, 0e0) + coalesce(extra, 0e0) + coalesce(mta_tax, 0e0)
            + coalesce(tip_amount, 0e0) + coalesce(tolls_amount, 0e0)
            + coalesce(improvement_surcharge, 0e0) + coalesce(congestion_surcharge, 0e0)
            + coalesce(airport_fee, 0e0) AS total_calculado
  FROM scoped s"""))
def q_recompose_total(spark, sf_dir):
    return Q.with_recomposition(_st(spark, sf_dir).scoped)


@register("recompose_check", with_base("""
SELECT CASE WHEN abs(total_amount - total_calculado) <= 0.01e0 THEN 'Sem diferença'
            ELSE 'Com diferença' END AS validacao,
       count(*) AS count
  FROM negs GROUP BY 1"""))
def q_recompose_check(spark, sf_dir):
    return Q.recompose_check(_st(spark, sf_dir).scoped)


@register("recompose_mismatch", with_base("""
SELECT year, month, pickup_datetime, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
       improvement_surcharge, congestion_surcharge, airport_fee, total_amount, total_calculado,
       round(total_amount - total_calculado, 4) AS diferenca
  FROM negs WHERE abs(round(total_amount - total_calculado, 4)) > 0.01e0"""))
def q_recompose_mismatch(spark, sf_dir):
    return Q.recompose_mismatch(_st(spark, sf_dir).scoped)


# ---------------------------------------------------------------------------
# fused reports (one scan each; equal to the unfused ones above)
# ---------------------------------------------------------------------------

def _bundle_part(dim: str, value: str, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return f"""SELECT '{dim}' AS dimensao, CAST({value} AS VARCHAR) AS valor, count(*) AS total,
       CAST(sum(CAST(passenger_count IS NULL AS INTEGER)) AS BIGINT) AS passenger_count_nulo,
       CAST(sum(CAST(passenger_count = 0 AS INTEGER)) AS BIGINT) AS passenger_count_zero,
       round(sum(CAST(passenger_count IS NULL AS INTEGER)) / count(*) * 100, 2) AS pct_passenger_count_nulo,
       round(sum(CAST(passenger_count = 0 AS INTEGER)) / count(*) * 100, 2) AS pct_passenger_count_zero
  FROM typed{w} GROUP BY {value}"""


@register("rate_bundle", with_base(
    _bundle_part("VendorID", "VendorID") + "\nUNION ALL\n"
    + _bundle_part("trip_type", "trip_type", "tipo = 'green'") + "\nUNION ALL\n"
    + _bundle_part("store_and_fwd_flag", "store_and_fwd_flag")))
def q_rate_bundle(spark, sf_dir):
    from lakeops.operators.bundle import rate_bundle
    return rate_bundle(_st(spark, sf_dir).typed)


@register("timestamp_bundle", with_base("""
SELECT f.total_inconsistentes, f.store_and_fwd_flag_preenchido,
       g.ate_1_min, g.de_1_a_5_min, g.de_5_a_60_min, g.acima_60_min,
       r.ainda_invertidos, r.pickup_alterado, r.dropoff_alterado
  FROM (SELECT count(*) AS total_inconsistentes,
               count(store_and_fwd_flag) AS store_and_fwd_flag_preenchido
          FROM repaired WHERE dropoff_datetime < pickup_datetime) f,
       (SELECT CAST(sum(CAST(gap <= 1 AS INTEGER)) AS BIGINT) AS ate_1_min,
               CAST(sum(CAST(gap > 1 AND gap <= 5 AS INTEGER)) AS BIGINT) AS de_1_a_5_min,
               CAST(sum(CAST(gap > 5 AND gap <= 60 AS INTEGER)) AS BIGINT) AS de_5_a_60_min,
               CAST(sum(CAST(gap > 60 AS INTEGER)) AS BIGINT) AS acima_60_min
          FROM (SELECT (floor(epoch(pickup_datetime)) - floor(epoch(dropoff_datetime))) / 60e0 AS gap
                  FROM repaired WHERE dropoff_datetime < pickup_datetime)) g,
       (SELECT CAST(sum(CAST(dropoff_datetime_tratado < pickup_datetime_tratado AS INTEGER)) AS BIGINT)
                 AS ainda_invertidos,
               CAST(sum(CAST(pickup_datetime <> pickup_datetime_tratado AS INTEGER)) AS BIGINT)
                 AS pickup_alterado,
               CAST(sum(CAST(dropoff_datetime <> dropoff_datetime_tratado AS INTEGER)) AS BIGINT)
                 AS dropoff_alterado
          FROM repaired) r"""))
def q_timestamp_bundle(spark, sf_dir):
    from lakeops.operators.bundle import timestamp_bundle
    return timestamp_bundle(_st(spark, sf_dir).repaired)


# ---------------------------------------------------------------------------
# the counting reports as roll-ups of one cube: same rows as the operators above
# ---------------------------------------------------------------------------

def _cells(cube: DataFrame) -> DataFrame:
    return C.scoped(cube, QUERY_MONTHS)


CUBE_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "rows_by_source": C.rows_by_source,
    "volume_by_key": C.volume_by,
    "null_rate_by_vendor": lambda c: C.rates_by(c, "VendorID", "valor_nulo", "passenger_count_nulo"),
    "null_rate_by_flag": lambda c: C.rates_by(c, "store_and_fwd_flag", "valor_nulo", "passenger_count_nulo"),
    "zero_rate_by_subtype": lambda c: C.rates_by(c, "trip_type", "valor_zero", "passenger_count_zero", "green"),
    "rate_bundle": C.rate_bundle,
    "timestamp_problems": C.timestamp_problems,
    "timestamp_bundle": C.timestamp_bundle,
    "period_scope_counts": lambda c: C.period_scope_counts(c, QUERY_MONTHS),
    "out_of_period_detail": lambda c: C.out_of_period_detail(c, QUERY_MONTHS),
    "negatives_summary": lambda c: C.negatives_summary(_cells(c)),
    "negatives_by_month": lambda c: C.negatives_by(_cells(c), ["year", "month"]),
    "negatives_by_date": lambda c: C.negatives_by(_cells(c), ["data_corrida"]),
    "negatives_by_vendor": lambda c: C.negatives_by_vendor(_cells(c)),
    "negatives_by_payment": lambda c: C.negatives_by(_cells(c), ["payment_type"]),
    "recompose_check": lambda c: C.recompose_check(_cells(c)),
}


def _cube_query(report: Callable[[DataFrame], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: report(C.trip_cube(_st(spark, sf_dir).typed))


for _name, _report in CUBE_REPORTS.items():
    register(f"cube_{_name}", ORACLES[_name])(_cube_query(_report))
