"""Registered queries that go through storage: land, read, replace, cluster,
scan by month set, and the raw-file profile audits.

Each query stages raw monthly files derived from ``events`` in a fresh
folder below ``spark.checkpoint.dir`` (shared storage on a cluster), runs the
operator, and returns a DataFrame that reads what was written.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.descriptions import COLUMN_TEXTS
from lakeops.functions.periods import month_tuple
from lakeops.functions.schema import SERVING_COLUMNS
from lakeops.operators import profile as P
from lakeops.plans.oracle_sql import with_base
from lakeops.plans.registry import register
from lakeops.plans.silver import QUERY_MONTHS, stages_from_events
from lakeops.session import scratch_path
from lakeops.sources import bronze as B
from lakeops.sources import events_trips as E
from lakeops.sources import sinks as S

SERVICES = ("yellow", "green")

# Months replaced and emptied in the replace_months scenario.
REPLACE_AGAIN = ["2024-02", "2024-05"]
REPLACE_EMPTY = ["2024-03"]
SCAN_MONTHS = ["2024-02", "2024-04"]


def landed_raw(spark, sf_dir, drift=False):
    """Stage the raw monthly files and land them; returns (root, report)."""
    source = scratch_path(spark, "source")
    root = scratch_path(spark, "raw")
    months = E.trip_months(spark, sf_dir)
    E.write_raw_sources(spark, sf_dir, source, SERVICES, months, drift=drift)
    report = B.land_months(spark, source, root, SERVICES, months)
    return root, report


@register("land_months", with_base("""
SELECT tipo AS servico, strftime(pickup_datetime, '%Y-%m') AS ano_mes, count(*) AS registros
  FROM trips GROUP BY tipo, strftime(pickup_datetime, '%Y-%m')"""))
def q_land_months(spark, sf_dir):
    _, report = landed_raw(spark, sf_dir)
    return report


_MONTH_IN_SCOPE = " OR ".join(
    f"(year(pickup_datetime) = {y} AND month(pickup_datetime) = {m})"
    for y, m in (month_tuple(s) for s in QUERY_MONTHS))


@register("read_months", with_base(f"SELECT * FROM conformed WHERE {_MONTH_IN_SCOPE}"))
def q_read_months(spark, sf_dir):
    root, _ = landed_raw(spark, sf_dir)
    return B.read_months(spark, root, SERVICES, QUERY_MONTHS)


@register("replace_months", with_base("""
SELECT * FROM repaired WHERE NOT (year = 2024 AND month = 3)"""))
def q_replace_months(spark, sf_dir):
    """First write Jan-Apr; then replace Feb and add May from a frame holding
    every month (the other months are strays and must not be touched); then
    reprocess March from a delivery that has no March rows (March must end
    up empty, every other row of that delivery is a stray)."""
    st = stages_from_events(spark, sf_dir)
    table = scratch_path(spark, "trips_table")
    S.replace_months(spark, st.repaired, table, QUERY_MONTHS)
    S.replace_months(spark, st.repaired, table, REPLACE_AGAIN)
    without_march = st.repaired.where("NOT (year = 2024 AND month = 3)")
    S.replace_months(spark, without_march, table, REPLACE_EMPTY)
    return spark.read.parquet(table)


@register("cluster_by_time", with_base("SELECT * FROM scoped"))
def q_cluster_by_time(spark, sf_dir):
    st = stages_from_events(spark, sf_dir)
    table = scratch_path(spark, "trips_clustered")
    S.replace_months(spark, st.scoped, table, QUERY_MONTHS, time_col="pickup_datetime_tratado")
    return spark.read.parquet(table)


_SCAN_PRED = " OR ".join(f"(year = {y} AND month = {m})" for y, m in (month_tuple(s) for s in SCAN_MONTHS))


@register("scan_month_set", with_base(f"SELECT * FROM serving WHERE {_SCAN_PRED}"))
def q_scan_month_set(spark, sf_dir):
    st = stages_from_events(spark, sf_dir)
    table = scratch_path(spark, "silver_trips")
    S.replace_months(spark, st.scoped, table, QUERY_MONTHS, time_col="pickup_datetime_tratado")
    source_cols = [{"pickup_datetime": "pickup_datetime_tratado",
                    "dropoff_datetime": "dropoff_datetime_tratado"}.get(c, c) for c in SERVING_COLUMNS]
    return S.read_table_months(spark, table, SCAN_MONTHS, source_cols,
                               {"pickup_datetime_tratado": "pickup_datetime",
                                "dropoff_datetime_tratado": "dropoff_datetime"})


@register("catalog_months", with_base(f"SELECT * FROM scoped WHERE {_SCAN_PRED}"))
def q_catalog_months(spark, sf_dir):
    """Write, register, reprocess one month, point its partition at it again, read by table name."""
    st = stages_from_events(spark, sf_dir)
    path = scratch_path(spark, "catalog_trips")
    table = path.rpartition("/")[2].replace("-", "_")
    S.replace_months(spark, st.scoped, path, QUERY_MONTHS, time_col="pickup_datetime_tratado")
    S.register_table(spark, table, path, comments=COLUMN_TEXTS)
    S.replace_months(spark, st.scoped, path, SCAN_MONTHS[:1])
    S.register_partitions(spark, table, path, SCAN_MONTHS[:1])
    return spark.table(table).where(_SCAN_PRED)


@register("switch_months", with_base("""
SELECT * REPLACE (CASE WHEN month = 2 THEN total_amount * 2 ELSE total_amount END AS total_amount)
  FROM scoped WHERE NOT (year = 2024 AND month = 3)"""))
def q_switch_months(spark, sf_dir):
    """Months written as versions of a catalog table; February rewritten from the table itself and switched,
    March switched to a delivery without rows; then the versions that nothing reads are removed."""
    st = stages_from_events(spark, sf_dir)
    path = scratch_path(spark, "switched_trips")
    table = path.rpartition("/")[2].replace("-", "_")
    S.switch_months(spark, st.scoped, table, path, QUERY_MONTHS, COLUMN_TEXTS, time_col="pickup_datetime_tratado")
    doubled = spark.table(table).where("year = 2024 AND month = 2").withColumn("total_amount", F.expr("total_amount * 2"))
    S.switch_months(spark, doubled, table, path, ["2024-02", "2024-03"], time_col="pickup_datetime_tratado")
    S.drop_old_versions(spark, table, path)
    return spark.table(table)


# Fixed value: the month that the raw zone's query delivers with text in a number column.
TEXT_MONTH = ("green", "2024-04")
_RAW_ZONE = """
SELECT t.* EXCLUDE (data_corrida) REPLACE (
         CASE WHEN tipo = 'yellow' AND year = 2024 AND month = 3 THEN NULL ELSE congestion_surcharge END AS congestion_surcharge,
         CASE WHEN tipo = 'green' AND year = 2024 AND month = 4 AND PULocationID % 2 = 0 THEN NULL ELSE passenger_count END
           AS passenger_count)
  FROM typed t"""


@register("raw_zone_view", with_base(_RAW_ZONE))
def q_raw_zone_view(spark, sf_dir):
    """The raw zone by name: months retyped, renamed, without a column, and one with text where a number belongs."""
    source, root = scratch_path(spark, "source"), scratch_path(spark, "raw")
    months = E.trip_months(spark, sf_dir)
    E.write_raw_sources(spark, sf_dir, source, SERVICES, months, drift=True)
    text = E.raw_month_frame(E.trips_from_events(spark, sf_dir), *TEXT_MONTH).withColumn(
        "passenger_count", F.expr("CASE WHEN PULocationID % 2 = 0 THEN 'unknown' ELSE CAST(passenger_count AS STRING) END"))
    text.write.mode("overwrite").parquet(B.source_path(source, *TEXT_MONTH))
    B.land_months(spark, source, root, SERVICES, months)
    database = root.rpartition("/")[2].replace("-", "_")
    return spark.table(B.publish_raw(spark, database, root, SERVICES, months))


# ---------------------------------------------------------------------------
# profile, missing columns, type drift
# ---------------------------------------------------------------------------

# Spark type names of the staged raw columns (oracle side).
RAW_TYPES = {
    "VendorID": "int", "tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz",
    "lpep_pickup_datetime": "timestamp_ntz", "lpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint", "trip_distance": "double", "RatecodeID": "bigint",
    "store_and_fwd_flag": "string", "PULocationID": "bigint", "DOLocationID": "bigint",
    "payment_type": "bigint", "fare_amount": "double", "extra": "double", "mta_tax": "double",
    "tip_amount": "double", "tolls_amount": "double", "improvement_surcharge": "double",
    "total_amount": "double", "congestion_surcharge": "double", "airport_fee": "double",
    "ehail_fee": "double", "trip_type": "bigint",
}
_SQL_TYPES = {"double": "DOUBLE", "bigint": "BIGINT"}


def _raw_columns(service):
    """(raw name, adapter expression) pairs of a service's raw layout."""
    exprs = E.RAW_A_EXPRS if service == "yellow" else E.RAW_B_EXPRS
    out = []
    for e in exprs:
        src, _, name = e.rpartition(" AS ")
        out.append((name, src) if src else (e, e))
    return out


def _profile_sql() -> str:
    """Per service and column one SELECT over all months; drift changes single months' types, names and columns."""
    parts = []
    for service in SERVICES:
        drifts = {m: c for (s, m), c in E.DRIFT.items() if s == service}
        for name, expr in _raw_columns(service):
            dropped = [m for m, c in drifts.items() if name in c.get("drop", [])]
            retyped = {m: c["retype"][name] for m, c in drifts.items() if name in c.get("retype", {})}
            renamed = {m: c["rename"][name] for m, c in drifts.items() if name in c.get("rename", {})}

            def by_month(cases: dict, other: str) -> str:
                return f"CASE {' '.join(f'WHEN periodo = {m!r} THEN {v}' for m, v in cases.items())} ELSE {other} END" if cases else other

            low, high = ({m: f"CAST(CAST({f}(v) AS {_SQL_TYPES[t]}) AS VARCHAR)" for m, t in retyped.items()} for f in ("min", "max"))
            gone = f" WHERE periodo NOT IN ({', '.join(map(repr, dropped))})" if dropped else ""
            parts.append(
                f"SELECT '{service}' AS taxi_type, periodo, count(*) AS total_registros, "
                f"{by_month({m: repr(v) for m, v in renamed.items()}, repr(name))} AS coluna, "
                f"{by_month({m: repr(t) for m, t in retyped.items()}, repr(RAW_TYPES[name]))} AS datatype, true AS nullable, "
                f"{by_month(low, 'CAST(min(v) AS VARCHAR)')} AS min, {by_month(high, 'CAST(max(v) AS VARCHAR)')} AS max, "
                f"count(*) - count(v) AS nulls "
                f"FROM (SELECT {expr} AS v, strftime(pickup_datetime, '%Y-%m') AS periodo FROM trips WHERE tipo = '{service}') r"
                f"{gone} GROUP BY periodo")
    return "\n UNION ALL ".join(parts)


_PROFILE_CTE = f", profile AS (\n{_profile_sql()}\n)\n"


def _with_profile(final: str) -> str:
    return with_base(_PROFILE_CTE + final)


def _profile(spark, sf_dir):
    root, _ = landed_raw(spark, sf_dir, drift=True)
    return P.profile_columns(spark, root, SERVICES, E.trip_months(spark, sf_dir))


@register("profile_columns", _with_profile("SELECT * FROM profile"))
def q_profile_columns(spark, sf_dir):
    return _profile(spark, sf_dir)


@register("missing_columns", _with_profile("""
SELECT p.taxi_type, p.coluna, p.presente_em, t.total_periodos
  FROM (SELECT taxi_type, coluna, count(DISTINCT periodo) AS presente_em
          FROM profile GROUP BY taxi_type, coluna) p
  JOIN (SELECT taxi_type, count(DISTINCT periodo) AS total_periodos
          FROM profile GROUP BY taxi_type) t ON p.taxi_type = t.taxi_type
 WHERE p.presente_em < t.total_periodos"""))
def q_missing_columns(spark, sf_dir):
    return P.missing_columns(_profile(spark, sf_dir))


@register("type_drift", _with_profile("""
SELECT * FROM profile
 WHERE (taxi_type, coluna) IN (SELECT taxi_type, coluna FROM profile
                                GROUP BY taxi_type, coluna HAVING count(DISTINCT datatype) > 1)"""))
def q_type_drift(spark, sf_dir):
    return P.type_drift(_profile(spark, sf_dir))



# Fixed value: a free query of the panel.
PANEL_QUERY = """SELECT tipo, year, month, hora_do_dia,
       ROUND(SUM(soma_passenger_count) / SUM(qtd_corridas), 2) AS media_passenger_count
  FROM trip_metrics GROUP BY tipo, year, month, hora_do_dia"""


@register("panel_free_query", with_base("""
SELECT tipo, year, month, hora_do_dia,
       round(sum(soma_passenger_count) / sum(qtd_corridas), 2) AS media_passenger_count
  FROM metrics GROUP BY tipo, year, month, hora_do_dia"""))
def q_panel_free_query(spark, sf_dir):
    """Serving tables written, exposed as views, queried in full."""
    from lakeops.plans.panel import free_query, register_views
    st = stages_from_events(spark, sf_dir)
    trips, metrics = scratch_path(spark, "gold_trips"), scratch_path(spark, "gold_metrics")
    S.replace_months(spark, st.serving, trips, QUERY_MONTHS, time_col="pickup_datetime")
    S.replace_months(spark, st.metrics, metrics, QUERY_MONTHS, small=True)
    register_views(spark, trips, metrics)
    return free_query(spark, PANEL_QUERY)


def _with_questions(spark, sf_dir):
    from lakeops.plans.panel import register_questions
    path = scratch_path(spark, "gold_metrics")
    S.replace_months(spark, stages_from_events(spark, sf_dir).metrics, path, QUERY_MONTHS, small=True)
    spark.read.parquet(path).createOrReplaceTempView("trip_metrics")
    register_questions(spark)


@register("question_mean_amount", with_base("""
SELECT 'green' AS servico, year, month, round(sum(soma_total_amount) / sum(qtd_corridas), 2) AS media_total_amount
  FROM metrics WHERE tipo = 'green' GROUP BY year, month
UNION ALL
SELECT NULL AS servico, year, month, round(sum(soma_total_amount) / sum(qtd_corridas), 2) AS media_total_amount
  FROM metrics GROUP BY year, month"""))
def q_question_mean_amount(spark, sf_dir):
    """A question as an SQL table function, its parameter bound: one service, and all of them."""
    _with_questions(spark, sf_dir)
    return spark.sql("""SELECT :service AS servico, * FROM mean_amount_by_month(:service)
                        UNION ALL SELECT CAST(NULL AS STRING), * FROM mean_amount_by_month(NULL)""", args={"service": "green"})


@register("question_mean_passengers", with_base("""
SELECT '2024-02' AS mes, hora_do_dia, round(sum(soma_passenger_count) / sum(qtd_corridas), 2) AS media_passenger_count
  FROM metrics WHERE tipo = 'yellow' AND year = 2024 AND month = 2 GROUP BY hora_do_dia
UNION ALL
SELECT NULL AS mes, hora_do_dia, round(sum(soma_passenger_count) / sum(qtd_corridas), 2) AS media_passenger_count
  FROM metrics WHERE year * 100 + month = (SELECT max(year * 100 + month) FROM metrics) GROUP BY hora_do_dia"""))
def q_question_mean_passengers(spark, sf_dir):
    """Mean passengers per hour as an SQL table function: a service's fixed month, and the latest month of all."""
    _with_questions(spark, sf_dir)
    return spark.sql("""SELECT :month AS mes, * FROM mean_passengers_by_hour('yellow', :month)
                        UNION ALL SELECT CAST(NULL AS STRING), * FROM mean_passengers_by_hour(NULL, NULL)""", args={"month": "2024-02"})
