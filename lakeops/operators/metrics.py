"""Additive metrics and the questions answered from them.

The metrics table keeps sums and counts, never means, so a mean at any
coarser level is ``SUM(sum) / SUM(count)`` - the mean of means is never
taken. The metrics grain (service, year, month, hour) is tiny compared with
the trips, so every question below reads a few thousand rows at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.schema import SERVING_COLUMNS, quote, sql_literal

COUNT_COL = "qtd_corridas"


def serving_trips(silver: DataFrame, start: str = "pickup_datetime_tratado",
                  end: str = "dropoff_datetime_tratado") -> DataFrame:
    """Per-trip serving projection; corrected timestamps under the public names."""
    source = {"pickup_datetime": start, "dropoff_datetime": end}
    return silver.selectExpr(*[f"{quote(source.get(c, c))} AS {quote(c)}" for c in SERVING_COLUMNS])


def hourly_metrics(trips: DataFrame, ts: str = "pickup_datetime",
                   by: Sequence[str] = ("tipo", "year", "month"),
                   amount: str = "total_amount", passengers: str = "passenger_count") -> DataFrame:
    """Additive metrics at (by..., hour of ``ts``): count, amount sum, passenger sum.

    A hash aggregate with map-side partial aggregation: each task ships at
    most one row per (service, month, hour) it saw, so the shuffle is tiny
    and a hot key cannot overload a reducer.
    """
    return (trips.withColumn("hora_do_dia", F.expr(f"hour({quote(ts)})"))
            .groupBy(*by, "hora_do_dia")
            .agg(F.expr(f"count(1) AS {COUNT_COL}"),
                 F.expr(f"sum({quote(amount)}) AS soma_total_amount"),
                 F.expr(f"sum({quote(passengers)}) AS soma_passenger_count")))


def recombine_mean(metrics: DataFrame, dims: Sequence[str], sum_col: str, out: str,
                   where: Column | None = None, count_col: str = COUNT_COL,
                   digits: int | None = 2) -> DataFrame:
    """``SUM(sum_col) / SUM(count_col)`` per ``dims`` (optionally filtered)."""
    if where is not None:
        metrics = metrics.where(where)
    mean = f"sum({quote(sum_col)}) / sum({quote(count_col)})"
    if digits is not None:
        mean = f"round({mean}, {int(digits)})"
    return metrics.groupBy(*dims).agg(F.expr(f"{mean} AS {quote(out)}"))


def mean_amount_by_month(metrics: DataFrame, service: str | None = "yellow") -> DataFrame:
    """Mean amount per month for one service, or for all when ``service`` is None."""
    where = None if service is None else F.expr(f"tipo = {sql_literal(service)}")
    return recombine_mean(metrics, ["year", "month"], "soma_total_amount",
                          "media_total_amount", where)


def mean_amount_by_service_month(metrics: DataFrame) -> DataFrame:
    return recombine_mean(metrics, ["tipo", "year", "month"], "soma_total_amount",
                          "media_total_amount")


def mean_passengers_by_hour(metrics: DataFrame, year: int, month: int) -> DataFrame:
    where = F.expr(f"year = {int(year)} AND month = {int(month)}")
    return recombine_mean(metrics, ["hora_do_dia"], "soma_passenger_count",
                          "media_passenger_count", where)


def latest_month_key(metrics: DataFrame) -> Column:
    """Scalar subquery: the latest ``year*100+month`` present."""
    return metrics.selectExpr("max(year * 100 + month) AS k").scalar()


def mean_passengers_by_hour_latest(metrics: DataFrame) -> DataFrame:
    """The panel's default: mean passengers per hour of the latest month."""
    where = F.expr("year * 100 + month") == latest_month_key(metrics)
    return recombine_mean(metrics, ["hora_do_dia"], "soma_passenger_count",
                          "media_passenger_count", where)


def metrics_coverage(metrics: DataFrame) -> DataFrame:
    """First and last month key, total trips, number of distinct months."""
    k = "(year * 100 + month)"
    return metrics.selectExpr(f"CAST(min({k}) AS INT) AS de", f"CAST(max({k}) AS INT) AS ate",
                              f"sum({COUNT_COL}) AS total_corridas",
                              f"count(DISTINCT {k}) AS meses")


def available_months(metrics: DataFrame) -> DataFrame:
    return metrics.select("year", "month").distinct().orderBy("year", "month")


def month_trip_summary(trips: DataFrame, service: str, year: int, month: int) -> DataFrame:
    """Trip-grain check of one service and month (partition-pruned on a table)."""
    where = f"tipo = {sql_literal(service)} AND year = {int(year)} AND month = {int(month)}"
    return (trips.where(F.expr(where))
            .selectExpr("count(1) AS qtd_corridas",
                        "round(avg(total_amount), 2) AS media_total_amount",
                        "round(avg(passenger_count), 2) AS media_passenger_count"))


def mean_of_sums_check(metrics: DataFrame, trips: DataFrame, service: str | None = "yellow",
                       digits: int = 6) -> DataFrame:
    """Mean amount per month from the metrics vs directly from the trips.

    Both sides are reduced to one row per month before the join, so the join
    is between two tiny frames. The difference is 0 whenever the summed
    column has no NULLs (SUM skips NULLs while the count keeps every row).
    """
    if service is not None:
        metrics = metrics.where(F.expr(f"tipo = {sql_literal(service)}"))
        trips = trips.where(F.expr(f"tipo = {sql_literal(service)}"))
    from_metrics = recombine_mean(metrics, ["year", "month"], "soma_total_amount",
                                  "media_metricas", digits=None)
    direct = trips.groupBy("year", "month").agg(
        F.expr("sum(total_amount) / count(1) AS media_viagens"))
    joined = from_metrics.join(direct, ["year", "month"], "full")
    d = int(digits)
    return joined.selectExpr(
        "year", "month", f"round(media_metricas, {d}) AS media_metricas",
        f"round(media_viagens, {d}) AS media_viagens",
        f"round(abs(media_metricas - media_viagens), {d}) AS diferenca")
