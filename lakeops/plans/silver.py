"""The trip-table stages as lazy DataFrames.

``raw per service -> standardize -> conform -> union -> date parts ->
impute -> order timestamps -> period scope -> serving projection -> metrics``

Each stage is a function of the previous one; nothing is cached here. The
job (``plans.jobs``) decides where to persist; the registered queries build
the stage they need straight from the base tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lakeops.functions.schema import SILVER_SCHEMA, conform
from lakeops.operators import metrics as M
from lakeops.operators import quality as Q
from lakeops.sources import events_trips as E
from lakeops.sources.services import SERVICES, standardize

# Months the registered queries process (the events-derived
# trips cover 2024-01 to 2024-05, so May is out of period).
QUERY_MONTHS = ["2024-01", "2024-02", "2024-03", "2024-04"]


def conform_services(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Standardize and conform each service, then union by name.

    Conforming before the union makes every branch the same shape whatever
    the types it was delivered in; a branch that lacks a column raises
    (``bronze.publish_raw`` reads such months with NULLs instead).
    """
    parts = [conform(standardize(df, SERVICES[name]), SILVER_SCHEMA) for name, df in raw.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def typed_trips(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Conformed trips plus date, year and month of the raw pickup."""
    return Q.add_date_parts(conform_services(raw), "pickup_datetime")


@dataclass
class TripStages:
    raw: dict
    typed: DataFrame
    imputed: DataFrame
    repaired: DataFrame
    scoped: DataFrame
    serving: DataFrame
    metrics: DataFrame


def build_stages(raw: Mapping[str, DataFrame], months, method: str = Q.DEFAULT_METHOD,
                 period_mode: str = "range") -> TripStages:
    typed = typed_trips(raw)
    imputed = Q.impute_median(typed, "passenger_count", method=method)
    repaired = Q.order_timestamps(imputed)
    scoped = Q.filter_period(repaired, months, mode=period_mode)
    serving = M.serving_trips(scoped)
    metrics = M.hourly_metrics(serving)
    return TripStages(dict(raw), typed, imputed, repaired, scoped, serving, metrics)


def raw_from_events(spark: SparkSession, sf_dir: str) -> dict:
    trips = E.trips_from_events(spark, sf_dir)
    return {name: E.raw_service_frame(trips, name) for name in ("yellow", "green")}


def stages_from_events(spark: SparkSession, sf_dir: str, months=QUERY_MONTHS) -> TripStages:
    return build_stages(raw_from_events(spark, sf_dir), months)
