"""Trip-shaped input derived from the driver's ``events`` table.

There is no taxi data in the test set, so every registered query reads
``events`` and derives trips from it with one SQL select list. The same text
is used by the Spark side (``selectExpr``) and by the SQL oracle, so both
start from identical rows. The list deliberately produces NULLs, zeros,
inverted start/end pairs, negative amounts and totals that do not add up.

The raw per-service forms reproduce the two source layouts: service A
(``yellow``) with ``tpep_`` names and no ``trip_type``; service B
(``green``) with ``lpep_`` names, an ``ehail_fee`` and no ``airport_fee``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sources.bronze import source_path

# The events -> trips select list (shared with the oracle).
ADAPTER_EXPRS = [
    "event_id AS trip_id",
    "CAST(user_id % 3 + 1 AS INT) AS vendor_id",
    "CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'yellow' ELSE 'green' END AS tipo",
    "ts + INTERVAL '1' DAY * CAST(30 * (user_id % 5) AS INT) AS pickup_datetime",
    "ts + INTERVAL '1' DAY * CAST(30 * (user_id % 5) AS INT)"
    " + INTERVAL '1' MINUTE * CAST((event_id * 37) % 95 - 5"
    " + CASE WHEN event_id % 211 = 0 THEN -90 ELSE 0 END AS INT) AS dropoff_datetime",
    "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag",
    "user_id % 6 + 1 AS ratecode_id",
    "event_id % 263 + 1 AS pu_location_id",
    "user_id % 263 + 1 AS do_location_id",
    "CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id % 7 END AS passenger_count",
    "event_id % 5 AS payment_type",
    "CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 0 ELSE event_id % 2 + 1 END AS trip_type",
    "value / 4e0 AS trip_distance",
    "CASE WHEN event_id % 29 = 0 THEN -value ELSE value END - 3e0 AS fare_amount",
    "1e0 AS extra",
    "5e-1 AS mta_tax",
    "CASE WHEN event_id % 7 = 0 THEN 25e-1 ELSE 0e0 END AS tip_amount",
    "0e0 AS tolls_amount",
    "1e0 AS improvement_surcharge",
    "5e-1 AS congestion_surcharge",
    "CASE WHEN event_type IN ('click', 'view', 'purchase') THEN NULL ELSE 0e0 END AS airport_fee",
    "CASE WHEN event_id % 29 = 0 THEN -value ELSE value END AS total_amount",
]

# Raw service A layout, derived from the adapter columns.
RAW_A_EXPRS = [
    "vendor_id AS VendorID",
    "pickup_datetime AS tpep_pickup_datetime",
    "dropoff_datetime AS tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "ratecode_id AS RatecodeID",
    "store_and_fwd_flag",
    "pu_location_id AS PULocationID",
    "do_location_id AS DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
]

# Raw service B layout, derived from the adapter columns.
RAW_B_EXPRS = [
    "vendor_id AS VendorID",
    "pickup_datetime AS lpep_pickup_datetime",
    "dropoff_datetime AS lpep_dropoff_datetime",
    "store_and_fwd_flag",
    "ratecode_id AS RatecodeID",
    "pu_location_id AS PULocationID",
    "do_location_id AS DOLocationID",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "CAST(NULL AS DOUBLE) AS ehail_fee",
    "improvement_surcharge",
    "total_amount",
    "payment_type",
    "trip_type",
    "congestion_surcharge",
]


def adapter_sql(table: str = "events") -> str:
    """The select as one SQL text (used verbatim by the oracle)."""
    return "SELECT " + ",\n       ".join(ADAPTER_EXPRS) + f"\n  FROM {table}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter rows (one per event), lazily."""
    return read_table(spark, sf_dir, "events").selectExpr(*ADAPTER_EXPRS)


def raw_service_frame(trips: DataFrame, service: str) -> DataFrame:
    """Raw layout of one service from adapter rows."""
    if service == "yellow":
        return trips.where("tipo = 'yellow'").selectExpr(*RAW_A_EXPRS)
    if service == "green":
        return trips.where("tipo = 'green'").selectExpr(*RAW_B_EXPRS)
    raise ValueError(f"unknown service {service!r}")


# Months that the test tables' trips are known to cover.
EVENT_MONTHS = ["2024-01", "2024-02", "2024-03", "2024-04", "2024-05"]


def trip_months(spark: SparkSession, sf_dir: str) -> list[str]:
    """All months in which the trips start, read from the table: one short text per calendar month."""
    starts = trips_from_events(spark, sf_dir).select(F.date_format("pickup_datetime", "yyyy-MM").alias("m"))
    return sorted(r.m for r in starts.where("m is not null").distinct().collect())

# Schema drift written into the staged raw files, per
# (service, month): retyped columns, dropped columns, renamed spellings.
DRIFT = {
    ("yellow", "2024-02"): {"retype": {"passenger_count": "double"}},
    ("yellow", "2024-03"): {"drop": ["congestion_surcharge"]},
    ("yellow", "2024-04"): {"rename": {"airport_fee": "Airport_fee"}},
    ("green", "2024-03"): {"retype": {"trip_type": "double"}},
}


def raw_month_frame(trips: DataFrame, service: str, month: str, drift: bool = False) -> DataFrame:
    """Raw layout of one (service, month), with the fixture drift if asked."""
    year, mon = (int(x) for x in month.split("-"))
    sliced = trips.where((F.year("pickup_datetime") == year) & (F.month("pickup_datetime") == mon))
    df = raw_service_frame(sliced, service)
    change = DRIFT.get((service, month), {}) if drift else {}
    for c, t in change.get("retype", {}).items():
        df = df.withColumn(c, F.col(c).cast(t))
    for c in change.get("drop", []):
        df = df.drop(c)
    for a, b in change.get("rename", {}).items():
        df = df.withColumnRenamed(a, b)
    return df


def write_raw_sources(spark: SparkSession, sf_dir: str, source_root: str,
                      services=("yellow", "green"), months=None, drift: bool = False,
                      max_parallel: int = 8) -> list[str]:
    """Write one raw file per (service, month), as a provider would deliver
    them, under ``source_root`` (the input of ``bronze.land_months``)."""
    trips = trips_from_events(spark, sf_dir)
    jobs = [(s, m) for s in services for m in (months or trip_months(spark, sf_dir))]

    def one(job):
        s, m = job
        path = source_path(source_root, s, m)
        raw_month_frame(trips, s, m, drift).write.mode("overwrite").parquet(path)
        return path

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        return list(pool.map(one, jobs))
