"""SQL text of the independent oracle (DuckDB dialect).

The oracle re-derives every stage from the base tables with plain SQL: the
only text shared with the Spark side is the events -> trips select list.
Each stage is written independently (CASE instead of least/greatest,
quantile_disc instead of percentile_approx, epoch instead of
unix_timestamp) so a mistake on one side shows up as a mismatch.
"""

from __future__ import annotations

from lakeops.functions.periods import month_bounds_text
from lakeops.plans.silver import QUERY_MONTHS
from lakeops.sources.events_trips import adapter_sql

_LO, _HI = month_bounds_text(QUERY_MONTHS)

TYPED_COLUMNS_SQL = """
         CAST(vendor_id AS INTEGER) AS VendorID,
         pickup_datetime,
         dropoff_datetime,
         store_and_fwd_flag,
         CAST(ratecode_id AS BIGINT) AS RatecodeID,
         CAST(pu_location_id AS BIGINT) AS PULocationID,
         CAST(do_location_id AS BIGINT) AS DOLocationID,
         CAST(passenger_count AS BIGINT) AS passenger_count,
         trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
         CASE WHEN tipo = 'yellow' THEN 0e0 END AS ehail_fee,
         improvement_surcharge,
         total_amount,
         CAST(payment_type AS BIGINT) AS payment_type,
         CAST(trip_type AS BIGINT) AS trip_type,
         congestion_surcharge,
         CASE WHEN tipo = 'green' THEN 0e0 ELSE airport_fee END AS airport_fee,
         tipo"""

BASE = f"""
WITH trips AS (
{adapter_sql('events')}
),
conformed AS (
  SELECT {TYPED_COLUMNS_SQL}
    FROM trips
),
typed AS (
  SELECT *,
         CAST(pickup_datetime AS DATE) AS data_corrida,
         CAST(year(pickup_datetime) AS INTEGER) AS year,
         CAST(month(pickup_datetime) AS INTEGER) AS month
    FROM conformed
),
median_pc AS (
  SELECT quantile_disc(passenger_count, 0.5) AS m FROM typed WHERE passenger_count > 0
),
imputed AS (
  SELECT * REPLACE (
           CASE WHEN passenger_count IS NULL OR passenger_count = 0
                THEN coalesce((SELECT m FROM median_pc), passenger_count)
                ELSE passenger_count END AS passenger_count)
    FROM typed
),
fixed AS (
  SELECT *,
         CASE WHEN pickup_datetime IS NULL THEN dropoff_datetime
              WHEN dropoff_datetime IS NULL OR dropoff_datetime >= pickup_datetime THEN pickup_datetime
              ELSE dropoff_datetime END AS pickup_datetime_tratado,
         CASE WHEN dropoff_datetime IS NULL THEN pickup_datetime
              WHEN pickup_datetime IS NULL OR dropoff_datetime >= pickup_datetime THEN dropoff_datetime
              ELSE pickup_datetime END AS dropoff_datetime_tratado
    FROM imputed
),
repaired AS (
  SELECT * REPLACE (
           CAST(pickup_datetime_tratado AS DATE) AS data_corrida,
           CAST(year(pickup_datetime_tratado) AS INTEGER) AS year,
           CAST(month(pickup_datetime_tratado) AS INTEGER) AS month)
    FROM fixed
),
scoped AS (
  SELECT * FROM repaired
   WHERE data_corrida >= DATE '{_LO}' AND data_corrida < DATE '{_HI}'
),
serving AS (
  SELECT VendorID, tipo, year, month, total_amount, passenger_count,
         pickup_datetime_tratado AS pickup_datetime,
         dropoff_datetime_tratado AS dropoff_datetime
    FROM scoped
),
metrics AS (
  SELECT tipo, year, month, CAST(hour(pickup_datetime) AS INTEGER) AS hora_do_dia,
         count(*) AS qtd_corridas,
         sum(total_amount) AS soma_total_amount,
         CAST(sum(passenger_count) AS BIGINT) AS soma_passenger_count
    FROM serving
   GROUP BY tipo, year, month, hour(pickup_datetime)
),
bounds AS (
  SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi
    FROM (SELECT quantile_disc(total_amount, 0.25) AS q1,
                 quantile_disc(total_amount, 0.75) AS q3 FROM scoped)
),
timed AS (
  SELECT *, (floor(epoch(dropoff_datetime_tratado)) - floor(epoch(pickup_datetime_tratado))) / 60e0
            AS duracao_minutos
    FROM scoped
),
negs AS (
  SELECT *, coalesce(fare_amount, 0e0) + coalesce(extra, 0e0) + coalesce(mta_tax, 0e0)
            + coalesce(tip_amount, 0e0) + coalesce(tolls_amount, 0e0)
            + coalesce(improvement_surcharge, 0e0) + coalesce(congestion_surcharge, 0e0)
            + coalesce(airport_fee, 0e0) AS total_calculado
    FROM scoped WHERE total_amount < 0
)
"""


def with_base(final: str) -> str:
    return BASE + final
