"""What the browser panel offered, as Spark calls.

The panel exposed the serving tables as read-only views, ran a handful of
fixed questions over them (``lakeops.operators.metrics``), and a free SQL box
that showed the first rows of the result with their total. Here the views are
temp views over the partitioned Parquet tables and the free query is
``spark.sql``: it returns every row, and only printing is limited. A
SELECT-only guard is not rebuilt - grant read-only access to the tables
instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows shown (not returned) for a free query.
ROWS_SHOWN = 200


def register_views(spark: SparkSession, trips_path: str, metrics_path: str,
                   trips_view: str = "trips", metrics_view: str = "trip_metrics") -> None:
    """Temp views over the serving tables; filters on year/month prune partitions."""
    spark.read.parquet(trips_path).createOrReplaceTempView(trips_view)
    spark.read.parquet(metrics_path).createOrReplaceTempView(metrics_view)


def register_questions(spark: SparkSession, metrics_view: str = "trip_metrics") -> None:
    """The questions as SQL table functions over the metrics view, with their parameters typed and bound.

    * ``mean_amount_by_month(service)``: mean amount per month of a service, of all if NULL;
    * ``mean_passengers_by_hour(service, month)``: mean passengers per hour
      of a month ('2024-03'; NULL: the latest one) and service (NULL: all).

    A value never becomes part of the SQL text. Filters on year and month
    reach the table's partitions.
    """
    of_service = "(service IS NULL OR m.tipo = service)"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION mean_amount_by_month(service STRING)
        RETURNS TABLE (year INT, month INT, media_total_amount DOUBLE)
        RETURN SELECT m.year, m.month, round(sum(m.soma_total_amount) / sum(m.qtd_corridas), 2)
               FROM {metrics_view} m WHERE {of_service} GROUP BY m.year, m.month""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION mean_passengers_by_hour(service STRING, in_month STRING)
        RETURNS TABLE (hora_do_dia INT, media_passenger_count DOUBLE)
        RETURN SELECT m.hora_do_dia, round(sum(m.soma_passenger_count) / sum(m.qtd_corridas), 2)
               FROM {metrics_view} m
               WHERE {of_service} AND m.year * 100 + m.month = coalesce(
                   CAST(replace(in_month, '-', '') AS INT), (SELECT max(l.year * 100 + l.month) FROM {metrics_view} l))
               GROUP BY m.hora_do_dia""")


def free_query(spark: SparkSession, sql: str) -> DataFrame:
    """The whole result of a query over the registered views."""
    return spark.sql(sql)


def show_result(result: DataFrame, rows: int = ROWS_SHOWN) -> None:
    """Print the first rows and how many there are."""
    total = result.count()
    result.show(rows, truncate=False)
    print(f"{min(rows, total)} of {total} rows")
