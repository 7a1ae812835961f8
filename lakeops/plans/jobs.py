"""The three jobs: land raw months, build the typed trip table, build the
serving table and metrics.

A job is the only place that runs actions. It writes the frame its reports
share once as a Parquet table below the shared checkpoint folder (lineage
cut, survives executor loss, column-pruned reads), writes each report as a
small Parquet table (durable, nothing pulled through the driver), writes the
data with ``replace_months`` and removes its work folder in ``finally``.
Reports are written by concurrent Spark jobs so the many small aggregates
overlap.

Run with spark-submit or ``python -m lakeops.plans.jobs <job> ...``.
"""

from __future__ import annotations

import argparse
import math
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.descriptions import COLUMN_TEXTS, TABLE_TEXTS
from lakeops.functions.periods import default_months, month_set_predicate, month_tuple, parse_months, validate_months
from lakeops.functions.schema import SERVING_COLUMNS, SILVER_SCHEMA, TRIP_KEY, conform
from lakeops.operators import audit as A
from lakeops.operators import cube as C
from lakeops.operators import metrics as M
from lakeops.operators import profile as P
from lakeops.operators import quality as Q
from lakeops.sources import bronze as B
from lakeops.sources import sinks as S
from lakeops.session import delete_path, folder_bytes, scratch_path
from lakeops.sources.services import SERVICES, standardize

SERVICE_NAMES = tuple(SERVICES)

# columns that order equal amounts in the top_outliers report: all it shows
TOP_TIES = ("pickup_datetime", "tipo", "passenger_count", "trip_distance", "fare_amount", "tip_amount",
            "tolls_amount", "airport_fee")
# reports read by size: the column that ranks them
RANKED = {"passenger_distribution": ("count",), "volume_by_vendor": ("total_registros",), "key_duplicates": ("count",),
          "top_outliers": ("total_amount",), "iqr_outliers": ("count",)}


def write_reports(reports: Mapping[str, DataFrame], path: str, max_parallel: int = 8) -> dict:
    """Write every report to ``path/<name>``, in parallel Spark jobs; return
    readers over what was written.

    No ``coalesce(1)``: on a report without a shuffle (a filter over the trips,
    such as the recomposition mismatches) it would pull the whole scan into one
    task. Aggregated reports end in a shuffle that AQE already merges into one
    small partition, so they still come out as one file.
    """
    spark = next(iter(reports.values())).sparkSession if reports else None

    def one(item):
        name, df = item
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
        return name

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        list(pool.map(one, reports.items()))
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in reports}


# ---------------------------------------------------------------------------
# J01: land
# ---------------------------------------------------------------------------

def land_job(spark: SparkSession, source_root: str, raw_root: str, months,
             reports_path: str, services=SERVICE_NAMES, database: str | None = None) -> dict:
    """Clear + land the requested months, then profile them.

    With ``database`` the raw zone is published there: a table per service and
    file schema, and the view ``raw_trips`` over all of them.
    """
    months = validate_months(months)
    landed = B.land_months(spark, source_root, raw_root, services, months)
    if database:
        B.publish_raw(spark, database, raw_root, services, months)
    # one scan per raw file: the schema reports read the profile as written
    out = write_reports({"landed": landed, "profile": P.profile_columns(spark, raw_root, services, months)},
                        reports_path)
    return out | write_reports({"missing_columns": P.missing_columns(out["profile"]),
                                "type_drift": P.type_drift(out["profile"])}, reports_path)


# ---------------------------------------------------------------------------
# J02: typed trip table
# ---------------------------------------------------------------------------

def raw_standardized(spark: SparkSession, raw_root: str, months, cast: bool,
                     services=SERVICE_NAMES) -> list[DataFrame]:
    return [standardize(df, SERVICES[s], cast=cast)
            for s in services for df in B.read_months_raw(spark, raw_root, s, months)]


def counting_reports(cube: DataFrame, months) -> dict[str, DataFrame]:
    """All reports that only count trips, from the cube."""
    cells = C.scoped(cube, months)
    return {
        "rows_by_source": C.rows_by_source(cube),
        "volume_by_vendor": C.volume_by(cube, "VendorID"),
        "passenger_rates": C.rate_bundle(cube),
        "timestamp_problems": C.timestamp_problems(cube),
        "timestamp_checks": C.timestamp_bundle(cube),
        "period_scope": C.period_scope_counts(cube, months),
        "out_of_period": C.out_of_period_detail(cube, months),
        "negatives": C.negatives_summary(cells),
        "negatives_by_month": C.negatives_by(cells, ["year", "month"]),
        "negatives_by_date": C.negatives_by(cells, ["data_corrida"]),
        "negatives_by_vendor": C.negatives_by_vendor(cells),
        "negatives_by_payment": C.negatives_by(cells, ["payment_type"]),
        "recompose_check": C.recompose_check(cells),
    }


def silver_job(spark: SparkSession, raw_root: str, silver_path: str, months,
               reports_path: str, method: str = Q.DEFAULT_METHOD,
               services=SERVICE_NAMES, work_path: str | None = None,
               database: str | None = None, top_k: int = 20,
               target_file_bytes: int = S.TARGET_FILE_BYTES, atomic: bool = False) -> dict:
    """Raw months -> typed, repaired trips; reports; month replacement.

    The typed trips are written once as Parquet below the shared checkpoint
    folder and every later step reads that table: lineage is cut (a lost
    executor costs a re-read of its files, not a recompute from the raw
    months), nothing needs to fit in executor memory, and each report reads
    only the columns it uses. The counting reports share one scan: they are
    roll-ups of a small cube that is written beside the trips. Repairs
    (imputation, ordering, period scope) are cheap projections over that
    table, recomputed per reader. With ``database`` the table is published
    there as ``silver``. Files are about ``target_file_bytes`` each, from the
    size of the typed trips. ``atomic`` (with ``database``) writes the months
    beside the old ones and switches the table's partitions to them.
    """
    months = validate_months(months)
    if atomic and not database:
        raise ValueError("an atomic replacement needs a database: readers go by the table's name")
    raw_cast = raw_standardized(spark, raw_root, months, True, services)
    if not raw_cast:
        raise ValueError(f"no raw files under {raw_root} for {months}")
    raw_plain = raw_standardized(spark, raw_root, months, False, services)
    typed_src = Q.add_date_parts(
        reduce(lambda a, b: a.unionByName(b), [conform(d, SILVER_SCHEMA) for d in raw_cast]),
        "pickup_datetime")
    work = work_path or scratch_path(spark, "silver_work")
    try:
        typed_src.write.mode("overwrite").parquet(f"{work}/typed")
        typed = spark.read.parquet(f"{work}/typed")
        C.trip_cube(typed).write.mode("overwrite").parquet(f"{work}/cube")
        cube = spark.read.parquet(f"{work}/cube")
        imputed = Q.impute_median(typed, "passenger_count", method=method)
        repaired = Q.order_timestamps(imputed)
        scoped = Q.filter_period(repaired, months)
        # the amount quartiles are selected once (one row): they are the
        # summary report, and q1/q3 give the IQR bounds that serve the bounds
        # report and the three outlier reports
        summary = Q.numeric_summary(scoped, method=method)
        summary_row = summary.first()
        summary_df = spark.createDataFrame([summary_row], summary.schema)
        iqr = Q.iqr_from_quartiles(summary_df.selectExpr("p25 AS q1", "p75 AS q3"))
        iqr_row = iqr.first()
        bounds = (iqr_row.limite_inferior, iqr_row.limite_superior)
        reports = {
            "cast_loss": A.cast_loss(raw_plain, SILVER_SCHEMA),
            "exact_duplicates": A.exact_duplicates(typed),
            "key_duplicates": A.key_duplicates(typed, TRIP_KEY),
            "passenger_distribution": A.value_distribution(typed, "passenger_count"),
            "amount_by_null_flag": A.amount_by_null_flag(typed, method=method),
            "amount_by_zero_flag": A.amount_by_zero_flag(typed, method=method),
            "impute_before_after": Q.impute_before_after(typed, method=method),
            "impute_residual": Q.impute_residual(imputed),
            "amount_summary": summary_df,
            "iqr_bounds": spark.createDataFrame([iqr_row], iqr.schema),
            "iqr_outliers": Q.iqr_outlier_counts(scoped, bounds=bounds),
            "top_outliers": Q.top_outliers(scoped, k=top_k, tie_break=TOP_TIES, bounds=bounds),
            "outliers_by_band": Q.outliers_by_band(scoped, bounds=bounds),
            "recompose_mismatch": Q.recompose_mismatch(scoped),
            **counting_reports(cube, months),
        }
        out = write_reports(reports, reports_path)
        layout = {"time_col": "pickup_datetime_tratado", "sort_within": ("tipo", "VendorID"),
                  "num_partitions": max(1, math.ceil(folder_bytes(spark, f"{work}/typed") / target_file_bytes))}
        if atomic:
            out["written"] = S.switch_months(spark, scoped, f"{database}.silver", silver_path, months, COLUMN_TEXTS, **layout)
            S.document_table(spark, f"{database}.silver", TABLE_TEXTS["silver"])
            return out
        out["written"] = S.replace_months(spark, scoped, silver_path, months, **layout)
        if database:
            S.publish(spark, f"{database}.silver", silver_path, TABLE_TEXTS["silver"], COLUMN_TEXTS)
        return out
    finally:
        if work_path is None:
            delete_path(spark, work)


# ---------------------------------------------------------------------------
# J03: serving trips + metrics + questions
# ---------------------------------------------------------------------------

def gold_job(spark: SparkSession, silver_path: str, trips_path: str, metrics_path: str,
             months, reports_path: str, question_service: str = "yellow",
             question_month: str | None = None, database: str | None = None,
             silver_table: str | None = None, target_file_bytes: int = S.TARGET_FILE_BYTES) -> dict:
    """Serving trips, hourly metrics and the questions over them.

    The trips come from ``silver_path``, or from ``silver_table`` by name
    (needed where the silver job replaced months atomically).

    ``question_month`` (default: the last requested month) is the month of the
    fixed-month question. With ``database`` both tables are published there.
    """
    months = validate_months(months)
    year, month = month_tuple(question_month or max(months))
    source_cols = [{"pickup_datetime": "pickup_datetime_tratado",
                    "dropoff_datetime": "dropoff_datetime_tratado"}.get(c, c) for c in SERVING_COLUMNS]
    renames = {"pickup_datetime_tratado": "pickup_datetime", "dropoff_datetime_tratado": "dropoff_datetime"}
    if silver_table:
        serving = (spark.table(silver_table).where(month_set_predicate(months))
                   .select(*[F.col(c).alias(renames.get(c, c)) for c in source_cols]))
    else:
        serving = S.read_table_months(spark, silver_path, months, source_cols, renames)
    written_trips = S.replace_months(spark, serving, trips_path, months, time_col="pickup_datetime",
                                     sort_within=("tipo", "VendorID"), target_file_bytes=target_file_bytes)
    # metrics are computed from the table just written (short lineage, pruned scan)
    trips = S.read_table_months(spark, trips_path, months)
    written_metrics = S.replace_months(spark, M.hourly_metrics(trips), metrics_path, months, small=True)
    metrics = spark.read.parquet(metrics_path)
    reports = {
        "trips_written": written_trips,
        "metrics_written": written_metrics,
        "mean_amount_by_month": M.mean_amount_by_month(metrics, question_service),
        "mean_passengers_by_hour": M.mean_passengers_by_hour(metrics, year, month),
        "mean_passengers_by_hour_latest": M.mean_passengers_by_hour_latest(metrics),
        "coverage": M.metrics_coverage(metrics),
    }
    if database:
        S.publish(spark, f"{database}.trips", trips_path, TABLE_TEXTS["trips"], COLUMN_TEXTS)
        S.publish(spark, f"{database}.metrics", metrics_path, TABLE_TEXTS["metrics"], COLUMN_TEXTS)
    return write_reports(reports, reports_path)


def in_reading_order(name: str, report: DataFrame) -> DataFrame:
    """A report sorted for printing: largest first where it counts or ranks, else by its columns."""
    first = next((c for c in RANKED.get(name, ()) if c in report.columns), None)
    rest = [c for c in report.columns if c != first]
    return report.orderBy(*([F.col(first).desc()] if first else []), *rest)


# ---------------------------------------------------------------------------
# command line
# ---------------------------------------------------------------------------

def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeops.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    land = sub.add_parser("land")
    land.add_argument("--source-root", required=True)
    land.add_argument("--raw-root", required=True)
    silver = sub.add_parser("silver")
    silver.add_argument("--raw-root", required=True)
    silver.add_argument("--silver-path", required=True)
    gold = sub.add_parser("gold")
    gold.add_argument("--silver-path", required=True)
    gold.add_argument("--trips-path", required=True)
    gold.add_argument("--metrics-path", required=True)
    for sp in (land, silver, gold):
        sp.add_argument("--months", default=None,
                        help="comma-separated YYYY-MM list; default: two months back")
        sp.add_argument("--reports-path", required=True)
    for sp in (land, silver, gold):
        sp.add_argument("--database", default=None, help="publish the written tables there")
    silver.add_argument("--work-path", default=None,
                        help="shared folder for the typed work table; default: below spark.checkpoint.dir")
    silver.add_argument("--atomic", action="store_true", help="switch the table's months to the new ones when all is written")
    gold.add_argument("--silver-table", default=None, help="read the trips by this name instead of by path")
    silver.add_argument("--top-k", type=int, default=20, help="rows of the top_outliers report")
    gold.add_argument("--question-month", default=None, help="YYYY-MM of the fixed-month question")
    return p


def main(argv=None) -> None:
    from lakeops.session import build_session
    args = _parser().parse_args(argv)
    months = parse_months(args.months) if args.months else default_months()
    spark = build_session(app_name=f"lakeops-{args.job}")
    if args.job == "land":
        out = land_job(spark, args.source_root, args.raw_root, months, args.reports_path, database=args.database)
    elif args.job == "silver":
        out = silver_job(spark, args.raw_root, args.silver_path, months, args.reports_path,
                         work_path=args.work_path, database=args.database, top_k=args.top_k, atomic=args.atomic)
    else:
        out = gold_job(spark, args.silver_path, args.trips_path, args.metrics_path, months,
                       args.reports_path, question_month=args.question_month, database=args.database,
                       silver_table=args.silver_table)
    for name, df in out.items():
        print(f"\n[{name}] {df.count()} rows")
        in_reading_order(name, df).show(20, truncate=False)


if __name__ == "__main__":
    main()
