"""Column profile of raw monthly files, and the schema audits built on it.

Months whose files share a schema are profiled by one scan: a single
aggregate over all columns, by month (taken from the file's path), partially
aggregated per task and unpivoted to one row per column. The plan grows with
the number of different schemas, not of files. Missing columns and type
drift are then small aggregates over the profile.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.schema import quote, sql_literal
from lakeops.sources.bronze import month_leaves, schema_groups

PROFILE_SCHEMA = ("taxi_type string, periodo string, total_registros bigint, coluna string, "
                  "datatype string, nullable boolean, min string, max string, nulls bigint")


def profile_frame(df: DataFrame, service: str, period: str) -> DataFrame:
    """Long-form profile of every column of ``df``: rows, type, min, max, nulls."""
    return _profiled(df.schema, df, service, sql_literal(period), [period])


def _profiled(schema, df: DataFrame, service: str, period: str, periods: list[str]) -> DataFrame:
    """One aggregate over all columns per value of ``period`` (SQL text), then ``stack`` to one row per column.

    Both steps are SQL text sent in one call each; a period without rows
    (an empty file) still gets its rows.
    """
    fields = schema.fields
    aggs = ["count(1) AS _rows"]
    for i, f in enumerate(fields):
        q = quote(f.name)
        aggs += [f"CAST(min({q}) AS STRING) AS mn{i}", f"CAST(max({q}) AS STRING) AS mx{i}",
                 f"count({q}) AS nn{i}"]
    wide = df.groupBy(F.expr(period).alias("_period")).agg(*map(F.expr, aggs))
    asked = df.sparkSession.createDataFrame([(p,) for p in periods], "_period string")
    entries = ", ".join(
        f"{sql_literal(f.name)}, {sql_literal(f.dataType.simpleString())}, "
        f"{'true' if f.nullable else 'false'}, mn{i}, mx{i}, coalesce(nn{i}, 0L)"
        for i, f in enumerate(fields))
    long = asked.join(wide, "_period", "left").selectExpr(
        "_period", "coalesce(_rows, 0L) AS _rows", f"stack({len(fields)}, {entries}) AS (coluna, datatype, nullable, min, max, nn)")
    return long.selectExpr(
        f"{sql_literal(service)} AS taxi_type", "_period AS periodo",
        "_rows AS total_registros", "coluna", "datatype", "nullable", "min", "max",
        "_rows - nn AS nulls")


def profile_columns(spark: SparkSession, root: str, services: Iterable[str], months) -> DataFrame:
    """Profile of every (service, month) raw file present under ``root``."""
    parts = []
    for service in services:
        leaves = month_leaves(spark, root, service, months)
        for schema, names in schema_groups(spark, leaves).items():
            files = spark.read.parquet(*(leaves[m] for m in names))
            month = r"regexp_replace(regexp_extract(_metadata.file_path, 'year=\\d+/month=\\d+', 0), 'year=(\\d+)/month=', '$1-')"
            parts.append(_profiled(files.schema, files, service, month, names))
    if not parts:
        return spark.createDataFrame([], PROFILE_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), parts)


def missing_columns(profile: DataFrame) -> DataFrame:
    """Columns (case-sensitive names) absent from some periods of a service."""
    periods = profile.groupBy("taxi_type").agg(F.countDistinct("periodo").alias("total_periodos"))
    present = profile.groupBy("taxi_type", "coluna").agg(F.countDistinct("periodo").alias("presente_em"))
    return (present.join(periods, "taxi_type")
            .where(F.col("presente_em") < F.col("total_periodos"))
            .select("taxi_type", "coluna", "presente_em", "total_periodos"))


def type_drift(profile: DataFrame) -> DataFrame:
    """Profile rows of the columns whose datatype differs between periods."""
    drifting = (profile.groupBy("taxi_type", "coluna")
                .agg(F.countDistinct("datatype").alias("_types"))
                .where(F.col("_types") > 1).select("taxi_type", "coluna"))
    return profile.join(drifting, ["taxi_type", "coluna"], "left_semi")
