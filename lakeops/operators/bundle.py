"""Fused reports: many small audits from one scan.

The per-dimension NULL and zero rates (by vendor, by subtype of one service,
by flag) are six separate groupBys when written one by one; here rows are
counted once on all three keys and the grouping sets roll those counts up -
one scan, and shuffles of at most #vendors x #subtypes x #flags rows per task. The one-row timestamp
reports are likewise one global aggregate. Results equal the unfused
operators (tested).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import expressions as X


def rate_bundle(df: DataFrame, column: str = "passenger_count", vendor: str = "VendorID",
                subtype: str = "trip_type", flag: str = "store_and_fwd_flag",
                service_col: str = "tipo", subtype_service: str = "green") -> DataFrame:
    """Long form: dimension, value, total, nulls, pct nulls, zeros, pct zeros.

    The subtype dimension only counts rows of ``subtype_service`` (as the
    unfused report filters on it); its groups with no such rows are dropped.
    """
    c = F.col(column)
    # counted once on all keys: the grouping sets triple these few cells, not the rows
    cells = df.groupBy(vendor, subtype, flag, (F.col(service_col) == subtype_service).alias("_sub_row")).agg(
        F.count(F.lit(1)).alias("_n"), X.count_if(c.isNull()).alias("_null"), X.count_if(c == 0).alias("_zero"))
    in_sub = F.col("_sub_row")
    gid = F.grouping_id(vendor, subtype, flag)
    agg = (cells.groupingSets([[vendor], [subtype], [flag]], vendor, subtype, flag)
           .agg(gid.alias("_gid"),
                F.sum("_n").alias("_all"),
                F.sum("_null").alias("_null_all"),
                F.sum("_zero").alias("_zero_all"),
                F.coalesce(F.sum(F.when(in_sub, F.col("_n"))), F.lit(0)).alias("_sub"),
                F.sum(F.when(in_sub, F.col("_null"))).alias("_null_sub"),
                F.sum(F.when(in_sub, F.col("_zero"))).alias("_zero_sub")))
    # grouping_id bits follow (vendor, subtype, flag): 3 = vendor only, 5 = subtype, 6 = flag
    dim = (F.when(F.col("_gid") == 3, F.lit(vendor))
            .when(F.col("_gid") == 5, F.lit(subtype)).otherwise(F.lit(flag)))
    value = (F.when(F.col("_gid") == 3, F.col(vendor).cast("string"))
              .when(F.col("_gid") == 5, F.col(subtype).cast("string"))
              .otherwise(F.col(flag).cast("string")))
    is_sub = F.col("_gid") == 5
    total = F.when(is_sub, F.col("_sub")).otherwise(F.col("_all"))
    nulls = F.when(is_sub, F.col("_null_sub")).otherwise(F.col("_null_all"))
    zeros = F.when(is_sub, F.col("_zero_sub")).otherwise(F.col("_zero_all"))
    out = agg.select(dim.alias("dimensao"), value.alias("valor"), total.alias("total"),
                     nulls.alias(f"{column}_nulo"), zeros.alias(f"{column}_zero"))
    return (out.where(F.col("total") > 0)
            .withColumn(f"pct_{column}_nulo", X.pct(F.col(f"{column}_nulo"), F.col("total")))
            .withColumn(f"pct_{column}_zero", X.pct(F.col(f"{column}_zero"), F.col("total"))))


def timestamp_bundle(df: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime",
                     out_start: str = "pickup_datetime_tratado",
                     out_end: str = "dropoff_datetime_tratado",
                     flag: str = "store_and_fwd_flag") -> DataFrame:
    """One row: inverted rows, flag filled among them, gap buckets, still
    inverted after the fix, starts and ends changed (a repaired frame)."""
    inv = F.col(end) < F.col(start)
    gap = X.duration_minutes(end, start)
    return df.agg(
        X.count_if(inv).alias("total_inconsistentes"),
        F.count(F.when(inv, F.col(flag))).alias("store_and_fwd_flag_preenchido"),
        X.count_if(inv & (gap <= 1)).alias("ate_1_min"),
        X.count_if(inv & (gap > 1) & (gap <= 5)).alias("de_1_a_5_min"),
        X.count_if(inv & (gap > 5) & (gap <= 60)).alias("de_5_a_60_min"),
        X.count_if(inv & (gap > 60)).alias("acima_60_min"),
        X.count_if(F.col(out_end) < F.col(out_start)).alias("ainda_invertidos"),
        X.count_if(F.col(start) != F.col(out_start)).alias("pickup_alterado"),
        X.count_if(F.col(end) != F.col(out_end)).alias("dropoff_alterado"))
