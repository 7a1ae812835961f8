"""Writing month-partitioned tables.

``replace_months`` replaces exactly the requested (year, month) folders of a
table and nothing else. On plain Parquet that is a directory overwrite per
month - not transactional: a reader during the write may see a month half
replaced. ``switch_months`` is the atomic form for tables with a catalog
entry: every delivery is written to a folder of its own, which no reader
knows of, and a month is committed by pointing its partition there, one
metadata operation. A reader sees the old month or the new one; a failed
write leaves the table as it was; old versions stay until
``drop_old_versions``.

Scale notes. Given a time column, rows are range-partitioned on (year, month,
time) before the write: a month holding a third of all rows is split too (the
range bounds come from a sample) and each task writes files whose time range
does not overlap the others' (tight Parquet min/max for time filters). The
number of ranges is ``num_partitions``, or follows from the size of the data
and ``target_file_bytes`` (``ranges_by_month``), or is
``spark.sql.shuffle.partitions``; adaptive execution merges small ranges but
never splits one. Inside a file rows may be sorted by further columns first
(``sort_within``) and carry Bloom filters (``bloom_columns``), so row groups
are skipped for filters on service or vendor as well. Without a time column
rows are rebalanced by (year, month): adaptive execution merges and splits
the partitions by size, so a month has few files however many tasks read it.
Row counts per month are taken during the write with an ``Observation`` - no
extra scan.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.periods import month_set_predicate, month_tuple, validate_months
from lakeops.functions.schema import sql_literal
from lakeops.session import child_names, delete_path, folder_bytes, path_exists, scratch_path

TARGET_FILE_BYTES = 256 << 20


def partition_dir(table_path: str, year: int, month: int) -> str:
    """Where Spark writes a month, and where the catalog looks for it."""
    return f"{table_path.rstrip('/')}/year={year}/month={month}"


def cluster_by_time(df: DataFrame, time_col: str, partition_cols=("year", "month"),
                    num_partitions: int | None = None, sort_within=()) -> DataFrame:
    """Range-partition on (partition cols, time) and sort inside each task.

    ``sort_within`` columns come before the time in that sort: a file then
    holds runs of equal values, which row-group min/max tell apart.

    Files written from the result hold disjoint, sorted time ranges within a
    month, so min/max statistics skip files for time filters (the write-time
    form of a sort / single-column z-order rewrite).

    Ties are broken by the input partition of the row: a single hot time
    value (say a default timestamp on a third of all rows) is then split
    over as many ranges as the input partitions carrying it, instead of
    landing in one task. The tie-breaker is deterministic on recompute (a
    row's input partition does not change), which range partitioning needs.
    """
    keys = [*partition_cols, time_col, "_lakeops_part"]
    tagged = df.withColumn("_lakeops_part", F.spark_partition_id())
    ranged = (tagged.repartitionByRange(num_partitions, *keys) if num_partitions
              else tagged.repartitionByRange(*keys))
    return ranged.sortWithinPartitions(*partition_cols, *sort_within, time_col, "_lakeops_part").drop("_lakeops_part")


def ranges_by_month(df: DataFrame, target_file_bytes: int = TARGET_FILE_BYTES, fraction: float = 0.01,
                    year_col: str = "year", month_col: str = "month") -> dict[tuple[int, int], int]:
    """Files per month for a size wanted, from a sampled size histogram.

    A ``fraction`` of the rows is written as Parquet below the shared
    checkpoint folder, by month; the bytes a month takes there, over the
    fraction, are its size. One scan; a month not in the sample gets one file.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "size-sample")
    rows = df.withColumns({"_lakeops_y": F.col(year_col), "_lakeops_m": F.col(month_col)})
    months = sorted((r["y"], r["m"]) for r in rows.select(F.col("_lakeops_y").alias("y"), F.col("_lakeops_m").alias("m"))
                    .where("y is not null and m is not null").distinct().collect())
    try:
        (rows.sample(fraction=fraction, seed=7).hint("rebalance", F.col("_lakeops_y"), F.col("_lakeops_m"))
         .write.partitionBy("_lakeops_y", "_lakeops_m").parquet(path))
        return {(y, m): max(1, math.ceil(folder_bytes(spark, f"{path}/_lakeops_y={y}/_lakeops_m={m}") / fraction / target_file_bytes))
                for y, m in months}
    finally:
        delete_path(spark, path)


def replace_months(spark: SparkSession, df: DataFrame, table_path: str, months,
                   time_col: str | None = None, year_col: str = "year",
                   month_col: str = "month", num_partitions: int | None = None,
                   small: bool = False, target_file_bytes: int | None = None,
                   sort_within=(), bloom_columns=(), write_options: Mapping[str, str] | None = None) -> DataFrame:
    """Replace exactly the requested months of a partitioned Parquet table.

    * rows of months that were not requested are not written (they are
      counted and reported as ``stray``) - a stray row never replaces a month
      the caller did not ask for;
    * a requested month with no rows is emptied (its directory is removed),
      instead of keeping its old rows;
    * months not requested are left untouched (dynamic partition overwrite).

    With ``time_col`` the rows are range-partitioned on (year, month, time)
    and sorted (``cluster_by_time``) into ``num_partitions`` ranges, or as many
    as files of ``target_file_bytes`` need; without
    it they are rebalanced by month. ``small=True`` is for tiny
    aggregated tables: one shuffle to a single task after the aggregation
    (which keeps its own parallelism), so each month is one file.

    Returns a report with one row per requested month (rows written) plus the
    stray count. Never read and replace the same table in one plan: write to
    a new location first if the input derives from ``table_path``.
    """
    months = validate_months(months)
    if time_col and target_file_bytes and not num_partitions:
        num_partitions = sum(ranges_by_month(df, target_file_bytes, year_col=year_col, month_col=month_col).values()) or 1
    keep = F.coalesce(month_set_predicate(months, year_col, month_col), F.lit(False))
    marked = df.withColumn("_lakeops_keep", keep)
    if time_col:
        marked = cluster_by_time(marked, time_col, (year_col, month_col), num_partitions, sort_within)
    elif small:
        marked = marked.repartition(1)
    else:
        marked = marked.hint("rebalance", F.col(year_col), F.col(month_col))
    # The observation sits above the range exchange: the sampling job that
    # computes the range bounds re-runs the plan below it, so metrics taken
    # there would be counted twice. Strays travel through the shuffle and are
    # dropped right after it (in practice they are rare: callers pass frames
    # scoped to the batch).
    metrics = [F.count(F.lit(1)).alias("input_rows"),
               F.sum((~F.col("_lakeops_keep")).cast("int")).alias("stray")]
    for m in months:
        y, mm = month_tuple(m)
        hit = (F.col(year_col) == y) & (F.col(month_col) == mm)
        metrics.append(F.sum(hit.cast("int")).alias(f"m_{y}_{mm}"))
    obs = Observation("replace_months")
    observed = marked.observe(obs, *metrics).where("_lakeops_keep").drop("_lakeops_keep")
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom_columns}
    (observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**blooms, **(write_options or {}))
     .partitionBy(year_col, month_col).parquet(table_path))
    got = obs.get
    report = []
    for m in months:
        y, mm = month_tuple(m)
        n = int(got.get(f"m_{y}_{mm}") or 0)
        if n == 0:
            delete_path(spark, partition_dir(table_path, y, mm))
        report.append((m, n, int(got.get("stray") or 0)))
    return spark.createDataFrame(report, "ano_mes string, registros bigint, stray bigint")


def read_table_months(spark: SparkSession, table_path: str, months=None,
                      columns: Iterable[str] | None = None,
                      renames: Mapping[str, str] | None = None) -> DataFrame:
    """Scan a (year, month)-partitioned Parquet table, pruned to ``months``.

    With ``months`` only the folders of those months are listed and read; a
    month without a folder has no rows. ``columns`` prunes the Parquet read
    schema.
    """
    if months is None:
        df = spark.read.parquet(table_path)
    else:
        asked = [partition_dir(table_path, *month_tuple(m)) for m in validate_months(months)]
        there = [p for p in asked if path_exists(spark, p)]
        if there:
            df = spark.read.option("basePath", table_path).parquet(*there)
        else:
            df = spark.read.parquet(table_path).where(month_set_predicate(months))
    if columns is not None:
        renames = renames or {}
        df = df.select(*[F.col(c).alias(renames.get(c, c)) for c in columns])
    return df


# ---------------------------------------------------------------------------
# catalog registration and documentation
# ---------------------------------------------------------------------------

def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def register_table(spark: SparkSession, table: str, location: str,
                   partition_cols=("year", "month"), schema=None,
                   comments: Mapping[str, str] | None = None) -> None:
    """External Parquet table over a partitioned folder, brought up to date on every call.

    Column types come from ``schema`` or, by default, from the files (Spark
    reads one footer; no per-column string fallback), column texts from
    ``comments``. A registration of the same folder whose columns are still
    there with their types is kept, so readers by name find it all the time:
    new columns are added, texts set, partitions synchronised with storage.
    Only a changed type, a vanished column or another folder replaces it (the
    table is external, its files stay).
    """
    schema = schema or spark.read.parquet(location).schema
    comments = comments or {}
    if table_exists(spark, table) and _may_stay(spark, table, location, schema):
        known = spark.table(table).columns
        new = [f for f in schema.fields if f.name not in known]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_column_list(new, comments)})")
        for c in (c for c in comments if c in known and c not in partition_cols):
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{c}` COMMENT {sql_literal(comments[c])}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        _create_table(spark, table, location, schema, partition_cols, comments)
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def _may_stay(spark: SparkSession, table: str, location: str, schema) -> bool:
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    here = told.get("Location", "").removeprefix("file:").rstrip("/")
    types = {f.name: f.dataType for f in schema.fields}
    return (here == location.removeprefix("file:").rstrip("/")
            and all(types.get(f.name) == f.dataType for f in spark.table(table).schema.fields))


def _column_list(fields, comments: Mapping[str, str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     + (f" COMMENT {sql_literal(comments[f.name])}" if f.name in comments else "") for f in fields)


def _create_table(spark: SparkSession, table: str, location: str, schema, partition_cols, comments: Mapping[str, str]) -> None:
    if "." in table:
        create_database(spark, table.rpartition(".")[0])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_column_list(schema.fields, comments)}) USING parquet "
              f"PARTITIONED BY ({', '.join(partition_cols)}) LOCATION '{location}'")


def publish(spark: SparkSession, table: str, location: str, text: str,
            comments: Mapping[str, str] | None = None, props: Mapping[str, str] | None = None) -> None:
    """Register a written table, creating its database, with its texts and properties."""
    if "." in table:
        create_database(spark, table.rpartition(".")[0])
    register_table(spark, table, location, comments=comments)
    document_table(spark, table, text)
    if props:
        set_table_properties(spark, table, props)


def register_partitions(spark: SparkSession, table: str, location: str, months) -> None:
    """Add one partition per month, or point an existing one at its folder again; others untouched."""
    for m in validate_months(months):
        y, mm = month_tuple(m)
        part, path = f"PARTITION (year={y}, month={mm})", partition_dir(location, y, mm)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {part} LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


# ---------------------------------------------------------------------------
# versioned months
# ---------------------------------------------------------------------------

def write_version(spark: SparkSession, df: DataFrame, location: str, months, **layout) -> tuple[str, DataFrame]:
    """Write the months to a folder of their own below ``location``; no reader sees it yet.

    ``layout``: as for ``replace_months``. Returns the folder and its report.
    """
    version = f"{location.rstrip('/')}/versions/{uuid.uuid4().hex}"
    return version, replace_months(spark, df, version, months, **layout)


def commit_version(spark: SparkSession, table: str, version: str, months, comments: Mapping[str, str] | None = None) -> None:
    """Make a written version the months' content, month by month.

    An existing table's partition is pointed at the version's folder, one
    catalog operation a month; a month without rows loses its partition. A
    table that does not exist yet is created with the version's columns; one
    that lacks some of them is given them first.
    """
    location = version.rpartition("/versions/")[0]
    written = [m for m in validate_months(months) if path_exists(spark, partition_dir(version, *month_tuple(m)))]
    if table_exists(spark, table):
        if written:
            known = {c.lower() for c in spark.table(table).columns}
            new = [f for f in spark.read.parquet(version).schema.fields if f.name.lower() not in known]
            if new:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    else:
        if not written:
            return
        _create_table(spark, table, location, spark.read.parquet(version).schema, ("year", "month"), comments or {})
    for m in validate_months(months):
        y, mm = month_tuple(m)
        if m in written:
            register_partitions(spark, table, version, [m])
        else:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (year={y}, month={mm})")
    spark.catalog.refreshTable(table)


def switch_months(spark: SparkSession, df: DataFrame, table: str, location: str, months,
                  comments: Mapping[str, str] | None = None, **layout) -> DataFrame:
    """Replace exactly the requested months of a catalog table, each atomically; the report of ``replace_months``.

    ``df`` may read the table itself: what it reads stays until the switch.
    """
    version, report = write_version(spark, df, location, months, **layout)
    commit_version(spark, table, version, months, comments)
    return report


def current_folders(spark: SparkSession, table: str) -> dict[tuple[int, int], str]:
    """The folder that each month of the table is read from."""
    found = {}
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = dict(part.split("=") for part in r[0].split("/"))
        y, m = int(spec["year"]), int(spec["month"])
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (year={y}, month={m})").collect()
        found[y, m] = next(t[1] for t in told if t[0] == "Location")
    return found


def drop_old_versions(spark: SparkSession, table: str, location: str) -> list[str]:
    """Delete the versions below ``location`` that no month of the table is read from.

    For times without running readers or writers: a delivery written but not
    committed counts as old.
    """
    used = {folder.rpartition("/versions/")[2].split("/")[0] for folder in current_folders(spark, table).values()}
    root = f"{location.rstrip('/')}/versions"
    gone = [v for v in child_names(spark, root) if v not in used]
    for v in gone:
        delete_path(spark, f"{root}/{v}")
    return gone


def with_column_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments as field metadata (kept by ``saveAsTable``,
    partition columns included, which cannot be commented afterwards)."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments
                       else F.col(c) for c in df.columns])


def document_table(spark: SparkSession, table: str, comment: str) -> None:
    text = comment.replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")


def set_table_properties(spark: SparkSession, table: str, props: Mapping[str, str]) -> None:
    """``ALTER TABLE ... SET TBLPROPERTIES``: a note for readers of the catalog.

    What skips row groups is written into the files (``sort_within`` and
    ``bloom_columns`` of ``replace_months``).
    """
    items = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({items})")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)
