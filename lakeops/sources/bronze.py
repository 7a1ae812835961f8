"""Raw monthly files: landing and reading by month.

Layout of the raw zone: ``<root>/<service>/year=YYYY/month=MM/`` with one
Parquet data set per (service, month), stored exactly as delivered. The
types of a column may differ between months (long in one, double in the
next), so a month is always read on its own path - a directory read over
months with conflicting types fails even with an explicit schema - and is
conformed before any union. Months whose files share a schema are read
together in one multi-path scan, so the plan does not grow by one relation
per month.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping
from contextlib import nullcontext
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.periods import month_tuple, validate_months
from lakeops.functions.schema import SILVER_SCHEMA, conform, quote, try_cast_sql
from lakeops.session import child_names, delete_path, local_path, path_exists, rename_path
from lakeops.sources.services import SERVICES, standardize, standardize_sql
from lakeops.sources.sinks import create_database


def leaf_path(root: str, service: str, month: str) -> str:
    year, mon = month_tuple(month)
    return f"{root.rstrip('/')}/{service}/year={year:04d}/month={mon:02d}"


def source_path(source_root: str, service: str, month: str) -> str:
    """Where a delivered raw file for (service, month) is expected."""
    return f"{source_root.rstrip('/')}/{service}_tripdata_{month}.parquet"


def clear_months(spark: SparkSession, root: str, services: Iterable[str], months) -> list[str]:
    """Remove the requested (service, month) leaves before landing them again."""
    cleared = []
    for service in services:
        for month in validate_months(months):
            path = leaf_path(root, service, month)
            delete_path(spark, path)
            cleared.append(path)
    return cleared


# ---------------------------------------------------------------------------
# landing: the delivered bytes
# ---------------------------------------------------------------------------

COPY_CHUNK = 8 << 20
MANIFEST = "servico string, ano_mes string, arquivo string, bytes bigint, sha256 string, registros bigint"


def _delivered(spark: SparkSession, src: str) -> list[str]:
    """Names of the files of a delivery: of the folder's data files, or '' for a single file."""
    names = [n for n in child_names(spark, src) if n[:1] not in "._"]
    return [""] if names == [src.rstrip("/").rpartition("/")[2]] else names


def _each_file(spark: SparkSession, files: list[tuple], copy: bool) -> list:
    """Read every file in a task of its own; write it elsewhere if ``copy``. ``(service, month, name, bytes, sha256, rows, error)``.

    Files are streamed in chunks, whatever their size. A copy is written
    under a name of its own and renamed when complete, so a task that runs
    twice leaves one whole file.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                size = rows = None
                digest, error = hashlib.sha256(), None
                try:
                    fs, source = pyarrow_fs(row["src"])
                    part = None
                    if copy:
                        _, target = pyarrow_fs(row["dst"])
                        fs.create_dir(target.rpartition("/")[0], recursive=True)
                        part = f"{target}.{uuid.uuid4().hex}.part"
                    with fs.open_input_stream(source) as read, (fs.open_output_stream(part) if copy else nullcontext()) as write:
                        size = 0
                        while chunk := read.read(COPY_CHUNK):
                            digest.update(chunk)
                            size += len(chunk)
                            if copy:
                                write.write(chunk)
                    if copy:
                        fs.move(part, target)
                    rows = pq.read_metadata(source, filesystem=fs).num_rows
                except Exception as exc:  # noqa: BLE001 - every failure is reported together
                    error = f"{type(exc).__name__}: {exc}"
                out.append({"servico": row["servico"], "ano_mes": row["ano_mes"], "arquivo": row["arquivo"], "bytes": size,
                            "sha256": digest.hexdigest(), "registros": rows, "erro": error})
            yield pa.RecordBatch.from_pylist(out, schema=told)

    told = pa.schema([("servico", pa.string()), ("ano_mes", pa.string()), ("arquivo", pa.string()), ("bytes", pa.int64()),
                      ("sha256", pa.string()), ("registros", pa.int64()), ("erro", pa.string())])
    if not files:
        return []
    asked = spark.createDataFrame(files, "servico string, ano_mes string, arquivo string, src string, dst string")
    return asked.repartition(len(files), "src").mapInArrow(run, MANIFEST + ", erro string").collect()


def pyarrow_fs(path: str):
    """The Arrow file system and path of a URI or local path, in a task."""
    from pyarrow import fs
    local = local_path(path)
    return (fs.LocalFileSystem(), local) if local != path or "://" not in path else fs.FileSystem.from_uri(path)


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of the raw zone: per landed file its bytes, SHA-256 and rows, as of its last landing."""
    where = f"{root.rstrip('/')}/_manifest"
    if not path_exists(spark, where):
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST + ", entrega bigint").parquet(where)
    last = rows.groupBy("servico", "ano_mes").agg(F.max("entrega").alias("entrega"))
    return rows.join(last, ["servico", "ano_mes", "entrega"], "left_semi").drop("entrega").where("arquivo is not null")


def land_months(spark: SparkSession, source_root: str, root: str, services: Iterable[str], months) -> DataFrame:
    """Land each (service, month) delivery in the raw zone, byte for byte.

    Files are copied by tasks, one file each, in chunks; nothing is decoded
    or written anew. Each month arrives in a folder beside its leaf and takes
    the leaf's place when it is complete. The manifest keeps every file's
    length, SHA-256 and rows (from its footer): a delivery equal to the landed
    one is read but not copied again, and its leaf stays as it is.

    Failures (no delivery, a file that cannot be read or is no Parquet) are
    gathered and raised together at the end; the leaves of those months are
    cleared, so none holds stale data. The report has one row per month.
    """
    months, services, root = validate_months(months), list(services), root.rstrip("/")
    failures: dict[tuple, str] = {}
    known: dict[tuple, set] = defaultdict(set)
    for r in landed_files(spark, root).where(F.col("servico").isin(services) & F.col("ano_mes").isin(months)).collect():
        known[r.servico, r.ano_mes].add((r.arquivo, r.bytes, r.sha256, r.registros))
    jobs = {(s, m): f"{leaf_path(root, s, m)}.incoming-{uuid.uuid4().hex[:8]}" for s in services for m in months}
    names: dict[tuple, list[str]] = {}
    for s, m in jobs:
        names[s, m] = _delivered(spark, source_path(source_root, s, m))
        if not names[s, m]:
            failures[s, m] = f"missing source {source_path(source_root, s, m)}"

    def files(wanted) -> list[tuple]:
        return [(s, m, n or source_path("", s, m).strip("/"), f"{source_path(source_root, s, m)}/{n}".rstrip("/"),
                 f"{jobs[s, m]}/{n or source_path('', s, m).strip('/')}") for s, m in wanted for n in names[s, m]]

    def gathered(rows) -> dict[tuple, set]:
        found: dict[tuple, set] = defaultdict(set)
        for r in rows:
            if r.erro:
                failures[r.servico, r.ano_mes] = f"{r.arquivo}: {r.erro}"
            found[r.servico, r.ano_mes].add((r.arquivo, r.bytes, r.sha256, r.registros))
        return found

    there = [k for k in known if k not in failures and path_exists(spark, leaf_path(root, *k))]
    unchanged = {k for k, seen in gathered(_each_file(spark, files(there), copy=False)).items() if seen == known[k]}
    copied = gathered(_each_file(spark, files([k for k in jobs if k not in failures and k not in unchanged]), copy=True))
    for key, incoming in jobs.items():
        if key in unchanged and key not in failures:
            continue
        delete_path(spark, leaf_path(root, *key))
        if key in failures:
            delete_path(spark, incoming)
        else:
            rename_path(spark, incoming, leaf_path(root, *key))
    now = time.time_ns()
    # a month that failed gets a row without a file: it is not landed any more
    rows = [(*key, *f, now) for key, seen in copied.items() if key not in failures for f in seen] + [
        (*key, None, None, None, None, now) for key in failures if key in known]
    if rows:
        spark.createDataFrame(rows, MANIFEST + ", entrega bigint").coalesce(1).write.mode("append").parquet(f"{root}/_manifest")
    if failures:
        raise RuntimeError("landing failed for: " + "; ".join(f"{s} {m}: {e}" for (s, m), e in sorted(failures.items())))
    counted = {**{k: known[k] for k in unchanged}, **copied}
    report = [(*key, sum(f[3] for f in counted[key])) for key in jobs]
    return spark.createDataFrame(report, "servico string, ano_mes string, registros bigint")


def month_leaves(spark: SparkSession, root: str, service: str, months) -> dict[str, str]:
    """Existing leaves of the requested months, ``{month: path}``, sorted."""
    found = {}
    for month in sorted(validate_months(months)):
        path = leaf_path(root, service, month)
        if path_exists(spark, path):
            found[month] = path
    return found


def schema_groups(spark: SparkSession, leaves: Mapping[str, str]) -> dict[str, list[str]]:
    """Months whose files share a schema, by that schema (as JSON)."""
    groups: dict[str, list[str]] = defaultdict(list)
    for month, path in leaves.items():
        groups[spark.read.parquet(path).schema.json()].append(month)
    return dict(groups)


def read_months_raw(spark: SparkSession, root: str, service: str, months) -> list[DataFrame]:
    """One scan per group of months whose files share a schema.

    Reading a leaf path adds no ``year``/``month`` columns, so the raw
    columns come back exactly as stored.
    """
    leaves = month_leaves(spark, root, service, months)
    return [spark.read.parquet(*(leaves[m] for m in names)) for names in schema_groups(spark, leaves).values()]


def read_service_months(spark: SparkSession, root: str, service: str, months,
                        schema: Mapping[str, str] = SILVER_SCHEMA) -> DataFrame | None:
    """Standardized, conformed rows of one service for the requested months."""
    parts = [conform(standardize(df, SERVICES[service]), schema)
             for df in read_months_raw(spark, root, service, months)]
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_months(spark: SparkSession, root: str, services: Iterable[str], months,
                schema: Mapping[str, str] = SILVER_SCHEMA) -> DataFrame:
    """All requested services and months, conformed to ``schema``, unioned."""
    parts = [df for df in (read_service_months(spark, root, s, months, schema) for s in services)
             if df is not None]
    if not parts:
        raise ValueError(f"no raw files found under {root} for {list(months)}")
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---------------------------------------------------------------------------
# the raw zone in the catalog
# ---------------------------------------------------------------------------

def publish_raw(spark: SparkSession, database: str, root: str, services: Iterable[str], months,
                schema: Mapping[str, str] = SILVER_SCHEMA, view: str = "raw_trips") -> str:
    """Register the landed months and the view ``database.view`` that conforms and unites them; returns its name.

    A Parquet table has one schema, the raw months may have several: months
    with equal schemas are partitions of one external table, named by the
    schema's digest, and a month delivered again with another schema moves
    from one to the other. The view reads every registered month, not only
    those of this call, in the target types: a value that does not fit is
    NULL, as is a column that a month was delivered without. It carries the
    file's ``year`` and ``month``; filters on them prune partitions.
    """
    create_database(spark, database)
    parts = []
    for service in services:
        leaves = month_leaves(spark, root, service, months)
        prefix = f"raw_{service}_"
        table_of: dict[str, str] = {}
        for text, names in schema_groups(spark, leaves).items():
            table = f"{database}.{prefix}{hashlib.sha256(text.encode()).hexdigest()[:12]}"
            cols = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(text)).fields)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, year INT, month INT) USING parquet "
                      f"PARTITIONED BY (year, month) LOCATION '{root.rstrip('/')}/{service}'")
            table_of |= dict.fromkeys(names, table)
        tables = [f"{database}.{r.tableName}" for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{prefix}*'").collect()]
        for month in validate_months(months):
            y, m = month_tuple(month)
            for table in tables:
                if table_of.get(month) != table:
                    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (year={y}, month={m})")
            if month in table_of:
                spark.sql(f"ALTER TABLE {table_of[month]} ADD IF NOT EXISTS PARTITION (year={y}, month={m}) LOCATION '{leaves[month]}'")
        for table in sorted(tables):
            spark.catalog.refreshTable(table)
            if spark.sql(f"SHOW PARTITIONS {table}").limit(1).count():
                parts.append(_conforming_select(spark.table(table), table, service, schema))
    if not parts:
        raise ValueError(f"no landed months under {root} for {list(months)}")
    name = f"{database}.{view}"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + "\nUNION ALL\n".join(parts))
    return name


def _conforming_select(df: DataFrame, table: str, service: str, schema: Mapping[str, str]) -> str:
    """SQL text: one raw table standardized as ``standardize`` does, in the types of ``schema``, with its year and month."""
    raw = df.drop("year", "month")
    named = standardize(raw, SERVICES[service])
    inner = ", ".join([*standardize_sql(raw, SERVICES[service]), "year", "month"])
    outer = [f"{try_cast_sql(named, c, t) if c in named.columns else f'CAST(NULL AS {t})'} AS {quote(c)}" for c, t in schema.items()]
    return f"SELECT {', '.join(outer)}, year, month FROM (SELECT {inner} FROM {table})"
