import glob
import hashlib
import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeops.session import local_path
from lakeops.sources import bronze as B
from lakeops.sources import events_trips as E
from lakeops.sources import sinks as S

SF = "/root/testdata/sf0.001"


def _frame(spark):
    rows = [(i, 2024, m, f"2024-{m:02d}-0{1 + i % 5} 10:00:00") for m in (1, 2, 3, 4) for i in range(5)]
    return (spark.createDataFrame(rows, "id int, year int, month int, ts string")
            .withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def _months(spark, path):
    return sorted({(r.year, r.month) for r in spark.read.parquet(path).select("year", "month").distinct().collect()})


def test_replace_is_idempotent_and_scoped(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = _frame(spark)
    S.replace_months(spark, df, path, ["2024-01", "2024-02", "2024-03"])
    before = sorted(map(tuple, spark.read.parquet(path).collect()))
    report = S.replace_months(spark, df, path, ["2024-02"])   # every other month is a stray
    after = sorted(map(tuple, spark.read.parquet(path).collect()))
    assert before == after                                    # reprocessing twice changes nothing
    r = report.collect()[0]
    assert (r.ano_mes, r.registros, r.stray) == ("2024-02", 5, 15)
    assert _months(spark, path) == [(2024, 1), (2024, 2), (2024, 3)]   # April never written


def test_requested_empty_month_is_emptied(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = _frame(spark)
    S.replace_months(spark, df, path, ["2024-01", "2024-02"])
    S.replace_months(spark, df.where("month = 1"), path, ["2024-01", "2024-02"])
    assert _months(spark, path) == [(2024, 1)]


def test_new_month_added_others_untouched(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = _frame(spark)
    S.replace_months(spark, df, path, ["2024-01"])
    S.replace_months(spark, df, path, ["2024-04"])
    assert _months(spark, path) == [(2024, 1), (2024, 4)]


def test_cluster_writes_disjoint_sorted_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(4000).selectExpr(
        "id", "2024 AS year", "1 AS month",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id * 7919) % 40000) AS ts")
    S.replace_months(spark, df.repartition(8), path, ["2024-01"], time_col="ts", num_partitions=4)
    files = sorted(glob.glob(os.path.join(local_path(path), "year=2024", "month=1", "*.parquet")))
    ranges = []
    for f in files:
        t = pq.read_table(f, columns=["ts"]).column("ts").to_pylist()
        assert t == sorted(t)
        ranges.append((min(t), max(t)))
    ranges.sort()
    assert len(ranges) >= 2
    for (a_lo, a_hi), (b_lo, b_hi) in zip(ranges, ranges[1:]):
        assert a_hi <= b_lo


def test_month_set_scan_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    S.replace_months(spark, _frame(spark), path, ["2024-01", "2024-02", "2024-03", "2024-04"])
    df = S.read_table_months(spark, path, ["2024-02", "2024-04"], ["id", "month"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan
    assert sorted({r.month for r in df.collect()}) == [2, 4]


def test_land_gathers_failures(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "raw")
    E.write_raw_sources(spark, SF, src, ("yellow",), ["2024-01"])
    with pytest.raises(RuntimeError) as e:
        B.land_months(spark, src, root, ["yellow"], ["2024-01", "2024-02", "2024-03"])
    assert "2024-02" in str(e.value) and "2024-03" in str(e.value)
    # the month that could be landed was landed; cleared months stay empty
    assert list(B.month_leaves(spark, root, "yellow", ["2024-01", "2024-02"])) == ["2024-01"]


def test_read_months_groups_by_schema(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "raw")
    E.write_raw_sources(spark, SF, src, ("yellow",), ["2024-01", "2024-02", "2024-04"], drift=True)
    B.land_months(spark, src, root, ["yellow"], ["2024-01", "2024-02", "2024-04"])
    scans = B.read_months_raw(spark, root, "yellow", ["2024-01", "2024-02", "2024-04"])
    assert len(scans) == 3                       # long vs double vs renamed column: three schemas
    df = B.read_months(spark, root, ["yellow"], ["2024-01", "2024-02", "2024-04"])
    assert dict(df.dtypes)["passenger_count"] == "bigint"
    assert df.where("airport_fee IS NOT NULL").count() == 0      # yellow airport fee is NULL here
    trips = E.trips_from_events(spark, SF)
    expected = trips.where("tipo = 'yellow' AND month(pickup_datetime) IN (1, 2, 4)").count()
    assert df.count() == expected


def test_clustered_replace_reports_exact_counts(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = _frame(spark)
    rep = S.replace_months(spark, df, path, ["2024-01", "2024-02"], time_col="ts")
    got = {r.ano_mes: (r.registros, r.stray) for r in rep.collect()}
    assert got == {"2024-01": (5, 10), "2024-02": (5, 10)}
    assert spark.read.parquet(path).count() == 10


def test_small_table_one_file_per_month(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    S.replace_months(spark, _frame(spark).repartition(6), path, ["2024-01", "2024-02"], small=True)
    for m in (1, 2):
        files = glob.glob(os.path.join(local_path(path), "year=2024", f"month={m}", "*.parquet"))
        assert len(files) == 1


def test_hot_timestamp_is_split_over_tasks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    # one timestamp carried by 90% of the rows, spread over 8 input partitions
    df = spark.range(0, 8000, numPartitions=8).selectExpr(
        "id", "2024 AS year", "1 AS month",
        "CASE WHEN id % 10 = 0 THEN timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id) "
        "ELSE timestamp_ntz'2024-01-01 00:00:00' END AS ts")
    S.replace_months(spark, df, path, ["2024-01"], time_col="ts", num_partitions=8)
    files = glob.glob(os.path.join(local_path(path), "year=2024", "month=1", "*.parquet"))
    sizes = sorted(pq.read_metadata(f).num_rows for f in files)
    assert sum(sizes) == 8000
    assert len(sizes) >= 4 and sizes[-1] < 8000 * 0.5       # the hot value is not in one file


def _versioned(spark, tmp_dir, table):
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return os.path.join(tmp_dir, table), lambda: sorted(tuple(r) for r in spark.table(table).select("id", "month").collect())


def test_a_reader_sees_the_old_month_until_the_switch(spark, tmp_dir):
    path, read = _versioned(spark, tmp_dir, "switched")
    df = _frame(spark)
    S.switch_months(spark, df, "switched", path, ["2024-01", "2024-02", "2024-03"])
    old = read()
    assert old == sorted((i, m) for m in (1, 2, 3) for i in range(5))
    new = df.withColumn("id", F.col("id") + 100).where("month <> 3")
    version, report = S.write_version(spark, new, path, ["2024-02", "2024-03"], time_col="ts")
    assert read() == old                                       # written, not committed
    assert {r.ano_mes: r.registros for r in report.collect()} == {"2024-02": 5, "2024-03": 0}
    S.commit_version(spark, "switched", version, ["2024-02", "2024-03"])
    switched = sorted([(i, 1) for i in range(5)] + [(100 + i, 2) for i in range(5)])
    assert read() == switched
    # a version written but never committed is no part of the table, nor is what was replaced
    S.write_version(spark, df, path, ["2024-01"])
    assert len(S.drop_old_versions(spark, "switched", path)) == 1 and read() == switched
    assert S.drop_old_versions(spark, "switched", path) == []
    spark.sql("DROP TABLE switched")


def test_a_month_may_be_rewritten_from_itself_and_gain_a_column(spark, tmp_dir):
    path, read = _versioned(spark, tmp_dir, "rewritten")
    S.switch_months(spark, _frame(spark), "rewritten", path, ["2024-01", "2024-02"], comments={"id": "row id"})
    doubled = spark.table("rewritten").where("month = 2").selectExpr("id * 2 AS id", "ts", "'x' AS tag", "year", "month")
    S.switch_months(spark, doubled, "rewritten", path, ["2024-02"])
    assert read() == sorted([(i, 1) for i in range(5)] + [(2 * i, 2) for i in range(5)])
    assert {(r.month, r.tag) for r in spark.table("rewritten").collect()} == {(1, None), (2, "x")}
    texts = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE rewritten").collect()}
    assert texts["id"] == "row id"
    assert set(S.current_folders(spark, "rewritten")) == {(2024, 1), (2024, 2)}
    empty, _ = _versioned(spark, tmp_dir, "never_written")
    S.switch_months(spark, _frame(spark).limit(0), "never_written", empty, ["2024-01"])
    assert not S.table_exists(spark, "never_written")
    spark.sql("DROP TABLE rewritten")


def test_files_follow_the_size_of_each_month(spark, tmp_dir):
    wide = spark.range(0, 60_000).selectExpr(
        "id", "sha2(CAST(id AS STRING), 256) AS noise", "2024 AS year", "CASE WHEN id % 6 = 0 THEN 1 ELSE 2 END AS month",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts")
    ranges = S.ranges_by_month(wide, target_file_bytes=256 << 10, fraction=0.2)
    assert ranges[2024, 2] > 2 * ranges[2024, 1] > 2
    assert S.ranges_by_month(wide.limit(0)) == {}
    path = os.path.join(tmp_dir, "sized")
    S.replace_months(spark, wide, path, ["2024-01", "2024-02"], time_col="ts", target_file_bytes=256 << 10)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{path}/*/*/*.parquet")]
    assert abs(len(sizes) - sum(ranges.values())) <= 0.3 * len(sizes) + 2
    assert max(sizes) < 2.5 * (256 << 10)


def test_row_groups_are_skipped_on_a_secondary_column(spark, tmp_dir):
    df = spark.range(0, 40_000).selectExpr(
        "id", "CAST((id * 7919) % 4 AS INT) AS VendorID", "CAST((id * 104729) % 100000 AS STRING) AS code", "2024 AS year", "1 AS month",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts")

    def groups(name, **layout):
        path = os.path.join(tmp_dir, name)
        S.replace_months(spark, df, path, ["2024-01"], time_col="ts", num_partitions=1,
                         write_options={"parquet.block.size": str(64 << 10), "parquet.page.size": "4096"}, **layout)
        metas = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*/*/*.parquet")]
        spans = []
        for meta in metas:
            at = [meta.schema.column(i).name for i in range(meta.num_columns)].index("VendorID")
            spans += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        return path, sum(s.min <= 1 <= s.max for s in spans), len(spans)

    _, hit, total = groups("by_time")
    assert hit == total > 3                                    # time order mixes vendors: nothing can be skipped
    path, hit, total = groups("by_vendor", sort_within=["VendorID"], bloom_columns=["code"])
    assert hit <= total / 2
    assert spark.read.parquet(path).where("VendorID = 1 AND code = '7'").count() == df.where("VendorID = 1 AND code = '7'").count()
    bloom = [f for f in glob.glob(f"{path}/*/*/*.parquet")]
    plain = [f for f in glob.glob(f"{tmp_dir}/by_time/*/*/*.parquet")]
    assert sum(map(os.path.getsize, bloom)) > sum(map(os.path.getsize, plain))     # the filters are in the files


def _digests(folder):
    return {os.path.basename(f): hashlib.sha256(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{folder}/*.parquet")}


def test_landing_keeps_the_bytes_and_skips_what_is_unchanged(spark, tmp_dir):
    src, raw = f"{tmp_dir}/src", f"{tmp_dir}/raw"
    months = ["2024-01", "2024-02"]
    E.write_raw_sources(spark, SF, src, ("yellow",), months)
    # one month as a single file, as a provider delivers it
    alone = B.source_path(src, "yellow", "2024-02")
    table = pq.read_table(alone)
    shutil.rmtree(alone)
    pq.write_table(table, alone)
    first = B.land_months(spark, src, raw, ["yellow"], months).collect()
    leaf = {m: B.leaf_path(raw, "yellow", m) for m in months}
    assert _digests(leaf["2024-01"]) == _digests(B.source_path(src, "yellow", "2024-01")) != {}
    assert list(_digests(leaf["2024-02"]).values()) == [hashlib.sha256(open(alone, "rb").read()).hexdigest()]
    assert {r.ano_mes: r.registros for r in first} == {m: spark.read.parquet(leaf[m]).count() for m in months}
    times = {f: os.stat(f).st_mtime_ns for m in months for f in glob.glob(f"{leaf[m]}/*.parquet")}
    # the same delivery again, then one month changed
    assert B.land_months(spark, src, raw, ["yellow"], months).collect() == first
    assert {f: os.stat(f).st_mtime_ns for f in times} == times
    pq.write_table(table.slice(0, 3), alone)
    again = {r.ano_mes: r.registros for r in B.land_months(spark, src, raw, ["yellow"], months).collect()}
    assert again["2024-02"] == 3 == spark.read.parquet(leaf["2024-02"]).count()
    assert all(os.stat(f).st_mtime_ns == t for f, t in times.items() if leaf["2024-01"] in f)
    told = {r.ano_mes: r for r in B.landed_files(spark, raw).collect() if r.ano_mes == "2024-02"}["2024-02"]
    assert (told.registros, told.bytes) == (3, os.path.getsize(alone))


def test_a_file_that_is_no_parquet_fails_its_month_only(spark, tmp_dir):
    src, raw = f"{tmp_dir}/src", f"{tmp_dir}/raw"
    E.write_raw_sources(spark, SF, src, ("yellow",), ["2024-01", "2024-02"])
    B.land_months(spark, src, raw, ["yellow"], ["2024-01", "2024-02"])
    bad = B.source_path(src, "yellow", "2024-02")
    shutil.rmtree(bad)
    with open(bad, "w") as f:
        f.write("<html>503</html>")
    with pytest.raises(RuntimeError, match="2024-02"):
        B.land_months(spark, src, raw, ["yellow"], ["2024-01", "2024-02"])
    assert set(B.month_leaves(spark, raw, "yellow", ["2024-01", "2024-02"])) == {"2024-01"}
    assert {r.ano_mes for r in B.landed_files(spark, raw).collect()} == {"2024-01"}
