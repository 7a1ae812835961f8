import json
import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lakeops.operators import audit as A
from lakeops.operators import bundle as BU
from lakeops.operators import quality as Q
from lakeops.plans.silver import stages_from_events

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rows_by_source_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "tipo string")
    got = {r.fonte: r.registros for r in A.rows_by_source(df).collect()}
    assert got == {"a": 2, "b": 1, "total": 3}


def test_exact_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "y")], "a int, b string")
    r = A.exact_duplicates(df).collect()[0]
    assert (r.registros, r.registros_distintos, r.duplicados) == (4, 3, 1)


@pytest.mark.parametrize("limit", [4_000_000, 0])
def test_duplicates_by_broadcast_pairs_and_by_bit_map(spark, monkeypatch, limit):
    # the bit map takes over where the repeated pairs are too many to broadcast: same result
    monkeypatch.setattr(A, "BROADCAST_PAIRS", limit)
    df = spark.range(0, 3000).selectExpr("CASE WHEN id % 7 = 0 THEN id % 100 ELSE id END AS a", "CAST(NULL AS STRING) AS b")
    rows = [tuple(r) for r in df.collect()]
    r = A.exact_duplicates(df).first()
    assert (r.registros, r.registros_distintos) == (3000, len(set(rows)))
    want = {k: n for k, n in Counter(rows).items() if n > 1}
    assert {(r.a, r.b): r["count"] for r in A.key_duplicates(df, ["a", "b"]).collect()} == want
    empty = A.exact_duplicates(df.limit(0)).first()
    assert tuple(empty) == (0, 0, 0) and A.key_duplicates(df.limit(0), ["a"]).count() == 0


def test_unique_rows_never_cross_an_exchange_in_full(tmp_dir):
    # lineitem has no equal rows: by the event log, only pairs of hashes are shuffled
    script = f"""
from lakeops.session import build_session
from lakeops.operators import audit as A
spark = build_session("local[2]", shuffle_partitions=4, extra={{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file:{tmp_dir}", "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": "{tmp_dir}/scratch",
    "spark.sql.autoBroadcastJoinThreshold": "1m"}})
df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
print(A.exact_duplicates(df).first().duplicados)
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300,
                          cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert done.stdout.split()[-1:] == ["0"], done.stderr[-2000:]
    log = next(f"{tmp_dir}/{f}" for f in os.listdir(tmp_dir) if f.startswith(("local-", "app-")))
    written = Counter()
    with open(log) as events:
        for event in map(json.loads, events):
            if event["Event"] == "SparkListenerTaskEnd":
                write = event["Task Metrics"]["Shuffle Write Metrics"]
                written[event["Stage ID"]] += write["Shuffle Records Written"]
    rows = duckdb.sql("select count(*) from '/root/testdata/sf0.01/lineitem.parquet'").fetchall()[0][0]
    busy = sorted(n for n in written.values() if n > 100)
    assert busy == [rows]                 # one shuffle of one row each: the hashes


def test_key_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert [tuple(r) for r in A.key_duplicates(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_rates_keep_null_groups(spark):
    df = spark.createDataFrame([(1, None), (1, 0), (1, 2), (None, None)], "v int, passenger_count long")
    got = {r.v: (r.total, r.passenger_count_nulo, r.pct_passenger_count_nulo)
           for r in A.null_rate_by(df, "v").collect()}
    assert got == {1: (3, 1, 33.33), None: (1, 1, 100.0)}
    zeros = {r.v: r.passenger_count_zero for r in A.zero_rate_by(df, "v").collect()}
    assert zeros == {1: 1, None: None}        # sum over a group with only NULL comparisons


def test_stats_by_flag_three_valued(spark):
    df = spark.createDataFrame([(0, 10.0), (1, 20.0), (None, 30.0), (2, 40.0)],
                               "passenger_count long, total_amount double")
    got = {r.passenger_count_zero: (r.total, r.total_amount_medio)
           for r in A.amount_by_zero_flag(df).collect()}
    assert got == {True: (1, 10.0), False: (2, 30.0), None: (1, 30.0)}


def test_rate_bundle_equals_unfused(spark):
    typed = stages_from_events(spark, SF).typed
    fused = BU.rate_bundle(typed)
    green = F.col("tipo") == "green"
    for dim, where in (("VendorID", None), ("trip_type", green), ("store_and_fwd_flag", None)):
        nulls = A.null_rate_by(typed, dim, where=where)
        zeros = A.zero_rate_by(typed, dim, where=where)
        unfused = (nulls.join(zeros.drop("total"), dim, "left")
                   .select(F.col(dim).cast("string").alias("valor"), "total", "passenger_count_nulo",
                           "pct_passenger_count_nulo", "passenger_count_zero", "pct_passenger_count_zero"))
        mine = (fused.where(F.col("dimensao") == dim)
                .select("valor", "total", "passenger_count_nulo", "pct_passenger_count_nulo",
                        "passenger_count_zero", "pct_passenger_count_zero"))
        key = lambda t: tuple((v is None, str(v)) for v in t)
        assert sorted(map(tuple, mine.collect()), key=key) == sorted(map(tuple, unfused.collect()), key=key)


def test_timestamp_bundle_equals_unfused(spark):
    st = stages_from_events(spark, SF)
    fused = BU.timestamp_bundle(st.repaired).collect()[0].asDict()
    fill = Q.inverted_flag_fill(st.imputed).collect()[0].asDict()
    gaps = Q.inverted_gap_buckets(st.imputed).collect()[0].asDict()
    resid = Q.inverted_residual(st.repaired).collect()[0].asDict()
    changed = Q.timestamps_changed(st.repaired).collect()[0].asDict()
    for part in (fill, gaps, resid, changed):
        for k, v in part.items():
            assert fused[k] == v, k
