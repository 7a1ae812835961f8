import pytest
from pyspark.sql import functions as F

from lakeops.operators import metrics as M
from lakeops.plans.silver import stages_from_events

SF = "/root/testdata/sf0.001"


def test_recombined_mean_equals_direct_mean(spark):
    st = stages_from_events(spark, SF)
    for r in M.mean_of_sums_check(st.metrics, st.serving, None).collect():
        assert r.diferenca == pytest.approx(0.0, abs=1e-9)


def test_metrics_are_additive(spark):
    st = stages_from_events(spark, SF)
    total = st.metrics.agg(F.sum("qtd_corridas")).collect()[0][0]
    assert total == st.serving.count()
    by_month = {(r.year, r.month): r.n for r in
                st.metrics.groupBy("year", "month").agg(F.sum("qtd_corridas").alias("n")).collect()}
    direct = {(r.year, r.month): r["count"] for r in st.serving.groupBy("year", "month").count().collect()}
    assert by_month == direct


def test_latest_month_question(spark):
    rows = [("yellow", 2024, 1, 0, 2, 10.0, 2), ("yellow", 2024, 2, 0, 4, 10.0, 8),
            ("green", 2024, 2, 1, 1, 5.0, 3)]
    m = spark.createDataFrame(rows, "tipo string, year int, month int, hora_do_dia int, qtd_corridas long, "
                                    "soma_total_amount double, soma_passenger_count long")
    got = {r.hora_do_dia: r.media_passenger_count for r in M.mean_passengers_by_hour_latest(m).collect()}
    assert got == {0: 2.0, 1: 3.0}
    cov = M.metrics_coverage(m).collect()[0]
    assert (cov.de, cov.ate, cov.total_corridas, cov.meses) == (202401, 202402, 7, 2)
    allm = {(r.year, r.month): r.media_total_amount for r in M.mean_amount_by_month(m, None).collect()}
    assert allm == {(2024, 1): 5.0, (2024, 2): 3.0}


def test_serving_projection(spark):
    st = stages_from_events(spark, SF)
    assert st.serving.columns == ["VendorID", "tipo", "year", "month", "total_amount",
                                  "passenger_count", "pickup_datetime", "dropoff_datetime"]


def test_panel_views_and_free_query(spark, tmp_dir):
    from lakeops.plans.panel import free_query, register_views
    from lakeops.sources import sinks as S
    st = stages_from_events(spark, SF)
    S.replace_months(spark, st.serving, f"{tmp_dir}/t", ["2024-01", "2024-02", "2024-03", "2024-04"])
    S.replace_months(spark, st.metrics, f"{tmp_dir}/m", ["2024-01", "2024-02", "2024-03", "2024-04"])
    register_views(spark, f"{tmp_dir}/t", f"{tmp_dir}/m")
    by_hour = free_query(spark, "SELECT tipo, year, month, hora_do_dia, soma_total_amount FROM trip_metrics")
    assert by_hour.count() == st.metrics.count()
    assert free_query(spark, "SELECT count(*) AS n FROM trips").first().n == st.serving.count()
    plan = spark.sql("SELECT count(*) FROM trips WHERE year = 2024 AND month = 2")._jdf \
        .queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
