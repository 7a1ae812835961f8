import pytest
from pyspark.sql import functions as F

from lakeops.plans import jobs as J
from lakeops.plans.silver import QUERY_MONTHS, stages_from_events
from lakeops.sources import events_trips as E
from lakeops.sources import sinks as S

SF = "/root/testdata/sf0.001"


def _rows(df, digits=6):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, digits) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def test_land_silver_gold_end_to_end(spark, tmp_dir):
    src, raw = f"{tmp_dir}/src", f"{tmp_dir}/raw"
    E.write_raw_sources(spark, SF, src, ("yellow", "green"), E.EVENT_MONTHS)
    land = J.land_job(spark, src, raw, E.EVENT_MONTHS, f"{tmp_dir}/reports/land")
    assert land["landed"].count() == 10
    assert land["type_drift"].count() == 0

    silver = J.silver_job(spark, raw, f"{tmp_dir}/silver", QUERY_MONTHS, f"{tmp_dir}/reports/silver")
    written = {r.ano_mes: r.registros for r in silver["written"].collect()}
    st = stages_from_events(spark, SF)
    expected = {f"{r.year:04d}-{r.month:02d}": r["count"]
                for r in st.scoped.groupBy("year", "month").count().collect()}
    assert written == expected
    assert silver["timestamp_checks"].collect()[0].ainda_invertidos == 0
    # reports read from the written typed table equal the operators on the lazy stages
    from functools import reduce
    from lakeops.operators import audit as A, bundle as BU, quality as Q
    from lakeops.plans.silver import build_stages
    from lakeops.sources import bronze as B
    raw_frames = {s: reduce(lambda a, b: a.unionByName(b), B.read_months_raw(spark, raw, s, QUERY_MONTHS))
                  for s in ("yellow", "green")}
    st = build_stages(raw_frames, QUERY_MONTHS)       # same batch as the job (the median depends on it)
    same = {"rows_by_source": A.rows_by_source(st.typed), "passenger_rates": BU.rate_bundle(st.typed),
            "volume_by_vendor": A.volume_by(st.typed), "timestamp_checks": BU.timestamp_bundle(st.repaired),
            "period_scope": Q.period_scope_counts(st.repaired, QUERY_MONTHS),
            "out_of_period": Q.out_of_period_detail(st.repaired, QUERY_MONTHS),
            "negatives": Q.negatives_summary(st.scoped), "negatives_by_vendor": Q.negatives_by_vendor(st.scoped),
            "negatives_by_date": Q.negatives_by(st.scoped, ["data_corrida"]), "recompose_check": Q.recompose_check(st.scoped),
            "iqr_bounds": Q.iqr_bounds(st.scoped), "outliers_by_band": Q.outliers_by_band(st.scoped),
            "amount_summary": Q.numeric_summary(st.scoped), "iqr_outliers": Q.iqr_outlier_counts(st.scoped),
            "recompose_mismatch": Q.recompose_mismatch(st.scoped),
            "timestamp_problems": Q.timestamp_problems(st.imputed)}
    for name, df in same.items():
        assert _rows(silver[name].select(*df.columns)) == _rows(df), name

    gold = J.gold_job(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold_trips", f"{tmp_dir}/gold_metrics",
                      QUERY_MONTHS, f"{tmp_dir}/reports/gold")
    metrics = spark.read.parquet(f"{tmp_dir}/gold_metrics")
    cols = ["tipo", "year", "month", "hora_do_dia", "qtd_corridas", "soma_total_amount", "soma_passenger_count"]
    assert _rows(metrics.select(*cols)) == _rows(st.metrics.select(*cols))
    trips = spark.read.parquet(f"{tmp_dir}/gold_trips")
    assert _rows(trips.select(*st.serving.columns)) == _rows(st.serving)
    assert gold["coverage"].collect()[0].total_corridas == st.serving.count()


def test_gold_reprocess_one_month_is_idempotent(spark, tmp_dir):
    st = stages_from_events(spark, SF)
    from lakeops.sources import sinks as S
    S.replace_months(spark, st.scoped, f"{tmp_dir}/silver", QUERY_MONTHS, time_col="pickup_datetime_tratado")
    args = (f"{tmp_dir}/silver", f"{tmp_dir}/gt", f"{tmp_dir}/gm")
    J.gold_job(spark, *args, QUERY_MONTHS, f"{tmp_dir}/r1")
    first = _rows(spark.read.parquet(f"{tmp_dir}/gm"))
    J.gold_job(spark, *args, ["2024-02"], f"{tmp_dir}/r2")
    assert _rows(spark.read.parquet(f"{tmp_dir}/gm")) == first
    assert spark.read.parquet(f"{tmp_dir}/gm").where(F.col("month") == 2).count() > 0


def test_silver_job_survives_text_in_a_number_column(spark, tmp_dir):
    src, raw = f"{tmp_dir}/src", f"{tmp_dir}/raw"
    months = ["2024-01", "2024-02"]
    E.write_raw_sources(spark, SF, src, ("yellow", "green"), months, drift=True)
    from lakeops.sources.bronze import source_path
    trips = E.trips_from_events(spark, SF)
    changed = E.raw_month_frame(trips, "green", "2024-02").withColumn(
        "passenger_count", F.expr("CASE WHEN PULocationID % 2 = 0 THEN 'abc' ELSE CAST(passenger_count AS STRING) END"))
    changed.write.mode("overwrite").parquet(source_path(src, "green", "2024-02"))
    lost = changed.where("passenger_count = 'abc'").count()
    J.land_job(spark, src, raw, months, f"{tmp_dir}/reports/land")
    out = J.silver_job(spark, raw, f"{tmp_dir}/silver", months, f"{tmp_dir}/reports/silver", database="jobs_test")
    loss = {r.coluna: r.perdidos for r in out["cast_loss"].collect()}
    assert lost > 0 and loss["passenger_count"] == lost
    table = spark.table("jobs_test.silver")
    assert table.count() == spark.read.parquet(f"{tmp_dir}/silver").count() > 0
    texts = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE jobs_test.silver").collect()}
    assert texts["total_amount"] and texts["tipo"]
    spark.sql("DROP DATABASE jobs_test CASCADE")


def test_land_job_publishes_the_raw_zone_and_moves_redelivered_months(spark, tmp_dir):
    src, raw = f"{tmp_dir}/src", f"{tmp_dir}/raw"
    months = ["2024-01", "2024-02"]
    spark.sql("DROP DATABASE IF EXISTS raw_test CASCADE")
    E.write_raw_sources(spark, SF, src, ("yellow", "green"), months)
    J.land_job(spark, src, raw, months, f"{tmp_dir}/reports", database="raw_test")
    typed = stages_from_events(spark, SF).typed.drop("data_corrida").where("year = 2024 AND month <= 2")
    rows = lambda df: _rows(df.select(*typed.columns))
    assert rows(spark.table("raw_test.raw_trips")) == _rows(typed)
    assert spark.sql("SHOW TABLES IN raw_test LIKE 'raw_yellow_*'").count() == 1
    # February again, in other types: it moves to a table of its own; January stays registered though not named
    E.write_raw_sources(spark, SF, src, ("yellow",), ["2024-02"], drift=True)
    J.land_job(spark, src, raw, ["2024-02"], f"{tmp_dir}/reports", database="raw_test")
    assert spark.sql("SHOW TABLES IN raw_test LIKE 'raw_yellow_*'").count() == 2
    assert rows(spark.table("raw_test.raw_trips")) == _rows(typed)
    spark.sql("DROP DATABASE raw_test CASCADE")


def test_silver_job_replaces_atomically_and_gold_reads_by_name(spark, tmp_dir):
    src, raw = f"{tmp_dir}/src", f"{tmp_dir}/raw"
    months = ["2024-01", "2024-02"]
    spark.sql("DROP DATABASE IF EXISTS atomic_test CASCADE")
    E.write_raw_sources(spark, SF, src, ("yellow", "green"), months)
    J.land_job(spark, src, raw, months, f"{tmp_dir}/reports/land")
    with pytest.raises(ValueError):
        J.silver_job(spark, raw, f"{tmp_dir}/silver", months, f"{tmp_dir}/r", atomic=True)
    for _ in range(2):                  # the second run switches the months of the first
        J.silver_job(spark, raw, f"{tmp_dir}/silver", months, f"{tmp_dir}/reports/silver", database="atomic_test", atomic=True)
    assert len(S.drop_old_versions(spark, "atomic_test.silver", f"{tmp_dir}/silver")) == 1
    gold = J.gold_job(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gt", f"{tmp_dir}/gm", months, f"{tmp_dir}/reports/gold",
                      silver_table="atomic_test.silver")
    assert gold["coverage"].first().total_corridas == spark.table("atomic_test.silver").count() > 0
    spark.sql("DROP DATABASE atomic_test CASCADE")


def test_reports_are_printed_largest_first(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "nome string, count long")
    assert [r.nome for r in J.in_reading_order("passenger_distribution", counts).collect()] == ["b", "c", "a"]
    assert [r.nome for r in J.in_reading_order("period_scope", counts).collect()] == ["a", "b", "c"]
