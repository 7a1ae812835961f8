import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.operators import quality as Q

T = dt.datetime


def _pairs(spark):
    rows = [
        (1, T(2024, 1, 1, 10, 0), T(2024, 1, 1, 10, 30)),      # ordered
        (2, T(2024, 1, 1, 10, 0), T(2024, 1, 1, 10, 0)),       # equal
        (3, T(2024, 1, 1, 10, 30), T(2024, 1, 1, 10, 0)),      # inverted same day
        (4, T(2024, 1, 2, 0, 5), T(2024, 1, 1, 23, 55)),       # inverted across midnight
        (5, T(2024, 2, 1, 0, 1), T(2024, 1, 31, 23, 59)),      # inverted across month end
        (6, None, T(2024, 1, 1, 10, 0)),                       # NULL start
        (7, T(2024, 1, 1, 10, 0), None),                       # NULL end
        (8, None, None),                                       # both NULL
    ]
    return spark.createDataFrame(rows, "id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz")


def test_order_timestamps_edge_rows(spark):
    out = {r.id: r for r in Q.order_timestamps(_pairs(spark)).collect()}
    assert out[3].pickup_datetime_tratado == T(2024, 1, 1, 10, 0)
    assert out[4].data_corrida == dt.date(2024, 1, 1)              # re-derived after the swap
    assert (out[5].year, out[5].month) == (2024, 1)
    assert out[6].pickup_datetime_tratado == out[6].dropoff_datetime_tratado == T(2024, 1, 1, 10, 0)
    assert out[7].pickup_datetime_tratado == out[7].dropoff_datetime_tratado == T(2024, 1, 1, 10, 0)
    assert out[8].pickup_datetime_tratado is None and out[8].year is None
    for r in out.values():                                          # property: start <= end
        if r.pickup_datetime_tratado is not None:
            assert r.pickup_datetime_tratado <= r.dropoff_datetime_tratado


def test_timestamp_reports(spark):
    df = Q.add_date_parts(_pairs(spark), "pickup_datetime")
    labels = {r.id: r.problema_timestamp for r in Q.label_timestamp_problems(df).collect()}
    assert labels == {1: "valido", 2: "valido", 3: "dropoff_menor_que_pickup",
                      4: "dropoff_menor_que_pickup", 5: "dropoff_menor_que_pickup",
                      6: "pickup_nulo", 7: "dropoff_nulo", 8: "pickup_nulo"}
    gaps = Q.inverted_gap_buckets(df).collect()[0]
    assert (gaps.ate_1_min, gaps.de_1_a_5_min, gaps.de_5_a_60_min, gaps.acima_60_min) == (0, 1, 2, 0)
    repaired = Q.order_timestamps(df)
    assert Q.inverted_residual(repaired).collect()[0][0] == 0
    changed = Q.timestamps_changed(repaired).collect()[0]
    assert (changed.pickup_alterado, changed.dropoff_alterado) == (3, 3)


def _pc(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, passenger_count long")


def test_impute_median_of_positive_values(spark):
    out = Q.impute_median(_pc(spark, [0, None, 1, 1, 2, 6]))
    got = sorted(r.passenger_count for r in out.collect())
    assert got == [1, 1, 1, 1, 2, 6]                 # median of 1,1,2,6 is the lower middle: 1
    res = Q.impute_residual(out).collect()[0]
    assert (res.nulos_remanescentes, res.zeros_remanescentes) == (0, 0)


def test_impute_without_valid_values_leaves_rows(spark):
    out = Q.impute_median(_pc(spark, [0, None, 0]))
    assert sorted((r.passenger_count for r in out.collect()), key=lambda v: (v is None, v)) == [0, 0, None]


def test_impute_empty_frame(spark):
    assert Q.impute_median(_pc(spark, [])).count() == 0


def test_impute_before_after(spark):
    r = Q.impute_before_after(_pc(spark, [0, None, 1, 1, 2, 6])).collect()[0]
    assert r.media_antes == pytest.approx(2.0) and r.media_depois == pytest.approx(12 / 6)
    assert r.mediana_depois == 1


def _dates(spark):
    rows = [(1, dt.date(2023, 1, 1)), (2, dt.date(2023, 2, 28)), (3, dt.date(2023, 3, 1)),
            (4, dt.date(2022, 12, 31)), (5, None), (6, dt.date(2023, 2, 10))]
    return spark.createDataFrame(rows, "id int, data_corrida date")


def test_filter_period_range_and_exact(spark):
    df = _dates(spark)
    assert sorted(r.id for r in Q.filter_period(df, ["2023-01", "2023-02"]).collect()) == [1, 2, 6]
    # a month inside a gap of the list counts as inside in range mode only
    assert sorted(r.id for r in Q.filter_period(df, ["2023-01", "2023-03"]).collect()) == [1, 2, 3, 6]
    assert sorted(r.id for r in Q.filter_period(df, ["2023-01", "2023-03"], mode="exact").collect()) == [1, 3]


def test_period_counts_add_up(spark):
    df = _dates(spark)
    counts = {r.fora_do_periodo: r.total for r in Q.period_scope_counts(df, ["2023-01", "2023-02"]).collect()}
    assert counts == {False: 3, True: 2, None: 1}     # NULL date is its own group
    assert sum(counts.values()) == df.count()


def test_iqr_outliers_and_bounds(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0, -50.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, total_amount double")
    b = Q.iqr_bounds(df).collect()[0]
    assert (b.q1, b.q3) == (2.0, 7.0)
    assert b.limite_inferior == -5.5 and b.limite_superior == 14.5
    flags = {r.id: r.outlier for r in Q.flag_outliers(df).collect()}
    assert flags[8] is True and flags[9] is True and flags[0] is False and flags[10] is None


def test_value_on_bound_is_not_outlier(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 14.5, -50.0]   # q1 = 2, q3 = 7, upper = 14.5
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, total_amount double")
    flags = {r.id: r.outlier for r in Q.flag_outliers(df).collect()}
    assert flags[8] is False and flags[9] is True


def test_duration_bands(spark):
    base = T(2024, 1, 1, 10, 0)
    mins = [0, 5, 10, 20, 30, 60, 75]
    rows = [(m, base, base + dt.timedelta(minutes=m), 10.0 + m) for m in mins]
    df = spark.createDataFrame(rows, "m int, pickup_datetime_tratado timestamp_ntz, "
                                     "dropoff_datetime_tratado timestamp_ntz, total_amount double")
    timed = Q.trip_duration(df)
    assert sorted(r.m for r in timed.collect()) == [5, 10, 20, 30, 60, 75]     # duration 0 dropped
    bands = {r.faixa_duracao: r.corridas for r in Q.outliers_by_band(df).collect()}
    assert bands == {"<10 min": 1, "10-20 min": 1, "20-30 min": 1, "30-60 min": 1, ">60 min": 2}


def test_recomposition(spark):
    comps = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
             "improvement_surcharge", "congestion_surcharge", "airport_fee"]
    rows = [
        (1, -10.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, -10.0),       # adds up
        (2, -10.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, None, -10.005),    # off by < 0.01, NULL part
        (3, -10.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, -12.0),       # off by more
        (4, 5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 5.0),           # not negative: ignored
    ]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in comps) + ", total_amount double")
    df = df.withColumn("year", F.lit(2024)).withColumn("month", F.lit(1)).withColumn("pickup_datetime", F.lit(None).cast("timestamp_ntz"))
    check = {r.validacao: r["count"] for r in Q.recompose_check(df).collect()}
    assert check == {"Sem diferença": 2, "Com diferença": 1}
    mism = Q.recompose_mismatch(df).collect()
    assert len(mism) == 1 and mism[0].diferenca == -2.0


def test_negatives_by_vendor_shows_zero(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 2.0), (2, 3.0)], "VendorID int, total_amount double")
    got = {r.VendorID: r.total_negativos for r in Q.negatives_by_vendor(df).collect()}
    assert got == {1: 1, 2: 0}


def test_approx_method_close_to_exact(spark):
    df = spark.range(1, 10001).selectExpr("cast(id as double) AS total_amount")
    exact = Q.iqr_bounds(df).collect()[0]
    approx = Q.iqr_bounds(df, method="approx").collect()[0]
    assert (exact.q1, exact.q3) == (2500.0, 7500.0)
    assert abs(approx.q1 - exact.q1) <= 2 and abs(approx.q3 - exact.q3) <= 2
    with pytest.raises(ValueError):
        Q.iqr_bounds(df, method="bogus")
