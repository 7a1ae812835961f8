import pytest

from lakeops.functions.schema import conform
from lakeops.operators.audit import cast_loss
from lakeops.sources.services import SERVICE_A, SERVICE_B, standardize


def test_conform_projects_in_schema_order_and_types(spark):
    trips = spark.sql("SELECT '7' AS seats, DATE'2024-05-01' AS day, 12.75 AS fare, 'n/a' AS note")
    out = conform(trips, {"fare": "double", "note": "int", "seats": "bigint"})
    assert out.dtypes == [("fare", "double"), ("note", "int"), ("seats", "bigint")]
    assert out.first().asDict() == {"fare": 12.75, "note": None, "seats": 7}


def test_conform_names_every_absent_column(spark):
    with pytest.raises(ValueError) as error:
        conform(spark.range(1), {"id": "int", "fare": "double", "tip": "double"})
    assert "fare" in str(error.value) and "tip" in str(error.value)


def test_conform_to_nothing_keeps_the_rows(spark):
    assert conform(spark.range(4), {}).count() == 4


def test_cast_loss_adds_up_frames_in_their_own_types(spark):
    number = spark.sql("SELECT 5L AS seats, 1.5D AS fare")
    text = spark.sql("SELECT * FROM VALUES ('x', '2'), ('3', NULL), (NULL, 'y') AS t(seats, fare)")
    lacking = spark.sql("SELECT 'q' AS other, '9' AS seats")
    rows = {r.coluna: (r.antes, r.depois, r.perdidos) for r in cast_loss([number, text, lacking], {"seats": "int", "fare": "double"}).collect()}
    assert rows == {"seats": (4, 3, 1), "fare": (3, 2, 1)}


def test_cast_loss_counts_lost_values(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None), ("abc", "3")], "a string, b string")
    rows = {r.coluna: r for r in cast_loss(df, {"a": "int", "b": "int"}).collect()}
    assert (rows["a"].antes, rows["a"].depois, rows["a"].perdidos) == (3, 2, 1)
    assert (rows["b"].antes, rows["b"].depois, rows["b"].perdidos) == (2, 1, 1)
    assert rows["a"].pct_perdido == pytest.approx(33.3333)


def test_service_a_adapter_handles_spelling_and_constants(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 3, 4, 1.25)],
        "VendorID long, passenger_count double, RatecodeID long, payment_type long, Airport_fee double")
    df = df.selectExpr("*", "timestamp_ntz'2024-01-01 10:00:00' AS tpep_pickup_datetime",
                       "timestamp_ntz'2024-01-01 10:10:00' AS tpep_dropoff_datetime")
    out = standardize(df, SERVICE_A)
    row = out.collect()[0].asDict()
    assert row["airport_fee"] == 1.25 and row["ehail_fee"] == 0.0 and row["trip_type"] == 0
    assert row["tipo"] == "yellow" and row["passenger_count"] == 2
    assert "pickup_datetime" in out.columns and "tpep_pickup_datetime" not in out.columns
    assert dict(out.dtypes)["VendorID"] == "int"


def test_service_b_adapter(spark):
    df = spark.createDataFrame([(2, 1.0, 2.0)], "VendorID long, passenger_count double, trip_type double")
    df = df.selectExpr("*", "1L AS RatecodeID", "1L AS payment_type",
                       "timestamp_ntz'2024-01-01 10:00:00' AS lpep_pickup_datetime")
    row = standardize(df, SERVICE_B).collect()[0].asDict()
    assert row["airport_fee"] == 0.0 and row["tipo"] == "green" and row["trip_type"] == 2
    assert "pickup_datetime" in row


def test_adapter_without_cast_keeps_raw_types(spark):
    df = spark.createDataFrame([(1, 2.5)], "VendorID long, passenger_count double")
    out = standardize(df, SERVICE_B, cast=False)
    assert dict(out.dtypes)["passenger_count"] == "double"


def test_integral_fast_path_matches_try_cast(spark):
    from pyspark.sql import functions as F
    from lakeops.functions.schema import try_cast_column
    vals = [" 12 ", "+3", "-4", "1.5", "1.0", "", "\t7\n", "1e3", "abc", "12a", "9999999999",
            "0x10", ".5", "5.", "+", "--1", "1 2", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for t in ("int", "bigint", "smallint", "tinyint"):
        rows = df.select(F.col("s").try_cast(t).alias("a"), try_cast_column(df, "s", t).alias("b")).collect()
        assert all(r.a == r.b for r in rows), t
