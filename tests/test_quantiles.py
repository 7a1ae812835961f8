import math
import random
import struct

import pytest

from lakeops.operators import quantiles as QQ

PROBS = {"p0": 0.0, "p25": 0.25, "p30": 0.3, "p50": 0.5, "p75": 0.75, "p100": 1.0}


def _ieee_key(v: float) -> int:
    if math.isnan(v):
        return 0x7FF8000000000000
    if v == 0:
        return 0
    b = struct.unpack(">q", struct.pack(">d", abs(v)))[0]
    return b if v > 0 else -b


def test_double_key_is_the_ieee_pattern(spark):
    rng = random.Random(7)
    vals = [0.0, -0.0, 1.0, 0.5, 2.0, 3.0, 0.1, 0.3, 5e-324, 1e-310, 2.2250738585072014e-308,
            1.7976931348623157e308, -1.7976931348623157e308, float("inf"), -float("inf"),
            float("nan"), 4503599627370497.0, -123.456]
    for _ in range(2000):
        vals.append(rng.choice([1, -1]) * rng.random() * 2.0 ** rng.randint(-1074, 1023))
        vals.append(rng.randint(-10 ** 6, 10 ** 6) / 100)
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = QQ.with_key(df, "v").collect()
    assert all(r["__q_k"] == _ieee_key(r["__q_v"]) for r in got)
    # the key orders like the value (NaN last, -0.0 = 0.0)
    ordered = sorted((v for v in vals if not math.isnan(v)))
    keys = [_ieee_key(v) for v in ordered]
    assert keys == sorted(keys)


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(6000):
        g = rng.choice(["hot", "hot", "hot", "b", None])      # one group holds most rows
        v = rng.choice([None, rng.randint(-500, 5000) / 100, rng.gauss(0, 1e6), 7.0])
        iv = rng.choice([None, rng.randint(0, 9), rng.randint(-3, 3) * 10 ** 12])
        rows.append((g, v, iv))
    rows.append(("only_null", None, None))
    return spark.createDataFrame(rows, "g string, v double, iv bigint")


@pytest.mark.parametrize("column", ["v", "iv"])
@pytest.mark.parametrize("continuous", [False, True])
def test_radix_equals_spark_percentiles_by_group(frame, column, continuous):
    got = {r.g: tuple(r[1:]) for r in
           QQ.quantile_frame(frame, column, PROBS, ["g"], method="radix", continuous=continuous).collect()}
    builtin = QQ.quantile_frame(frame, column, PROBS, ["g"], method="disc", continuous=continuous)
    want = {r.g: tuple(r[1:]) for r in builtin.collect() if any(x is not None for x in r[1:])}
    assert got == want
    assert None in got                   # the NULL key is a group of its own
    assert "only_null" not in got        # a group without values has no row


@pytest.mark.parametrize("continuous", [False, True])
def test_radix_global_one_row(frame, continuous):
    got = QQ.quantile_frame(frame, "v", PROBS, method="radix", continuous=continuous).collect()
    want = QQ.quantile_frame(frame, "v", PROBS, method="disc", continuous=continuous).collect()
    assert len(got) == 1 and tuple(got[0]) == tuple(want[0])
    empty = QQ.quantile_frame(frame.where("g = 'none'"), "v", PROBS, method="radix").collect()
    assert len(empty) == 1 and all(x is None for x in empty[0])


def test_radix_keeps_discrete_type_and_hot_value(spark):
    # a value held by most rows, plus a long tail of distinct values
    df = spark.range(0, 5000).selectExpr(
        "CASE WHEN id % 3 <> 0 THEN 42L ELSE id END AS x", "CAST(id AS DOUBLE) / 7 AS y")
    got = QQ.quantile_frame(df, "x", {"m": 0.5}, method="radix").collect()[0]
    assert got.m == 42 and isinstance(got.m, int)
    exp = df.selectExpr("percentile_disc(0.9) WITHIN GROUP (ORDER BY y) AS q").collect()[0].q
    assert QQ.quantile_frame(df, "y", {"q": 0.9}, method="radix").collect()[0].q == exp


@pytest.mark.parametrize("column", ["v", "iv", "f", "d"])
@pytest.mark.parametrize("continuous", [False, True])
@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_brackets_equal_spark_percentiles(frame, column, continuous, accuracy):
    # accuracy 100: brackets from the sketch; 10 000: groups small enough to need none
    wide = frame.selectExpr("*", "CAST(v AS FLOAT) AS f", "CAST(iv AS DECIMAL(20, 2)) AS d")
    for by in ([], ["g"]):
        got = QQ.quantile_frame(wide, column, PROBS, by, continuous=continuous, accuracy=accuracy)
        builtin = QQ.quantile_frame(wide, column, PROBS, by, method="disc", continuous=continuous)
        want = [tuple(r) for r in builtin.collect() if not by or any(x is not None for x in r[1:])]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
        if not continuous:
            assert got.schema[-1].dataType == wide.schema[column].dataType


def test_brackets_with_hot_values_nan_and_infinities(spark):
    df = spark.range(0, 20_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 42D WHEN id % 50 = 1 THEN double('nan') WHEN id % 50 = 2 THEN double('infinity') "
        "WHEN id % 50 = 4 THEN double('-infinity') WHEN id % 50 = 5 THEN -0D ELSE (id * 7919) % 1000 / 7D END AS v")
    probs = {f"p{k}": k / 40 for k in range(41)}
    got = QQ.quantile_frame(df, "v", probs, accuracy=200).first()
    want = QQ.quantile_frame(df, "v", probs, method="disc").first()
    assert repr(got).replace("-0.0", "0.0") == repr(want).replace("-0.0", "0.0")


def test_the_exact_method_moves_counts_only_and_runs_nothing_early(frame, spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    q = QQ.quantile_frame(frame, "v", {"m": 0.5}, ["g"])
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert plan.count("percentile_approx") == 1 and "collect_list" not in plan
    with pytest.raises(ValueError):
        QQ.quantile_frame(frame, "v", {"m": 1.5})
    with pytest.raises(ValueError):
        QQ.quantile_frame(frame, "v", {"m": 0.5}, method="bogus")


def test_a_rank_outside_its_bracket_is_an_error(frame, monkeypatch):
    monkeypatch.setattr(QQ, "_targets", lambda probs, continuous: ["__q_n"])      # asks the median's bracket for the maximum
    with pytest.raises(Exception, match="outside its bracket"):
        QQ.quantile_frame(frame, "v", {"m": 0.5}, accuracy=100).collect()


def test_attach_groups_null_safe(spark):
    main = spark.createDataFrame([(True, 1), (False, 2), (None, 3)], "f boolean, n int")
    q = spark.createDataFrame([(True, 10.0), (None, 30.0)], "f boolean, m double")
    got = {r.f: (r.n, r.m) for r in QQ.attach_groups(main, q, ["f"]).collect()}
    assert got == {True: (1, 10.0), False: (2, None), None: (3, 30.0)}


def test_radix_many_groups_without_broadcast(spark):
    # groups of unbounded count: no broadcast hint, adaptive execution decides
    df = spark.range(0, 4000).selectExpr("id % 97 AS g", "CAST((id * 7919) % 1000 AS DOUBLE) / 10 AS v")
    got = {r.g: (r.m, r.q) for r in QQ.quantile_frame(df, "v", {"m": 0.5, "q": 0.9}, ["g"], method="radix",
                                                       bounded_groups=False).collect()}
    want = {r.g: (r.m, r.q) for r in QQ.quantile_frame(df, "v", {"m": 0.5, "q": 0.9}, ["g"],
                                                        method="disc").collect()}
    assert got == want and len(got) == 97


def test_radix_plan_aggregates_partially_before_every_shuffle(frame):
    q = QQ.quantile_frame(frame, "v", {"m": 0.5}, ["g"], method="radix")
    plan = q._jdf.queryExecution().executedPlan().toString()
    # four counting passes, each with a map-side partial aggregate
    assert plan.count("partial_count(1)") == 4
    assert "percentile" not in plan.lower() and "collect_list" not in plan
