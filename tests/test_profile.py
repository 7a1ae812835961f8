from lakeops.operators import profile as P
from lakeops.sources import bronze as B
from lakeops.sources import events_trips as E

SF = "/root/testdata/sf0.001"


def test_profile_missing_and_drift(spark, tmp_dir):
    src, root = f"{tmp_dir}/src", f"{tmp_dir}/raw"
    months = ["2024-01", "2024-02", "2024-03", "2024-04"]
    E.write_raw_sources(spark, SF, src, ("yellow",), months, drift=True)
    B.land_months(spark, src, root, ["yellow"], months)
    prof = P.profile_columns(spark, root, ["yellow"], months)
    rows = prof.collect()
    pc = {r.periodo: r.datatype for r in rows if r.coluna == "passenger_count"}
    assert pc == {"2024-01": "bigint", "2024-02": "double", "2024-03": "bigint", "2024-04": "bigint"}
    missing = {(r.coluna, r.presente_em, r.total_periodos) for r in P.missing_columns(prof).collect()}
    assert missing == {("congestion_surcharge", 3, 4), ("airport_fee", 3, 4), ("Airport_fee", 1, 4)}
    drift = P.type_drift(prof).collect()
    assert {r.coluna for r in drift} == {"passenger_count"} and len(drift) == 4
    nulls = {r.periodo: r.nulls for r in rows if r.coluna == "passenger_count"}
    totals = {r.periodo: r.total_registros for r in rows if r.coluna == "passenger_count"}
    assert all(0 < nulls[m] < totals[m] for m in months)
