from lakeops.sources import sinks as S


def test_register_document_and_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/tbl"
    df = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "id int, year int, month int")
    S.replace_months(spark, df, path, ["2024-01", "2024-02"])
    S.create_database(spark, "lakeops_test")
    S.register_table(spark, "lakeops_test.trips_ext", path)
    assert S.table_exists(spark, "lakeops_test.trips_ext")
    assert spark.table("lakeops_test.trips_ext").count() == 2
    S.document_table(spark, "lakeops_test.trips_ext", "trip table for tests")
    desc = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED lakeops_test.trips_ext").collect()}
    assert desc.get("Comment") == "trip table for tests"
    S.set_table_properties(spark, "lakeops_test.trips_ext", {"lakeops.metrics.tipo": "full"})
    props = {r[0]: r[1] for r in spark.sql("SHOW TBLPROPERTIES lakeops_test.trips_ext").collect()}
    assert props.get("lakeops.metrics.tipo") == "full"
    commented = S.with_column_comments(df, {"id": "row id", "year": "partition year"})
    assert commented.schema["year"].metadata["comment"] == "partition year"
    spark.sql("DROP TABLE lakeops_test.trips_ext")


def test_reprocessed_month_and_new_column_are_read_by_name(spark, tmp_dir):
    path = f"{tmp_dir}/months"
    rows = lambda *r: spark.createDataFrame(list(r), "id int, year int, month int")
    S.replace_months(spark, rows((1, 2024, 1), (2, 2024, 2)), path, ["2024-01", "2024-02"])
    S.register_table(spark, "by_name", path)
    S.replace_months(spark, rows((3, 2024, 2), (4, 2024, 3)), path, ["2024-02", "2024-03"])
    S.register_partitions(spark, "by_name", path, ["2024-02", "2024-03"])
    assert sorted(r.id for r in spark.table("by_name").collect()) == [1, 3, 4]
    wider = rows((5, 2024, 4)).selectExpr("id", "'x' AS tag", "year", "month")
    S.replace_months(spark, wider, path, ["2024-01", "2024-02", "2024-03", "2024-04"])
    S.register_table(spark, "by_name", path, comments={"tag": "a 'quoted' text"})
    assert [(r.id, r.tag) for r in spark.table("by_name").collect()] == [(5, "x")]
    spark.sql("DROP TABLE by_name")


def test_free_query_returns_every_row(spark, capsys):
    from lakeops.plans.panel import free_query, show_result
    result = free_query(spark, "SELECT id FROM range(1000)")
    assert result.count() == 1000
    show_result(result, 5)
    assert "5 of 1000 rows" in capsys.readouterr().out


def test_months_of_many_tasks_have_few_files(spark, tmp_dir):
    import glob
    path = f"{tmp_dir}/few"
    df = spark.range(0, 4000, numPartitions=16).selectExpr("id", "2024 AS year", "CAST(id % 4 + 1 AS INT) AS month")
    S.replace_months(spark, df, path, ["2024-01", "2024-02", "2024-03", "2024-04"])
    assert len(glob.glob(f"{path}/*/*/*.parquet")) <= 8
    assert len(S.read_table_months(spark, path, ["2024-03"]).inputFiles()) <= 2
    assert S.read_table_months(spark, path, ["2030-01"]).count() == 0


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from lakeops.session import ensure_checkpoint_dir

    class Cluster:
        master = "spark://somewhere:7077"
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        getCheckpointDir = staticmethod(lambda: None)
        sparkContext = property(lambda self: self)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster())
