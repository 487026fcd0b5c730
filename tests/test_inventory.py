"""Size reports on the literal TABLE_INFO rows, and the catalog walk over a temporary warehouse."""

from tidemark.operators import inventory as inv

TABLE_INFO = [("c1.s1.t1", 4200000000), ("c1.s1.t2", 1000000), ("c1.s2.t3", 0), ("c2.s1.t4", 17500000000)]


def test_reports_in_gb(spark):
    info = spark.createDataFrame(TABLE_INFO, "name string, sizeinbytes bigint")
    by_schema = [tuple(r) for r in inv.inventory_by_schema(info).collect()]
    assert by_schema == [("c2", "s1", 17.5), ("c1", "s1", 4.2)]          # rounded before summing; empty schema gone
    by_table = [tuple(r) for r in inv.inventory_by_table(info).collect()]
    assert by_table == [("c2", "s1", "t4", 17500000000, 17.5), ("c1", "s1", "t1", 4200000000, 4.2),
                        ("c1", "s1", "t2", 1000000, 0.0)]


def test_table_sizes_reads_the_data(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "a int, b string")
    row = inv.table_sizes({"x.y.z": df}).first()
    assert (row.name, row.sizeinbytes) == ("x.y.z", 2 * 4 + 2)


def test_catalog_walk_is_one_plan_and_changes_nothing(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS inv_demo")
    spark.range(1000).write.mode("overwrite").saveAsTable("inv_demo.numbers")
    spark.range(50).selectExpr("id", "id % 5 AS part").write.mode("overwrite").partitionBy("part").saveAsTable("inv_demo.parted")
    spark.sql("CREATE OR REPLACE VIEW inv_demo.shown AS SELECT * FROM inv_demo.numbers")
    spark.range(5).createOrReplaceTempView("not_a_table")

    def described():
        return [tuple(r) for r in spark.sql("DESCRIBE TABLE EXTENDED inv_demo.numbers").collect()]

    before = described()
    sizes, errors = inv.catalog_sizes(spark)
    names = {r.name: r.sizeinbytes for r in sizes.collect()}
    assert names["spark_catalog.inv_demo.numbers"] > 0 and names["spark_catalog.inv_demo.parted"] > 0
    assert "spark_catalog.inv_demo.shown" not in names
    assert errors.count() == 0
    assert described() == before                                    # no statistics were written
    plan = sizes._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan binaryFile") == 1 and "content" not in plan


def test_catalog_walk_captures_schema_errors(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS inv_broken")
    real = spark.sql

    def failing(statement, *a, **k):
        if "inv_broken" in statement:
            return real("SHOW TABLES IN no_such_schema_xyz")   # a real JVM-side error
        return real(statement, *a, **k)

    monkeypatch.setattr(spark, "sql", failing)
    sizes, errors = inv.catalog_sizes(spark)
    rows = errors.collect()
    assert [r.schema_name for r in rows] == ["spark_catalog.inv_broken"]
    assert rows[0].error_class == "SCHEMA_NOT_FOUND" and rows[0].sqlstate == "42704"


def test_sizes_of_folders_within_folders_and_of_empty_ones(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "outer" / "part=1"))
    (tmp_path / "empty").mkdir()
    paths = {"a.b.outer": str(tmp_path / "outer"), "a.b.inner": str(tmp_path / "outer" / "part=1"), "a.b.empty": str(tmp_path / "empty")}
    sizes = {r.name: r.sizeinbytes for r in inv.stored_sizes(spark, paths).collect()}
    assert sizes["a.b.empty"] == 0 and sizes["a.b.inner"] > 0
    assert inv.stored_sizes(spark, {}).count() == 0


def test_stored_sizes_list_files_only(spark, tmp_path):
    import pathlib

    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "t"))
    sizes = inv.stored_sizes(spark, {"a.b.t": str(tmp_path / "t")})
    files = [f for f in pathlib.Path(tmp_path / "t").iterdir() if not f.name.startswith((".", "_"))]
    row = sizes.first()
    assert (row.name, row.sizeinbytes) == ("a.b.t", sum(f.stat().st_size for f in files))


def test_sizes_of_nested_and_decimal_values(spark):
    df = spark.sql("SELECT CAST(1 AS DECIMAL(30,2)) AS d, array('ab', 'c') AS a, named_struct('x', 1) AS s")
    assert inv.table_sizes({"x.y.z": df}).first().sizeinbytes == 16 + len('{"v":["ab","c"]}') + len('{"v":{"x":1}}')
