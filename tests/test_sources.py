"""Sinks and DDL on a temporary warehouse; JDBC options (no database is started)."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark.plans import status_history
from tidemark.plans.status_history import HistorySources, StatusHistoryJob
from tidemark.queries import FIXTURE_DATES
from tidemark.sources.fixtures import Fixtures
from tidemark.sources.tables import (
    jdbc_options, read_jdbc, split_points, split_predicates, sql_literal, stage_measured, stage_table, truncate, write_stage)


def test_append_overwrite_truncate_drop(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stg")
    spark.catalog.setCurrentDatabase("stg")
    try:
        df = spark.range(3).selectExpr("id", "'a' AS v")
        write_stage(df, "stg.stage_t", mode="overwrite")
        write_stage(df, "stg.stage_t", mode="append")
        assert spark.table("stage_t").count() == 6
        write_stage(df, "stg.stage_t", mode="overwrite")
        assert spark.table("stage_t").count() == 3
        truncate(spark, "stg.stage_t")
        assert spark.table("stage_t").count() == 0
        spark.sql("CREATE TABLE IF NOT EXISTS stg.cities (city_name STRING, country_name STRING) USING parquet")
        spark.sql("INSERT INTO stg.cities VALUES ('New York','US'),('Madras',null)")
        assert spark.table("stg.cities").count() == 2
        spark.sql("DROP TABLE IF EXISTS stg.cities")
        assert not spark.catalog.tableExists("stg.cities")
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_stage_table_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS y")
    staged = stage_table(df, "test/stage")
    assert staged.count() == 10
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan      # reads the written files, not the original lineage


def test_jdbc_options():
    opts = jdbc_options("jdbc:x://h/db", "(select 1) t", user="u", password="p", driver="D",
                        partition_column="id", bounds=(1, 1000), num_partitions=10)
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "10" and opts["upperBound"] == "1000"
    plain = jdbc_options("jdbc:x://h/db", "t")
    assert "numPartitions" not in plain          # numPartitions alone would still be one task
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", "t", partition_column="id")


def test_read_table_by_name_and_path(spark, tmp_path):
    from tidemark.sources.tables import read_table
    spark.range(4).write.mode("overwrite").saveAsTable("default.scan_t")
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert read_table(spark, "default.scan_t").count() == 4
    assert read_table(spark, str(tmp_path / "p")).count() == 3


def test_stage_measured_observes_the_size(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "a int, b string")
    staged, size = stage_measured(df, "test/measured")
    assert size == 10 and staged.count() == 2
    assert stage_measured(df.where("a > 5"), "test/measured-empty")[1] == 0


COLUMNS = {
    "day": [dt.date(2020, 1, 1) + dt.timedelta(k % 90) for k in range(400)] + [None] * 5,
    "at": [dt.datetime(2020, 1, 1, 12) + dt.timedelta(seconds=k) for k in range(300)] + [None],
    "name": ["O'Neil", "", "zz", None, "é"] * 40 + [f"n{k}" for k in range(100)],
    "hot": ["same"] * 300 + ["a", "z", None],
    "n": [None, *range(-100, 100)],
    "nothing": [None] * 7,
}
TYPES = {"day": "date", "at": "timestamp_ntz", "name": "string", "hot": "string", "n": "long", "nothing": "string"}


@pytest.mark.parametrize("column", COLUMNS)
def test_split_predicates_hold_every_row_once(spark, column):
    values = COLUMNS[column]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"id int, {column} {TYPES[column]}")
    predicates = split_predicates(column, split_points(df, column, 5))
    parts = [[r.id for r in df.where(p).collect()] for p in predicates]
    assert sorted(x for part in parts for x in part) == list(range(len(values)))
    if column in ("day", "at", "n"):
        assert len(predicates) == 5 and max(map(len, parts)) < len(values) / 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab'Z ", max_size=3)), max_size=20),
       st.lists(st.text(alphabet="ab'Z ", max_size=3), unique=True, max_size=4))
def test_split_predicates_are_disjoint_and_complete(values, points):
    import duckdb

    points = sorted(points)
    con = duckdb.connect()
    for v in values:
        literal = "NULL" if v is None else sql_literal(v)
        held = [con.execute(f"SELECT coalesce({p}, false) FROM (SELECT CAST({literal} AS VARCHAR) AS x)").fetchone()[0]
                for p in split_predicates("x", points)]
        assert sum(held) == 1


def test_points_need_a_column(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x://h/db", "t", points=[1, 2])


def _above(plan: str, scan: str) -> list[str]:
    """The operators between the scan of a table and the join above it."""
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if scan in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789")), []
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if d < depth:
            depth = d
            found.append(line.lstrip(" :+-*()0123456789"))
            if "Join" in line:
                return found
    return found


def test_sources_stored_by_key_are_not_shuffled(spark, monkeypatch):
    """Beyond the broadcast bound only the change frames move."""
    plain = HistorySources.from_fixtures(Fixtures(spark, SF001))
    stored = plain.stored_by_key("by_key", 6)
    monkeypatch.setattr(status_history, "MAX_BROADCAST_BYTES", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        job, same = StatusHistoryJob(stored, FIXTURE_DATES, materialize=None), StatusHistoryJob(plain, FIXTURE_DATES)

        def plan(df):
            return df._jdf.queryExecution().executedPlan().toString()

        for frame, table in ((job.plan_items, "dim_by_plan"), (job.reopened, "target"), (job.enriched, "dim"),
                             (job.bill_docs, "bill_item"), (job.scd_starts, "scd"), (job.scd_starts, "dim")):
            text = plan(frame)
            over = _above(text, f"spark_catalog.default.by_key_{table}[")
            assert any("Join" in x for x in over) and not any("Exchange" in x for x in over), (table, text)
        for name in ("plan_items", "bill_docs", "delta_versions"):
            got, expected = getattr(job, name), getattr(same, name)
            assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_stage_is_one_file_per_bucket(spark):
    write_stage(spark.range(1000).withColumn("v", F.col("id") % 7), "bucketed_t", keys=["id"], buckets=4)
    files = spark.table("bucketed_t").select(F.input_file_name().alias("f")).distinct().count()
    assert files == 4 and spark.table("bucketed_t").count() == 1000


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _copy_of_sf001(tmp_path) -> str:
    import shutil

    folder = tmp_path / "sf"
    shutil.copytree(SF001, folder, copy_function=shutil.copyfile)
    return str(folder)


def test_a_query_stages_only_the_views_it_reads(spark, tmp_path):
    from tidemark.sources import fixtures

    folder = _copy_of_sf001(tmp_path)
    src = HistorySources.from_fixtures(Fixtures(spark, folder))
    job = StatusHistoryJob(src, FIXTURE_DATES)
    staged = lambda: {key[-1] for key in fixtures._STAGED if key[1] == folder}
    assert staged() == set()
    job.plan_ranges.count()
    assert staged() == {"lineitem by l_orderkey", "plans", "dim"}


def test_views_stored_by_item_meet_without_a_shuffle(spark):
    from pyspark.sql import Window

    from tidemark.operators.common import ITEM_KEYS

    fx = Fixtures(spark, SF001)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Window.partitionBy(*ITEM_KEYS).orderBy("start_date")
        assert "Exchange" not in _plan(fx.hist.withColumn("n", F.lag("end_date").over(w)))
        assert "Exchange" not in _plan(fx.hist.join(fx.dim, ITEM_KEYS))
        points = fx.dim.limit(100).select(*ITEM_KEYS).repartition(fx.buckets, *ITEM_KEYS)
        plan = _plan(fx.hist.join(points, ITEM_KEYS))
        assert "ENSURE_REQUIREMENTS" not in plan.split("REPARTITION_BY_NUM")[0]     # the history stays in place
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [t.name for t in spark.catalog.listTables("default") if t.name.startswith("tidemark_stage_")]


@pytest.mark.parametrize("moved", [True, False])
def test_stage_by_key_keeps_every_row(spark, moved):
    from tidemark.sources.tables import stage_by_key

    df = spark.range(50).selectExpr("if(id % 7 = 0, null, id % 5) AS k", "id")
    staged = stage_by_key(df, f"test/by-key-{moved}", ["k"], 8, moved=moved)
    assert sorted(map(str, staged.collect())) == sorted(map(str, df.collect()))
    counts = {r.k: r["count"] for r in staged.groupBy("k").count().collect()}
    assert counts == {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    assert staged.where("k = 3").count() == df.where("k = 3").count()


def test_order_lines_go_once_all_views_over_them_are_stored(spark, tmp_path):
    from tidemark.sources import fixtures

    folder = _copy_of_sf001(tmp_path)
    fx = Fixtures(spark, folder)
    held = lambda: {key[-1] for key in fixtures._STAGED if key[1] == folder}
    lines = "lineitem by l_orderkey"
    for view in fixtures.OF_LINES[:-1]:
        fx.table(view)
    assert lines in held()
    last = fx.table(fixtures.OF_LINES[-1]).count()
    assert held() == set(fixtures.OF_LINES)
    pure = Fixtures(spark, folder, stage=False)
    assert last == pure.table(fixtures.OF_LINES[-1]).count() and fx.plans.count() == pure.plans.count()


def test_stage_by_key_gives_back_the_shuffle_files(spark, monkeypatch):
    import time

    from tests.conftest import shuffle_files
    from tidemark import session
    from tidemark.sources.tables import stage_by_key

    monkeypatch.setattr(session, "FREE_EVERY_S", 0)
    before = shuffle_files(spark)
    stage_by_key(spark.range(1000).withColumn("v", F.col("id") % 7), "test/freed", ["id"], 5)
    end = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < end:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
