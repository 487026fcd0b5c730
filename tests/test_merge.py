"""MERGE semantics: update / insert / keep, cardinality guard, range update, idempotence, bucket-wise table."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.operators.merge import merge_range_update, merge_upsert, upsert_near
from tidemark.sources.merge_table import MergeTable

D = dt.date


def _target(spark):
    return spark.createDataFrame([Row(k=1, s=D(2021, 1, 1), v="old1", u="x"), Row(k=2, s=D(2021, 1, 1), v="old2", u="y")])


def test_upsert_updates_inserts_and_keeps(spark):
    src = spark.createDataFrame([Row(k=1, s=D(2021, 1, 1), v="new1"), Row(k=3, s=D(2021, 2, 1), v="new3")])
    out = {(r.k, r.s): (r.v, r.u) for r in merge_upsert(_target(spark), src, ["k", "s"]).collect()}
    assert out == {(1, D(2021, 1, 1)): ("new1", "x"), (2, D(2021, 1, 1)): ("old2", "y"), (3, D(2021, 2, 1)): ("new3", None)}


def test_upsert_is_idempotent(spark):
    src = spark.createDataFrame([Row(k=1, s=D(2021, 1, 1), v="new1"), Row(k=3, s=D(2021, 2, 1), v="new3")])
    once = merge_upsert(_target(spark), src, ["k", "s"])
    twice = merge_upsert(once, src, ["k", "s"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_upsert_rejects_two_source_rows_per_key(spark):
    src = spark.createDataFrame([Row(k=1, s=D(2021, 1, 1), v="a"), Row(k=1, s=D(2021, 1, 1), v="b")])
    with pytest.raises(Exception, match="cardinality"):
        merge_upsert(_target(spark), src, ["k", "s"]).collect()


def _ranges(spark):
    return spark.createDataFrame([
        Row(k=1, b_start=D(2020, 12, 1), b_end=D(2021, 1, 31), item=1, flag="A"),
        Row(k=1, b_start=D(2020, 12, 15), b_end=D(2021, 2, 28), item=2, flag="B"),
    ])


def test_range_update_latest_and_error(spark):
    out = merge_range_update(_target(spark), _ranges(spark), keys=["k"], at="s", start="b_start", end="b_end",
                             set_col="u", from_col="flag", target_key=["k", "s"], on_multi="latest",
                             prefer=["b_start", "item"])
    assert {r.k: r.u for r in out.collect()} == {1: "B", 2: "y"}      # latest plan wins; unmatched keeps its value
    with pytest.raises(Exception, match="cardinality"):
        merge_range_update(_target(spark), _ranges(spark), keys=["k"], at="s", start="b_start", end="b_end",
                           set_col="u", from_col="flag", target_key=["k", "s"]).collect()


def _table(prefix="t", **options) -> MergeTable:
    return MergeTable(f"{prefix}_{uuid.uuid4().hex[:8]}", ["k"], **options)


def _files(spark, table):
    """Files of the base table by bucket."""
    rows = spark.table(table.base).select("_bucket", F.input_file_name().alias("f")).distinct().collect()
    return {(r[0], r.f) for r in rows}


def test_merge_rewrites_only_touched_buckets(spark):
    table = _table(buckets=8)
    table.create(spark.range(0, 100).selectExpr("id AS k", "DATE '2021-01-01' AS s", "'old' AS v"))
    before = _files(spark, table)
    src = spark.createDataFrame([Row(k=5, s=D(2021, 1, 1), v="new"), Row(k=500, s=D(2021, 1, 1), v="ins")])
    touched = {r.b for r in src.select(table.bucket_of().alias("b")).collect()}
    table.upsert(src, ["k", "s"])
    out = {r.k: r.v for r in spark.sql(f"SELECT k, v FROM {table.name}").collect()}   # plain SQL reads it
    assert len(out) == 101 and out[5] == "new" and out[500] == "ins" and out[6] == "old"
    assert table.read(spark).columns == ["k", "s", "v"]
    after = _files(spark, table)
    assert {b for b, _ in before ^ after} == touched
    assert not spark.catalog.tableExists(table.delta)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_broadcast_path_equals_full_outer_join(spark):
    tgt = spark.createDataFrame([Row(k=i, s=D(2021, 1, 1), v=f"old{i}", u="x") for i in range(50)])
    src = spark.createDataFrame([Row(k=i, s=D(2021, 1, 1), v=f"new{i}", w=i) for i in range(40, 60)])
    full = merge_upsert(tgt, src, ["k", "s"], update=["v", "w"], insert=["k", "s", "v", "w"])
    fast = merge_upsert(tgt, src, ["k", "s"], update=["v", "w"], insert=["k", "s", "v", "w"], broadcast_bytes=1000)
    assert fast.columns == full.columns
    assert sorted(map(str, fast.collect())) == sorted(map(str, full.collect()))
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan            # the target is streamed through broadcast joins
    dup = src.unionByName(src.limit(1))
    with pytest.raises(Exception, match="cardinality"):
        merge_upsert(tgt, dup, ["k", "s"], broadcast_bytes=1000).collect()
    r_full = merge_range_update(_target(spark), _ranges(spark), keys=["k"], at="s", start="b_start", end="b_end",
                                set_col="u", from_col="flag", target_key=["k", "s"], on_multi="latest",
                                prefer=["b_start", "item"])
    r_fast = merge_range_update(_target(spark), _ranges(spark), keys=["k"], at="s", start="b_start", end="b_end",
                                set_col="u", from_col="flag", target_key=["k", "s"], on_multi="latest",
                                prefer=["b_start", "item"], broadcast_bytes=1000)
    assert sorted(map(str, r_fast.collect())) == sorted(map(str, r_full.collect()))


def test_columns_that_only_some_buckets_have(spark):
    table = _table(buckets=8)
    table.create(spark.createDataFrame([(k, f"v{k}") for k in range(40)], "k long, v string"))
    table.upsert(spark.createDataFrame([(5, "new", "X")], "k long, v string, added string"), ["k"])
    table.upsert(spark.createDataFrame([(6, "other")], "k long, v string"), ["k"])
    out = {r.k: (r.v, r.added) for r in table.read(spark).collect()}
    assert out[5] == ("new", "X") and out[6] == ("other", None) and out[7] == ("v7", None) and len(out) == 40


class _Stopped(Exception):
    pass


@pytest.mark.parametrize("dies_at", ["_show", "_fold"])
def test_a_merge_that_dies_is_seen_whole_or_not_at_all(spark, dies_at):
    table = _table(buckets=4)
    table.create(spark.createDataFrame([(k, f"v{k}") for k in range(20)], "k long, v string"))

    def stop(*args):
        raise _Stopped

    dying = MergeTable(table.name, ["k"], buckets=4)
    setattr(dying, dies_at, stop)
    with pytest.raises(_Stopped):
        dying.upsert(spark.createDataFrame([(1, "A"), (50, "new")], "k long, v string"), ["k"])
    seen = {r.k: r.v for r in table.read(spark).collect()}
    if dies_at == "_show":
        assert seen == {k: f"v{k}" for k in range(20)}
    else:
        assert seen == {k: f"v{k}" for k in range(20)} | {1: "A", 50: "new"}
    table.upsert(spark.createDataFrame([(2, "B")], "k long, v string"), ["k"])     # finishes what was shown
    seen = {r.k: r.v for r in table.read(spark).collect()}
    assert seen == ({k: f"v{k}" for k in range(20)} | {2: "B"} | ({1: "A", 50: "new"} if dies_at == "_fold" else {}))


def test_create_replaces_the_rows(spark):
    table = _table(buckets=2)
    table.create(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"))
    table.create(spark.createDataFrame([(3, 1.5)], "k long, w double"))
    assert [tuple(r) for r in table.read(spark).collect()] == [(3, 1.5)]
    table.upsert(spark.createDataFrame([], "k long, w double"), ["k"])            # nothing touched
    assert table.read(spark).count() == 1


def test_a_repeated_target_key_is_not_inserted_again(spark):
    target = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")], "k long, v string")
    out = merge_upsert(target, spark.createDataFrame([(1, "A"), (3, "c")], "k long, v string"), ["k"],
                       broadcast_bytes=1 << 20)
    assert sorted(r.v for r in out.collect()) == ["A"] * 50 + ["b", "c"]


def _stored(spark):
    """A target and a source with two-part items: repeated target keys, nulls, items of one side only."""
    day = lambda k: None if k == 9 else D(2021, 1, 1 + k)
    target = [(k % 5 if k % 7 else None, "x", day(k % 10), f"t{k}", k) for k in range(40)]
    source = [(k, "x", D(2021, 1, d), f"s{k}{d}", None) for k in range(7) for d in (1, 3, 20)] + [(None, "x", D(2021, 1, 1), "n", 1)]
    return (spark.createDataFrame(target, "k int, j string, s date, v string, u int"),
            spark.createDataFrame(source, "k int, j string, s date, v string, extra int"))


@pytest.mark.parametrize("hot_rows", [10_000, 2])
def test_upsert_near_equals_the_full_outer_join(spark, hot_rows):
    target, source = _stored(spark)
    expected = merge_upsert(target, source, ["k", "j", "s"], update=["v", "extra"])
    kept, new = upsert_near(target, source, ["k", "j", "s"], ["v", "extra"], None, True,
                            lambda rows, name: rows.repartition(4, "k", "j"), hot_rows)
    assert kept.dtypes == new.dtypes == expected.dtypes
    assert kept.count() == target.count() and new.count() > 0
    assert sorted(map(str, kept.unionByName(new).collect())) == sorted(map(str, expected.collect()))


def test_upsert_near_rejects_two_source_rows_per_key(spark):
    target, source = _stored(spark)
    twice = spark.createDataFrame([(99, "x", D(2021, 1, 1), "a", 1)] * 2, source.schema)     # no target row has the key
    with pytest.raises(Exception, match="cardinality"):
        kept, new = upsert_near(target, twice, ["k", "j", "s"], None, None, True, lambda rows, name: rows.repartition(4, "k", "j"))
        kept.unionByName(new).collect()


def test_range_update_near_equals_the_plain_one(spark):
    target, _ = _stored(spark)
    ranges = spark.createDataFrame([(k, "x", D(2021, 1, a), D(2021, 1, a + 3), a, 10 * a + k) for k in range(5) for a in (1, 3, 4)],
                                   "k int, j string, a date, b date, item int, u2 int")
    args = dict(keys=["k", "j"], at="s", start="a", end="b", set_col="u", from_col="u2", target_key=["k", "j", "s"],
                on_multi="latest", prefer=["a", "item"])
    expected = merge_range_update(target, ranges, **args)
    got = merge_range_update(target, ranges, **args, near=lambda rows, name: rows.repartition(4, "k", "j"))
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_large_merges_leave_the_target_where_it_is_stored(spark, monkeypatch):
    """Beyond the broadcast bound nothing is moved between the stored tables and the merged rows."""
    from tests.conftest import SF001
    from tidemark.plans import status_history
    from tidemark.plans.status_history import HistorySources, StatusHistoryJob
    from tidemark.queries import FIXTURE_DATES
    from tidemark.sources.fixtures import Fixtures

    src = HistorySources.from_fixtures(Fixtures(spark, SF001))
    expected = StatusHistoryJob(src, FIXTURE_DATES).merged_with_plan_flag
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(status_history, "MAX_BROADCAST_BYTES", -1)
    try:
        got = StatusHistoryJob(src, FIXTURE_DATES).merged_with_plan_flag
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
