"""Whole-job properties on the sf0.001 fixtures."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark.functions.dates import text_to_date
from tidemark.operators import deltas as dl
from tidemark.operators.common import ITEM_KEYS, VERSION_KEYS
from tidemark.operators.merge import merge_upsert
from tidemark.params import CategoryWindows, RunDates, RunParams, cutoff_lookup
from tidemark.plans.status_history import FINAL_COLS, HistorySources, StatusHistoryJob
from tidemark.queries import FIXTURE_DATES
from tidemark.sources.fixtures import Fixtures
from tidemark.sources.merge_table import MergeTable
from tidemark.streaming.incremental import run_incremental

c = F.col


@pytest.fixture(scope="module")
def src(spark):
    return HistorySources.from_fixtures(Fixtures(spark, SF001))


def _rows(df):
    return sorted((tuple((v is None, str(v)) for v in r) for r in df.collect()))


def test_one_job_equals_loop_per_category(spark, src):
    whole = StatusHistoryJob(src, FIXTURE_DATES).final_rows
    cats = sorted(r[0] for r in src.dim.select("subscription_category").distinct().collect())
    parts = [StatusHistoryJob(src, FIXTURE_DATES, categories=[k]).final_rows for k in cats]
    looped = parts[0]
    for p in parts[1:]:
        looped = looped.unionByName(p)
    assert whole.count() > 0
    assert _rows(whole) == _rows(looped)


def test_fused_plan_equals_staged_plan(spark, src):
    staged = StatusHistoryJob(src, FIXTURE_DATES).status_rows
    fused = StatusHistoryJob(src, FIXTURE_DATES, materialize=None).status_rows
    assert _rows(staged) == _rows(fused)


def test_dead_status_joins_change_nothing(spark, src):
    job = StatusHistoryJob(src, FIXTURE_DATES)
    s = job.status_input.alias("t")
    b = job.bill_docs_cancelled.withColumn("_d", text_to_date("created_date"))
    a1, a2 = b.alias("s3"), b.alias("s3b")
    with_dead = (s.join(a1, [c(f"t.{k}") == c(f"s3.{k}") for k in ITEM_KEYS + ["bp_no", "bp_item"]]
                        + [c("t.start_date") == c("s3._d")], "left")
                 .join(a2, [c(f"t.{k}") == c(f"s3b.{k}") for k in ITEM_KEYS + ["bp_no", "bp_end_date"]]
                       + [c("t.start_date") == c("s3b._d")], "left")
                 .select("t.*"))
    plain = StatusHistoryJob(src, FIXTURE_DATES)
    plain.__dict__["status_input"] = with_dead          # same job, status input with the two dead joins
    assert _rows(plain.status_rows) == _rows(job.status_rows)


def _log(spark, dates, workflow="STATUS_HISTORY"):
    return spark.createDataFrame([("common", "SUBSCRIPTION", f"{workflow}_{k}", "CUTOFF", d) for k, d in dates.items()],
                                 "schma_nm string, grp_nm string, wrkflw_nm string, attr_nm string, attr_val_dt date")


def test_second_merge_of_same_run_changes_nothing(spark, src):
    job = StatusHistoryJob(src, FIXTURE_DATES)
    once = job.merged
    twice = merge_upsert(once, job.final_rows, VERSION_KEYS, update=FINAL_COLS[4:], insert=FINAL_COLS)
    assert _rows(once) == _rows(twice)


def test_incremental_run_into_a_merge_table(spark, src):
    job = StatusHistoryJob(src, FIXTURE_DATES)
    expected = _rows(job.merged_with_plan_flag.select(*FINAL_COLS, "upd_ind"))
    sink = MergeTable("status_one_cutoff", ITEM_KEYS, buckets=16)
    sink.create(src.target.withColumn("last_modified", F.lit(None).cast("timestamp_ntz"))
                .withColumn("upd_ind", F.lit(None).cast("string")))
    log = _log(spark, {k: dt.date(1998, 6, 4) for k in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "SERV"]})
    params = RunParams(as_of=dt.date(1998, 6, 30), days_back=3)
    result = run_incremental(spark, src, log, params, sink=sink)
    assert (result.windows.first, result.windows.last) == (FIXTURE_DATES.cutoff, FIXTURE_DATES.cutoff)
    assert _rows(sink.read(spark).select(*FINAL_COLS, "upd_ind")) == expected
    assert {r.attr_val_dt for r in result.next_log.collect()} == {dt.date(1998, 6, 30)}


def test_cutoff_lookup_default_logged_and_full_load(spark, src):
    cats = dl.distinct_categories(src.dim)
    log = _log(spark, {"BUILDING": dt.date(1998, 6, 1)})
    p = RunParams(as_of=dt.date(1998, 6, 30), days_back=3, default_start=dt.date(1998, 1, 1))
    got = {r[0]: r[1] for r in cutoff_lookup(cats, log, p).collect()}
    assert got["BUILDING"] == dt.date(1998, 5, 29) and got["SERV"] == dt.date(1998, 1, 1)
    full = RunParams(as_of=p.as_of, days_back=3, default_start=p.default_start, full_load=True)
    assert {r[1] for r in cutoff_lookup(cats, log, full).collect()} == {dt.date(1998, 1, 1)}
    windows = CategoryWindows.of(cutoff_lookup(cats, log, p), p.as_of)
    assert (windows.first, windows.last) == (dt.date(1998, 1, 1), dt.date(1998, 5, 29))


def test_cutoff_of_another_workflow_is_not_ours(spark, src):
    log = _log(spark, {"BUILDING": dt.date(1998, 6, 1)}).union(_log(spark, {"BUILDING": dt.date(1998, 6, 20)}, "OTHER"))
    p = RunParams(as_of=dt.date(1998, 6, 30), days_back=3)
    got = {r[0]: r[1] for r in cutoff_lookup(dl.distinct_categories(src.dim), log, p).collect()}
    assert got["BUILDING"] == dt.date(1998, 5, 29)


def test_two_cutoffs_with_the_sink_as_target(spark, src):
    """Categories with different cutoffs in one job and one pair of merges."""
    sink = MergeTable("status_two_cutoffs", ITEM_KEYS, buckets=4)
    sink.create(src.target)
    log = _log(spark, {"BUILDING": dt.date(1998, 6, 10)})
    params = RunParams(as_of=dt.date(1998, 6, 30), days_back=3, default_start=dt.date(1998, 6, 1))
    result = run_incremental(spark, src, log, params, sink=sink)
    assert (result.windows.first, result.windows.last) == (dt.date(1998, 6, 1), dt.date(1998, 6, 7))
    modified = {r[0] for r in sink.read(spark).where("last_modified IS NOT NULL").join(
        src.dim.select(*ITEM_KEYS, "subscription_category"), ITEM_KEYS).select("subscription_category").distinct().collect()}
    assert "BUILDING" in modified and len(modified) == 5
    assert result.next_log.columns == ["schma_nm", "grp_nm", "wrkflw_nm", "attr_nm", "attr_val_dt"]
    # the same as one job per cutoff, each merged into what the one before has left
    target = src.target
    for cutoff, cats in ((dt.date(1998, 6, 1), ["AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "SERV"]), (dt.date(1998, 6, 7), ["BUILDING"])):
        target = StatusHistoryJob(replace(src, target=target), RunDates(cutoff, params.as_of), categories=cats).merged_with_plan_flag
    columns = [*FINAL_COLS, "upd_ind"]
    assert _rows(sink.read(spark).select(*columns)) == _rows(target.select(*columns))


CUTOFFS = {"AUTOMOBILE": dt.date(1998, 6, 20), "BUILDING": dt.date(1998, 4, 1), "FURNITURE": dt.date(1998, 6, 1),
           "HOUSEHOLD": dt.date(1998, 6, 20), "SERV": dt.date(1998, 4, 1)}


@pytest.mark.parametrize("materialize", ["stage", None])
def test_one_job_for_three_cutoffs_equals_three_jobs(spark, src, materialize):
    today = dt.date(1998, 6, 30)
    frame = spark.createDataFrame(list(CUTOFFS.items()), "subscription_category string, cutoff_date date")
    one = StatusHistoryJob(src, CategoryWindows.of(frame, today), materialize=materialize)
    jobs = [StatusHistoryJob(src, RunDates(k, today), categories=[x for x, v in CUTOFFS.items() if v == k])
            for k in sorted(set(CUTOFFS.values()))]
    names = ["plan_items", "bill_docs", "bill_docs_sibling", "bill_docs_cancelled", "credit_memos", "contract_starts",
             "delta_versions", "status_rows", "reopened", "final_rows", "plan_ranges"] if materialize else ["status_rows"]
    for name in names:
        several = [getattr(job, name) for job in jobs]
        whole = several[0]
        for part in several[1:]:
            whole = whole.unionByName(part)
        got = getattr(one, name)
        # three windows may hold the same row of an item without a category (history starts), one job gives it once
        assert _rows(got.select(*whole.columns)) == _rows(whole), name
        assert whole.count() > 0, name


def test_bounds_of_all_cutoffs_reach_the_scans(spark, src):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        _check_bounds(spark, src)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)


def _check_bounds(spark, src):
    frame = spark.createDataFrame(list(CUTOFFS.items()), "subscription_category string, cutoff_date date")
    job = StatusHistoryJob(src, CategoryWindows.of(frame, dt.date(1998, 6, 30)), materialize=None)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    delta = plan(job.plan_delta)
    assert ">= 19980401)" in delta and "<= 19980619)" in delta and "PushedFilters: [Or(" in delta
    assert "GreaterThanOrEqual(created_date,19980401)" in plan(job.bill_docs_cancelled)
    assert "GreaterThanOrEqual(start_date,1998-04-01)" in plan(job.scd_starts)
    assert "GreaterThanOrEqual(contract_start_date_bp,1998-04-01)" in plan(job.contract_starts)
    reopened = plan(job.reopened)
    assert "LessThanOrEqual(start_date,1998-06-19)" in reopened and "GreaterThanOrEqual(end_date,1998-03-31)" in reopened
    for df in (job.plan_items, job.scd_starts, job.contract_starts):
        assert "BroadcastHashJoin" in plan(df)       # the cutoffs meet the rows as a broadcast


def test_unset_guard_binds_to_first_branch_only(spark, src):
    verbatim = dl.plan_delta(src.plans, FIXTURE_DATES)
    guarded = dl.plan_delta(src.plans, FIXTURE_DATES, guard_all=True)
    sentinel = c("ofkdat") == "00000000"
    assert verbatim.where(sentinel).count() > 0 and guarded.where(sentinel).count() == 0


def test_run_dates_text_forms():
    rd = RunDates(cutoff=dt.date(2021, 9, 4), today=dt.date(2021, 10, 3))
    assert (rd.cutoff_text, rd.cutoff_scd_text, rd.today_text, rd.yesterday_text) == (
        "20210904", "20210903", "20211003", "20211002")


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert "end_date" in df.columns and "subscription_status" in df.columns


def test_queries_follow_changed_files(spark, tmp_path):
    import shutil

    from tidemark.queries import queries

    folder = tmp_path / "sf"
    shutil.copytree(SF001, folder, copy_function=shutil.copyfile)
    folder.chmod(0o755)  # the copy of a read-only folder is read-only
    delta = queries()["plan_delta_filter"]
    before = delta(spark, str(folder)).count()
    half = spark.read.parquet(f"{SF001}/lineitem.parquet").where("l_orderkey % 2 = 0")
    (folder / "lineitem.parquet").unlink()
    half.coalesce(1).write.parquet(str(folder / "lineitem.parquet"))
    after = delta(spark, str(folder)).count()
    assert 0 < after < before
