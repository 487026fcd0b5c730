"""Interval joins: hot items by time cells give the rows of the plain join."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark.operators.intervals import cells_of, hot_items, interval_join
from tidemark.operators.merge import merge_range_update
from tidemark.operators.neighbors import cut_by_density
from tidemark.plans.status_history import HistorySources, StatusHistoryJob
from tidemark.queries import FIXTURE_DATES
from tidemark.sources.fixtures import Fixtures

c = F.col
D0 = dt.date(2000, 1, 1)
EVENTS, INTERVALS = "k int, at date, n int", "k int, s date, e date, v int"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def frames(spark):
    """Item 1 is hot on both sides; item 2 on one only; 3 is ordinary; nulls, items and dates without a partner."""
    rnd = random.Random(4)
    days = [rnd.randrange(3000) if rnd.random() < 0.3 else 1500 + rnd.randrange(4) for _ in range(400)]
    events = [(1, D0 + dt.timedelta(d), n) for n, d in enumerate(days)] + [(1, None, -1), (None, D0, -2)]
    events += [(2, D0 + dt.timedelta(n), n) for n in range(90)] + [(3, D0, 1), (4, D0, 2)]
    starts = sorted(rnd.sample(range(3000), 300))
    ends = [b - 1 for b in starts[1:]] + [None]
    intervals = [(1, D0 + dt.timedelta(a), dt.date(9999, 12, 31) if b is None else D0 + dt.timedelta(b), k)
                 for k, (a, b) in enumerate(zip(starts, ends))]
    intervals += [(1, D0, dt.date(9999, 12, 31), 999), (1, None, D0, 998), (None, D0, D0, 997), (2, D0, D0 + dt.timedelta(9), 1),
                  (3, D0, D0, 5)]
    return spark.createDataFrame(events, EVENTS), spark.createDataFrame(intervals, INTERVALS)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("first", ["events", "intervals"])
def test_cells_give_the_rows_of_the_plain_join(frames, how, first):
    events, intervals = frames
    columns = [c("e.k"), c("e.at"), c("e.n")] + ([] if how == "left_semi" else [c("h.s"), c("h.v")])
    args = dict(keys=["k"], start="s", end="e", how=how, count_first=first)
    plain = _rows(interval_join(events, intervals, "at", columns, **args))
    assert _rows(interval_join(events, intervals, "at", columns, hot_rows=50, **args)) == plain
    assert len(plain) > 400


def test_only_items_that_are_hot_on_both_sides(frames):
    events, intervals = frames
    items, rows = hot_items(events, intervals, ["k"], 50)
    assert [r.k for r in items.collect()] == [1] and rows == 401
    assert hot_items(events, intervals, ["k"], 500) is None


def test_disjoint_intervals_are_compared_with_the_events_of_their_cells_only(spark):
    n = 20_000
    events = spark.range(n).select(F.lit(1).alias("k"), F.date_add(F.lit(D0), (c("id") % 9000).cast("int")).alias("at"))
    versions = spark.range(n).select(F.lit(1).alias("k"), F.date_add(F.lit(D0), c("id").cast("int")).alias("s"),
                                     F.date_add(F.lit(D0), c("id").cast("int")).alias("e"))
    cut = cut_by_density(events, ["k"], "at", n, 500)
    celled = cells_of(versions, cut, ["k"], "at", "s", "e")
    sizes = {r[0]: r["count"] for r in cut.groupBy("_nb_segment").count().collect()}
    held = {r[0]: r["count"] for r in celled.groupBy("_nb_segment").count().collect()}
    assert len(sizes) > 30 and max(sizes.values()) < 1500
    pairs = sum(sizes[k] * held.get(k, 0) for k in sizes)
    assert sum(held.values()) <= 9000 + len(sizes) and pairs < n * n / 30
    args = dict(keys=["k"], start="s", end="e")
    found = interval_join(events, versions, "at", [c("e.at"), c("h.s")], hot_rows=500, **args)
    assert found.count() == n and found.where("at <> s").count() == 0


def test_range_update_of_a_hot_item(frames):
    events, intervals = frames
    target = events.where("k IS NOT NULL AND at IS NOT NULL").withColumn("u", F.lit(0))
    args = dict(keys=["k"], at="at", start="s", end="e", set_col="u", from_col="v", target_key=["k", "at", "n"],
                on_multi="latest", prefer=["s"])
    assert _rows(merge_range_update(target, intervals, hot_rows=50, **args)) == _rows(merge_range_update(target, intervals, **args))


def test_history_job_with_hot_items_everywhere(spark):
    """Every item with two rows on both sides counts as hot: the same rows."""
    src = HistorySources.from_fixtures(Fixtures(spark, SF001))
    plain, cells = (StatusHistoryJob(src, FIXTURE_DATES, hot_rows=n) for n in (10_000, 1))
    for name in ("delta_versions", "with_plans"):
        assert _rows(getattr(cells, name)) == _rows(getattr(plain, name)), name
