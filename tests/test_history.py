"""Window operators against a brute-force reference on random histories (one hot key holds a third)."""

import datetime as dt
import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.operators import history as hs
from tidemark.operators.neighbors import SEGMENT, by_key_size, cut_by_density, hot_keys

c = F.col

D0 = dt.date(2020, 1, 1)


def random_history(seed=7, keys=30, rows=600):
    rnd = random.Random(seed)
    out, used = [], set()
    for i in range(rows):
        doc = 0 if i < rows // 3 else rnd.randrange(1, keys)   # key 0 is hot
        day = rnd.randrange(0, 2000)
        if (doc, day) in used:
            continue
        used.add((doc, day))
        out.append(Row(client="010", sales_document=doc, sales_document_item=10, start_date=D0 + dt.timedelta(day),
                       subscription_status=rnd.choice(["ACTIVE", "INACTIVE"]),
                       cancellation_reason=rnd.choice(["SC", "SA", None]),
                       cancellation_reason_old=rnd.choice(["SA", "S4", None])))
    return out


def brute(rows):
    by_key = {}
    for r in rows:
        by_key.setdefault(r.sales_document, []).append(r)
    dropped, collapsed = [], []
    for doc, rs in by_key.items():
        rs.sort(key=lambda r: r.start_date)
        kept = []
        for i, r in enumerate(rs):
            prev = rs[i - 1].subscription_status if i else None
            noise = (r.subscription_status == "ACTIVE" and prev == "INACTIVE"
                     and r.cancellation_reason == "SC" and r.cancellation_reason_old == "SA")
            if not noise:
                kept.append(r)
        dropped += kept
        runs = [r for i, r in enumerate(kept) if i == 0 or kept[i - 1].subscription_status != r.subscription_status]
        for i, r in enumerate(runs):
            end = runs[i + 1].start_date - dt.timedelta(1) if i + 1 < len(runs) else dt.date(9999, 12, 31)
            collapsed.append((doc, r.start_date, r.subscription_status, end))
    return dropped, sorted(collapsed)


def test_collapse_and_close_match_brute_force(spark):
    rows = random_history()
    df = spark.createDataFrame(rows)
    dropped, expected = brute(rows)
    got_dropped = hs.drop_reactivation(df)
    assert got_dropped.count() == len(dropped)
    out = hs.close_intervals(hs.collapse_runs(got_dropped))
    got = sorted((r.sales_document, r.start_date, r.subscription_status, r.end_date) for r in out.collect())
    assert got == expected


def test_invariants_after_closing(spark):
    df = spark.createDataFrame(random_history(seed=11))
    out = hs.close_intervals(hs.collapse_runs(df)).collect()
    by_key = {}
    for r in out:
        by_key.setdefault(r.sales_document, []).append(r)
    for rs in by_key.values():
        rs.sort(key=lambda r: r.start_date)
        assert sum(r.end_date == dt.date(9999, 12, 31) for r in rs) == 1          # one open row per key
        for a, b in zip(rs, rs[1:]):
            assert a.end_date == b.start_date - dt.timedelta(1)                   # no gap, no overlap
            assert a.subscription_status != b.subscription_status                 # adjacent statuses differ


def test_link_versions_and_observed_variant(spark):
    rows = [Row(client="010", sales_document=1, sales_document_item=10, start_date=D0 + dt.timedelta(d),
                subscription_status=s, link_id=f"L{d}", prev_link_id=None)
            for d, s in [(0, "ACTIVE"), (5, "INACTIVE"), (9, "ACTIVE")]]
    df = spark.createDataFrame(rows, "client string, sales_document int, sales_document_item int, start_date date, "
                                     "subscription_status string, link_id string, prev_link_id string")
    linked = sorted(hs.link_versions(df).collect(), key=lambda r: r.start_date)
    assert [r.prev_link_id for r in linked] == [None, "L0", "L5"]
    observed = sorted(hs.close_intervals_observed(df).collect(), key=lambda r: r.start_date)
    assert [r.end_date for r in observed] == [None, None, "9999-12-31"]     # only the last row is closed
    assert [r.prev_link_id for r in observed] == [None, None, None]          # links are lost


def test_one_version_per_start_prefers_inactive(spark):
    rows = [Row(client="010", sales_document=1, sales_document_item=10, start_date=D0, subscription_status=s, x=x)
            for s, x in [("ACTIVE", "a"), ("INACTIVE", "z"), ("INACTIVE", "b")]]
    out = hs.one_version_per_start(spark.createDataFrame(rows)).collect()
    assert [(r.subscription_status, r.x) for r in out] == [("INACTIVE", "b")]


def test_timestamp_history_closes_by_microsecond(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [Row(user_id=1, start_ts=t0, status="ACTIVE"), Row(user_id=1, start_ts=t0 + dt.timedelta(hours=1), status="INACTIVE")]
    df = spark.createDataFrame(rows, "user_id long, start_ts timestamp_ntz, status string")
    out = sorted(hs.close_intervals(df, keys=["user_id"], order=["start_ts"], start="start_ts", end="end_ts").collect(),
                 key=lambda r: r.start_ts)
    assert out[0].end_ts == t0 + dt.timedelta(hours=1) - dt.timedelta(microseconds=1)
    assert out[1].end_ts == dt.datetime(9999, 12, 31)


ITEM = ["client", "sales_document", "sales_document_item"]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _chain(d, split):
    d = hs.link_versions(hs.collapse_runs(hs.drop_reactivation(d, split=split), split=split), split=split)
    return hs.close_intervals(d, split=split)


def test_hot_keys_give_the_same_rows_as_plain_windows(spark):
    df = spark.createDataFrame(random_history(seed=3, rows=900)).withColumn(
        "link_id", F.concat_ws("-", "sales_document", "start_date")).withColumn("prev_link_id", F.lit(None).cast("string"))
    assert hot_keys(df, ITEM, 50).count() == 1   # key 0 only
    for hot_rows in (2, 50):
        assert _rows(by_key_size(df, ITEM, hot_rows, _chain)) == _rows(_chain(df, None))
        assert _rows(by_key_size(df, ITEM, hot_rows, lambda d, s: hs.lag_status(d, split=s))) == _rows(hs.lag_status(df))
        assert _rows(by_key_size(df, ITEM, hot_rows, lambda d, s: hs.close_intervals_observed(d, split=s))) == _rows(
            hs.close_intervals_observed(df))


def test_null_order_values_and_null_keys_agree_for_hot_keys(spark):
    days = [None, dt.date(2021, 1, 1), dt.date(2021, 3, 1), dt.date(2021, 6, 1)]
    rows = [Row(client="c", sales_document=k, sales_document_item=10, start_date=d, subscription_status=s)
            for k in (1, None) for d, s in zip(days, "ABCD")]
    df = spark.createDataFrame(rows, "client string, sales_document long, sales_document_item int, start_date date, "
                                     "subscription_status string")
    split = by_key_size(df, ITEM, 2, lambda d, s: hs.lag_status(d, split=s))
    assert _rows(split) == _rows(hs.lag_status(df))
    assert sorted(map(str, (r.lag_subscription_status for r in split.collect()))) == ["A", "A", "B", "B", "C", "C", "None", "None"]


def test_without_hot_keys_the_plan_is_one_exchange(spark):
    df = spark.createDataFrame(random_history(seed=3, rows=900))
    plan = by_key_size(df, ITEM, 10_000, lambda d, s: hs.close_intervals(hs.collapse_runs(d, split=s), split=s))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_hot_keys_on_timestamps(spark):
    rows = [Row(user_id=1, start_ts=dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i), status="AI"[i % 3 == 0])
            for i in range(300)] + [Row(user_id=2, start_ts=dt.datetime(2024, 1, 1), status="A")]
    df = spark.createDataFrame(rows, "user_id long, start_ts timestamp_ntz, status string")

    def steps(d, split):
        key = dict(keys=["user_id"], order=["start_ts"], split=split)
        return hs.close_intervals(hs.collapse_runs(d, status="status", **key), start="start_ts", end="end_ts", **key)

    assert _rows(by_key_size(df, ["user_id"], 20, steps, order="start_ts")) == _rows(steps(df, None))


def test_a_key_with_all_rows_in_one_day_is_cut_by_density(spark):
    """A million rows of one key within one day, most of them within a second, spread over many segments."""
    n = 1_000_000
    at = F.when(c("id") < 50_000, c("id") * F.lit(1_000_000)).otherwise(F.lit(50_000_000_000) + c("id"))
    df = spark.range(n).select(F.lit(7).alias("user_id"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + at).cast(
        "timestamp_ntz").alias("start_ts"), F.when(F.hash("id") % 3 == 0, "A").otherwise("B").alias("status"))
    cut = cut_by_density(df, ["user_id"], "start_ts", n, 50_000)
    sizes = [r["count"] for r in cut.groupBy(SEGMENT).count().collect()]
    assert len(sizes) >= 18 and max(sizes) < 2.5 * 50_000

    def steps(d, split):
        key = dict(keys=["user_id"], order=["start_ts"], split=split)
        return hs.close_intervals(hs.collapse_runs(d, status="status", **key), start="start_ts", end="end_ts", **key)

    def digest(d):
        return d.agg(F.count("*"), F.sum(F.xxhash64("user_id", "start_ts", "status", "end_ts").cast("decimal(38,0)"))).first()

    assert digest(by_key_size(df, ["user_id"], 100_000, steps, order="start_ts")) == digest(steps(df, None))


def test_filtered_segments_and_segments_without_rows(spark):
    """Steps that drop whole segments still carry the right neighbour over them."""
    rows = [Row(client="c", sales_document=1, sales_document_item=10, start_date=D0 + dt.timedelta(k),
                subscription_status="A" if 20 <= k < 80 else "AB"[k % 2]) for k in range(100)]
    df = spark.createDataFrame(rows)
    assert _rows(by_key_size(df, ITEM, 10, lambda d, s: hs.close_intervals(hs.collapse_runs(d, split=s), split=s))) == _rows(
        hs.close_intervals(hs.collapse_runs(df)))
