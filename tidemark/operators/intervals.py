"""Point-in-interval (as-of) joins against a closed-interval history.

A history holds versions ``[start, end]`` per key. ``interval_join`` joins each
event to the version valid on the event's date: equality on the key columns
plus a range on the date. Spark plans that as a sort-merge (or broadcast) join
on the keys with the range as a residual, so it never degrades to a nested
loop; AQE's skew-join splitting covers a hot key on either side.

For an item with very many rows on both sides that plan compares each event with each interval. ``interval_join``
therefore finds such items (one aggregate of the change frame; the other side is asked only for items that have many
rows there), cuts their events into time cells by density, gives every interval the cells it overlaps, and joins on
(item, cell) with the range as residual. The result is the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.common import ITEM_KEYS, all_of, broadcast_bounded
from tidemark.operators.neighbors import SEGMENT, cut_by_density
from tidemark.sources.tables import stage_table

c = F.col

# Attributes of a sales-document version carried into every change row.
SCD_ATTRS = [
    "billing_block_header", "billing_block_item", "cancellation_reason", "cancellation_reason_old",
    "reason_for_rejection", "subscription_quantity", "created_date", "first_pmt_success_date",
]
SCD_ROW = ITEM_KEYS + ["start_date"] + SCD_ATTRS


# An item with more rows than this on both sides of an interval join is joined by time cells of so many events.
HOT_ITEM_ROWS = 10_000


def hot_items(first: DataFrame, other: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, int] | None:
    """Items with more than ``hot_rows`` rows on both sides, staged, and their rows in ``first``; None without any."""
    def many(df: DataFrame, name: str) -> DataFrame:
        counted = df.groupBy(*keys).count().where(c("count") > hot_rows)
        return stage_table(counted, f"hot-items/{uuid.uuid4().hex}-{name}")

    there = many(first, "first")
    if there.isEmpty():
        return None
    both = many(other.join(broadcast_bounded(there.select(*keys)), list(keys), "left_semi"), "both")
    if both.isEmpty():
        return None
    rows = there.join(broadcast_bounded(both.select(*keys)), list(keys), "left_semi").agg(F.sum("count")).first()[0]
    return both.select(*keys), rows


def cells_of(intervals: DataFrame, cut: DataFrame, keys: Sequence[str], at: str, start: str, end: str) -> DataFrame:
    """``intervals`` once for every cell (``SEGMENT``) of their item whose events they may hold."""
    lows = cut.groupBy(*[c(k).alias(f"_c_{k}") for k in keys], c(SEGMENT)).agg(
        F.min(at).alias("_c_lo"), F.max(at).alias("_c_hi"))
    lows = broadcast_bounded(stage_table(lows, f"cells/{uuid.uuid4().hex}"))
    cond = all_of([c(k) == c(f"_c_{k}") for k in keys] + [c(start) <= c("_c_hi"), c(end) >= c("_c_lo")])
    return intervals.join(lows, cond).select(*intervals.columns, SEGMENT)


def interval_join(events: DataFrame, intervals: DataFrame, at: str, select: Sequence[Column],
                  keys: Sequence[str] = ITEM_KEYS, start: str = "start_date", end: str = "end_date", how: str = "inner",
                  count_first: str = "events", hot_rows: int = HOT_ITEM_ROWS) -> DataFrame:
    """Join events (alias ``e``) to the intervals (alias ``h``) of their item that hold ``at``; ``select`` reads both.

    ``count_first`` names the side that is counted first (``events`` or ``intervals``): the change frame, which does not
    grow with the history. ``how`` is inner, left or left_semi.
    """
    def joined(e: DataFrame, h: DataFrame, *more: str) -> DataFrame:
        cond = all_of([c(f"e.{k}") == c(f"h.{k}") for k in (*keys, *more)]
                      + [c(f"e.{at}") >= c(f"h.{start}"), c(f"e.{at}") <= c(f"h.{end}")])
        return e.alias("e").join(h.alias("h"), cond, how).select(*select)

    sides = (events, intervals) if count_first == "events" else (intervals, events)
    hot = hot_items(*sides, keys, hot_rows)
    if hot is None:
        return joined(events, intervals)
    items, rows = hot
    items, keys = broadcast_bounded(items), list(keys)
    own = events.join(items, keys, "left_semi").select(*events.columns)
    if count_first != "events":
        rows = own.count()
    cut = cut_by_density(own, keys, at, rows, hot_rows)
    celled = cells_of(intervals.join(items, keys, "left_semi").select(*intervals.columns), cut, keys, at, start, end)
    plain = joined(events.join(items, keys, "left_anti").select(*events.columns),
                   intervals.join(items, keys, "left_anti").select(*intervals.columns))
    return plain.unionByName(joined(cut, celled, SEGMENT))


def scd_rows_starting(scd: DataFrame, subs: DataFrame, cutoff, today) -> DataFrame:
    """History versions that start inside the window, for items of active subscriptions.

    With subscriptions that carry their ``cutoff_date``, ``cutoff`` is the earliest one, for the scan, and a version has to
    start at its own (one row per item, so no version is repeated).
    """
    if "cutoff_date" in subs.columns:
        first = subs.groupBy(*ITEM_KEYS).agg(F.min("cutoff_date").alias("_own_cutoff"))
        rows = scd.where(c("start_date").between(F.lit(cutoff), F.lit(today)))
        return rows.join(first, ITEM_KEYS).where(c("start_date") >= c("_own_cutoff")).select(*SCD_ROW)
    s = subs.select(*ITEM_KEYS)
    return scd.where(c("start_date").between(F.lit(cutoff), F.lit(today))).join(s, ITEM_KEYS, "left_semi").select(*SCD_ROW)


def event_points(frame: DataFrame, at: str | Column, keys: list[str] = ITEM_KEYS) -> DataFrame:
    """Project a change frame to ``(keys, at_date)`` points for a shared version lookup."""
    at_col = c(at) if isinstance(at, str) else at
    return frame.select(*[c(k) for k in keys], at_col.cast("date").alias("at_date"))
