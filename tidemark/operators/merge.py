"""MERGE without a transactional table format.

``merge_upsert`` returns the new state of the target as a DataFrame: a full
outer join on the merge key, taking the source's values for matched rows and
inserting unmatched source rows. ``merge_range_update`` sets one column on
target rows whose date falls inside a source interval.

Both carry the MERGE cardinality rule into the plan: a target row matched by
more than one source row fails the job through ``raise_error`` (no extra
action on the driver), unless a deterministic resolution is requested. The
upsert is stricter on purpose: two source rows with one key fail even when no
target row has that key, as they would insert the key twice.
The writer that persists the result is ``tidemark.sources.merge_table.MergeTable``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.common import is_bounded
from tidemark.operators.intervals import HOT_ITEM_ROWS, interval_join

c = F.col

# Stores rows under a name by the keys, and in the way, that the merge target is stored.
Near = Callable[[DataFrame, str], DataFrame]


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update: Sequence[str] | None = None, insert: Sequence[str] | None = None,
                 check_unique: bool = True, broadcast_bytes: int | None = None) -> DataFrame:
    """``MERGE INTO target USING source ON keys WHEN MATCHED UPDATE SET update WHEN NOT MATCHED INSERT insert``.

    Target columns missing from ``insert`` stay NULL on inserted rows; target
    columns missing from ``update`` keep the target's value on matched rows.
    Source columns not in the target are added to it (NULL for old rows).

    With ``broadcast_bytes`` and a source measured within that size (pass a staged one),
    the target is never shuffled: matched and kept rows come from
    ``target LEFT JOIN broadcast(source)``, inserts from the source rows whose
    key is not among ``target SEMI JOIN broadcast(source keys)``. Otherwise it
    is one full outer join on the keys (``upsert_near``: where the target is stored).
    """
    if broadcast_bytes is not None and is_bounded(source, broadcast_bytes):
        return _merge_upsert_broadcast(target, source, keys, update, insert, check_unique)
    keys = list(keys)
    cols = list(target.columns) + [x for x in source.columns if x not in target.columns]
    update = [x for x in (update if update is not None else source.columns) if x not in keys]
    insert = list(insert if insert is not None else source.columns)
    src = _checked(source, keys, check_unique)
    tgt = target.withColumn("_tgt", F.lit(True))
    j = tgt.alias("t").join(src.alias("s"), keys, "full")
    matched_src = c("s._src").isNotNull()
    matched_tgt = c("t._tgt").isNotNull()
    out = []
    for x in cols:
        if x in keys:
            out.append(c(x))
            continue
        t_val = c(f"t.{x}") if x in target.columns else F.lit(None)
        s_val = c(f"s.{x}") if x in source.columns else F.lit(None)
        dtype = (target.schema[x] if x in target.columns else source.schema[x]).dataType
        on_update = s_val if x in update else t_val
        on_insert = s_val if x in insert else F.lit(None)
        out.append(F.when(matched_tgt & matched_src, on_update).when(matched_tgt, t_val)
                   .otherwise(on_insert).cast(dtype).alias(x))
    return j.select(*out)


def _checked(source: DataFrame, keys: Sequence[str], check_unique: bool) -> DataFrame:
    """``source`` with ``_src`` true; with ``check_unique`` rows that share a key fail the job."""
    if not check_unique:
        return source.withColumn("_src", F.lit(True))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return source.withColumn("_src", F.when(n > 1, F.raise_error(
        F.lit("MERGE cardinality violation: several source rows share one merge key"))).otherwise(F.lit(True)))


def upsert_near(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None,
                insert: Sequence[str] | None, check_unique: bool, near: Near,
                hot_rows: int = HOT_ITEM_ROWS) -> tuple[DataFrame, DataFrame]:
    """The upsert where the target is stored: its rows, updated or kept, and the inserted ones (no key is in both).

    An equal last key is an interval of one value, so that the joins are on the keys that the target is stored by. A union
    would lose that; what follows in place takes the two parts one by one.
    """
    *by, at = keys
    cols = list(target.columns) + [x for x in source.columns if x not in target.columns]
    update = [x for x in (update if update is not None else source.columns) if x not in keys]
    insert = list(insert if insert is not None else source.columns)
    src = _checked(near(source, "upsert_source"), keys, check_unique)

    def dtype(x: str):
        return (target.schema[x] if x in target.columns else source.schema[x]).dataType

    matched = c("h._src").isNotNull()
    kept = interval_join(target, src, at, [
        c(f"e.{x}") if x in keys else
        (F.when(matched, c(f"h.{x}") if x in source.columns else F.lit(None)).otherwise(
            c(f"e.{x}") if x in target.columns else F.lit(None)) if x in update
         else (c(f"e.{x}") if x in target.columns else F.lit(None))).cast(dtype(x)).alias(x)
        for x in cols], keys=by, start=at, end=at, how="left", count_first="intervals", hot_rows=hot_rows)
    there = target.select(*keys).distinct().withColumn("_tgt", F.lit(True))
    new = interval_join(src, there, at, [
        *[(c(f"e.{x}") if x in keys or x in insert else F.lit(None)).cast(dtype(x)).alias(x) for x in cols], c("e._src"), c("h._tgt")],
        keys=by, start=at, end=at, how="left", hot_rows=hot_rows).where(c("_src") & c("_tgt").isNull()).select(*cols)
    return kept, new


def _merge_upsert_broadcast(target: DataFrame, source: DataFrame, keys: Sequence[str],
                            update: Sequence[str] | None, insert: Sequence[str] | None,
                            check_unique: bool) -> DataFrame:
    keys = list(keys)
    cols = list(target.columns) + [x for x in source.columns if x not in target.columns]
    update = [x for x in (update if update is not None else source.columns) if x not in keys]
    insert = list(insert if insert is not None else source.columns)
    src = F.broadcast(_checked(source, keys, check_unique))

    def dtype(x: str):
        return (target.schema[x] if x in target.columns else source.schema[x]).dataType

    kept = target.alias("t").join(src.alias("s"), keys, "left")
    matched = c("s._src").isNotNull()
    kept = kept.select(*[
        c(x) if x in keys else
        (F.when(matched, c(f"s.{x}") if x in source.columns else F.lit(None)).otherwise(
            c(f"t.{x}") if x in target.columns else F.lit(None)) if x in update
         else (c(f"t.{x}") if x in target.columns else F.lit(None))).cast(dtype(x)).alias(x)
        for x in cols])
    # distinct: however often the target repeats a key, at most the source's keys remain
    present = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi").distinct()
    new = src.join(F.broadcast(present), keys, "left_anti")
    new = new.select(*[(c(x) if x in insert or x in keys else F.lit(None)).cast(dtype(x)).alias(x) for x in cols])
    return kept.unionByName(new)


def merge_range_update(target: DataFrame, source: DataFrame, keys: Sequence[str], at: str,
                       start: str, end: str, set_col: str, from_col: str,
                       target_key: Sequence[str], on_multi: str = "error",
                       prefer: Sequence[str] = (), broadcast_bytes: int | None = None,
                       stage: Callable[[DataFrame], DataFrame] | None = None,
                       hot_rows: int = HOT_ITEM_ROWS, near: Near | None = None) -> DataFrame:
    """``MERGE ... ON keys AND target.at BETWEEN source.start AND source.end WHEN MATCHED UPDATE SET set_col``.

    Matches are resolved per target row (``target_key`` identifies it):
    ``on_multi="error"`` fails the job when a target row has several matches,
    ``on_multi="latest"`` takes the match with the greatest ``prefer`` tuple.
    Unmatched target rows keep their value; the target is returned whole.

    With ``broadcast_bytes`` and a source measured within that size, the
    target is split by ``keys`` against the broadcast source keys: rows of
    untouched keys pass through a broadcast anti join, and only rows of
    touched keys are shuffled for the match resolution. ``stage`` writes those
    touched rows once, as the resolution reads them twice. Items with more than
    ``hot_rows`` rows on both sides are matched by time cells (``interval_join``).
    A larger source, and then what it sets, comes to a target stored by ``keys`` with
    ``near``; the target is read twice and does not move.
    """
    if on_multi not in ("error", "latest"):
        raise ValueError(f"on_multi must be 'error' or 'latest', not {on_multi!r}")
    target_key = list(target_key)
    out_cols = list(target.columns) + ([set_col] if set_col not in target.columns else [])
    current = c(set_col) if set_col in target.columns else F.lit(None).cast(source.schema[from_col].dataType)
    if broadcast_bytes is not None and is_bounded(source, broadcast_bytes):
        items = F.broadcast(source.select(*keys).distinct())
        src = F.broadcast(source)
        rest = target.join(items, list(keys), "left_anti").select(
            *[(current.alias(x) if x == set_col else c(x)) for x in out_cols])
        touched = target.join(items, list(keys), "left_semi")
        if stage is not None:
            touched = stage(touched)
        return rest.unionByName(_range_update(touched, src, keys, at, start, end, set_col, from_col,
                                              target_key, on_multi, prefer, out_cols, current, hot_rows))
    in_place = near is not None and target_key == [*keys, at]
    return _range_update(target, near(source, "ranges") if in_place else source, keys, at, start, end, set_col, from_col,
                         target_key, on_multi, prefer, out_cols, current, hot_rows, near if in_place else None)


def _range_update(target, source, keys, at, start, end, set_col, from_col, target_key, on_multi, prefer,
                  out_cols, current, hot_rows, near=None) -> DataFrame:
    needed = list(dict.fromkeys([*target_key, *keys, at]))
    matches = interval_join(target.select(*needed), source, at, [
        *[c(f"e.{k}").alias(k) for k in target_key], c(f"h.{from_col}").alias("_val"),
        F.struct(*[c(f"h.{p}") for p in prefer], c(f"h.{from_col}")).alias("_ord")],
        keys=keys, start=start, end=end, count_first="intervals", hot_rows=hot_rows)
    resolved = matches.groupBy(*target_key).agg(
        F.max_by("_val", "_ord").alias("_val"), F.count(F.lit(1)).alias("_n"))
    if on_multi == "error":
        resolved = resolved.withColumn("_val", F.when(c("_n") > 1, F.raise_error(
            F.lit("MERGE cardinality violation: several source rows match one target row"))).otherwise(c("_val")))
    if near is not None:
        cur = c(f"e.{set_col}") if set_col in target.columns else current
        return interval_join(target, near(resolved, "resolved"), at, [
            F.when(c("h._n").isNotNull(), c("h._val")).otherwise(cur).alias(x) if x == set_col else c(f"e.{x}")
            for x in out_cols], keys=keys, start=at, end=at, how="left", count_first="intervals", hot_rows=hot_rows)
    cur = c(f"t.{set_col}") if set_col in target.columns else current
    joined = target.alias("t").join(resolved.alias("r"), target_key, "left")
    return joined.select(*[
        (F.when(c("r._n").isNotNull(), c("r._val")).otherwise(cur).alias(x) if x == set_col
         else (c(x) if x in target_key else c(f"t.{x}"))) for x in out_cols])
