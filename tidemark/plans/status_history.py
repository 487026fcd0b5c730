"""The subscription-status history job as one composed DataFrame plan.

Stages (each a property, so any intermediate can be inspected or tested):

1. change extraction per source (``tidemark.operators.deltas``);
2. one as-of lookup of all change points against the sales-document history,
   unioned with the versions that start in the window, made distinct;
3. plan interval, billed-before sets, status join, the 16 status rules;
4. reopen the target versions that cover the day before the cutoff;
5. one window pass: reactivation filter, run collapse, linking, closing;
6. enrichment, reason rewrite, and the two merges into the target.

All categories run in one job: the category is a column of the subscription
dimension, not a driver loop. With ``CategoryWindows`` the cutoff is one too: the
scans are bounded by the earliest and latest cutoff as literals, and each row is
held against the cutoff of its own category once its subscription is joined.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import text_to_date
from tidemark.operators import deltas as dl
from tidemark.operators.common import (
    ITEM_KEYS, MAX_BROADCAST_BYTES, VERSION_KEYS, all_of, broadcast_bounded, typed_null)
from tidemark.operators.history import (
    close_intervals, collapse_runs, drop_reactivation, link_versions, one_version_per_start)
from tidemark.operators.intervals import (
    HOT_ITEM_ROWS, SCD_ROW, event_points, interval_join, scd_rows_starting)
from tidemark.operators.merge import Near, merge_range_update, merge_upsert, upsert_near
from tidemark.operators.rules import derive_status, init_inactive_flag, reason_rewrite
from tidemark.params import CategoryWindows, RunDates
from tidemark.sources.tables import drop_stages, stage_by_key, stage_measured, stage_table, write_stage

c = F.col

# Column layout of a status version (target table plus the two run columns).
STATUS_COLS = [
    "client", "sales_document", "sales_document_item", "start_date", "end_date", "sales_document_type",
    "billing_block_header", "billing_block_item", "bp_billing_block", "bp_net_price", "bp_start_date",
    "cancellation_reason", "cancellation_reason_old", "contract_start_date", "contract_end_date",
    "created_date", "reason_for_rejection", "subscription_status", "init_inactive_flag",
    "subscription_quantity", "link_id", "prev_link_id", "subscription_category", "bp_upd_ind",
]
TARGET_COLS = STATUS_COLS[:-2]
FINAL_COLS = TARGET_COLS + ["last_modified"]

# Columns of a change row after the plan-interval join.
PLANNED_COLS = [
    "client", "sales_document", "sales_document_item", "start_date", "end_date",
    "billing_block_header", "billing_block_item", "cancellation_reason", "cancellation_reason_old",
    "reason_for_rejection", "subscription_quantity", "created_date", "bp_no", "bp_item", "bp_start_date",
    "bp_end_date", "bp_billing_block", "bp_net_price", "first_pmt_success_date", "bp_upd_ind",
]


@dataclass(frozen=True)
class HistorySources:
    dim: DataFrame          # subscription dimension
    params: DataFrame       # parameter table (trial offers)
    plans: DataFrame        # billing plan items
    bill_item: DataFrame    # billing document items
    bill_hdr: DataFrame     # billing document headers
    order_line: DataFrame   # sales order items
    order_hdr: DataFrame    # sales order headers
    business: DataFrame     # sales document business data
    scd: DataFrame          # sales-document history (closed intervals)
    target: DataFrame       # status history merged into
    dim_by_plan: DataFrame | None = None  # the dimension stored by plan number, if there is such a copy

    def stored_by_key(self, prefix: str, buckets: int) -> "HistorySources":
        """The sources as tables ``<prefix>_<name>``, bucketed by the keys that the job joins them on.

        A change frame beyond the broadcast bound is then shuffled to the buckets of a table, and the table is read in
        place. The dimension is joined on two keys and stored twice.
        """
        spark = self.spark
        keys = {"dim": ITEM_KEYS, "dim_by_plan": ["bill_plan_number"], "plans": ["bp_no"], "scd": ITEM_KEYS,
                "target": ITEM_KEYS, "bill_item": ["mandt", "bp_no", "bp_item"], "bill_hdr": ["mandt", "vbeln"],
                "order_hdr": ["mandt", "vbeln"], "order_line": ["mandt", "vbeln", "posnr"],
                "business": ["mandt", "vbeln", "posnr"]}
        for name, columns in keys.items():
            frame = self.dim if name == "dim_by_plan" else getattr(self, name)
            write_stage(frame, f"{prefix}_{name}", keys=columns, buckets=buckets)
        return replace(self, **{name: spark.table(f"{prefix}_{name}") for name in keys})

    @classmethod
    def from_fixtures(cls, fx) -> "HistorySources":
        """The fixture views, each built when it is first read: a query pays for the tables that it needs."""
        src = object.__new__(cls)
        object.__setattr__(src, "_fixtures", fx)
        return src

    def __getattr__(self, name: str) -> DataFrame:
        fx = self.__dict__.get("_fixtures")
        if fx is None or name not in FIXTURE_OF:
            raise AttributeError(name)
        object.__setattr__(self, name, getattr(fx, FIXTURE_OF[name]))
        return self.__dict__[name]

    @property
    def buckets(self) -> int | None:
        """Buckets by item in which the dimension and both histories are stored (the fixtures), or None."""
        fx = self.__dict__.get("_fixtures")
        return fx.buckets if fx is not None and fx.stage else None

    @property
    def spark(self) -> SparkSession:
        fx = self.__dict__.get("_fixtures")
        return self.dim.sparkSession if fx is None else fx.spark


# Source -> fixture view.
FIXTURE_OF = {**{x: x for x in ("dim", "params", "plans", "bill_item", "bill_hdr", "order_line", "order_hdr", "business")},
              "scd": "hist", "target": "status_hist"}


class StatusHistoryJob:
    """The history job over ``src`` for the window ``rd``, or for a window per category (``CategoryWindows``).

    With windows per category an item belongs to one category, and categories without a cutoff are not part of the run.

    ``materialize`` decides what happens at the stage boundaries where a small
    change frame feeds several consumers (plan items, change versions, planned
    rows, status rows, final rows): ``"stage"`` (default) writes it as parquet
    to the session's checkpoint folder (``spark.checkpoint.dir``) and reads it
    back, cutting lineage so downstream plans stay small and a lost executor
    costs one stage, not the whole job; ``"persist"`` caches it; ``None`` keeps
    one fused plan.

    With ``"stage"``, change frames that meet a full-size table (plan delta,
    change points, changed items, rebuilt versions, merge source) are also
    measured on their staged files and broadcast when within
    ``MAX_BROADCAST_BYTES``, so the full-size side is streamed instead of
    shuffled; beyond the bound Spark and AQE choose the join.
    """

    def __init__(self, src: HistorySources, rd: RunDates | CategoryWindows, categories: list[str] | None = None,
                 on_multi_plan: str = "latest", materialize: str | None = "stage", hot_rows: int = HOT_ITEM_ROWS):
        self.src = src
        self.windows = rd if isinstance(rd, CategoryWindows) else None
        # literal bounds of the scans; and of the rows, once they know their subscription
        self.rd = rd.earliest if self.windows else rd
        self.own = rd.row() if self.windows else rd
        self.categories = categories
        self.on_multi_plan = on_multi_plan
        self.materialize = materialize
        self.hot_rows = hot_rows
        self._run_id = f"run-{self.rd.cutoff_text}-{self.rd.today_text}-{uuid.uuid4().hex[:12]}"
        self._staged: dict[str, DataFrame] = {}
        self._sizes: dict[str, int] = {}
        self._kept: dict[str, object] = {}

    @property
    def _broadcast_bytes(self) -> int | None:
        return MAX_BROADCAST_BYTES if self.materialize == "stage" else None

    @property
    def _near(self) -> Near | None:
        """Where the target is stored by item: stores rows in the same way, once per name."""
        if self.materialize != "stage" or not self.src.buckets:
            return None
        return lambda rows, name: self.kept(name, lambda: self.by_item(rows, name))

    def near_items(self, df: DataFrame) -> DataFrame:
        """Rows that are not broadcast, dealt as tables stored by item are: a join on the item then moves them alone."""
        return df.repartition(self.src.buckets, *ITEM_KEYS) if self.src.buckets else df

    def _small(self, df: DataFrame, name: str, near: bool = False) -> DataFrame:
        """Stage a change frame (once per name) and broadcast it when its size is within the bound (else, with ``near``, ``near_items``)."""
        if self.materialize != "stage":
            return df
        if name not in self._staged:
            rows, size = stage_measured(df, f"{self._run_id}/{name}")
            self._staged[name] = F.broadcast(rows) if size <= MAX_BROADCAST_BYTES else self.near_items(rows) if near else rows
        return self._staged[name]

    def _bounded(self, name: str) -> bool:
        return self._sizes.get(name, MAX_BROADCAST_BYTES + 1) <= MAX_BROADCAST_BYTES

    def _bc(self, df: DataFrame, name: str, near: bool = False) -> DataFrame:
        """Broadcast an already staged change frame if its size, measured as it was written, is within the bound."""
        return F.broadcast(df) if self._bounded(name) else self.near_items(df) if near else df

    def _together(self, *names: str) -> None:
        """Compute stages that do not depend on each other at the same time: each is a few small jobs."""
        if self.materialize == "stage":
            spark = self.src.spark
            with ThreadPoolExecutor(len(names)) as pool:
                list(pool.map(inheritable_thread_target(spark)(lambda name: getattr(self, name)), names))

    def kept(self, name: str, make: Callable[[], object]):
        """What ``make`` builds over this run's stages, built once."""
        if name not in self._kept:
            self._kept[name] = make()
        return self._kept[name]

    def part(self, df: DataFrame, name: str) -> DataFrame:
        """A stage of this run, as it is."""
        return stage_table(df, f"{self._run_id}/{name}")

    def drop_parts(self, *names: str) -> None:
        for name in names:
            drop_stages(self.src.spark, f"{self._run_id}/{name}")

    def by_item(self, df: DataFrame, name: str) -> DataFrame:
        """A stage of this run stored as the tables stored by item are (a plain one without such tables)."""
        if self.src.buckets is None:
            return self.part(df, name)
        return stage_by_key(df, f"{self._run_id}/{name}", ITEM_KEYS, self.src.buckets)

    def drop_stages(self) -> None:
        """Remove this run's stage tables, once nothing reads its frames any more."""
        drop_stages(self.src.spark, self._run_id)

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        if self.materialize == "stage":
            rows, self._sizes[name] = stage_measured(df, f"{self._run_id}/{name}")
            return rows
        if self.materialize == "persist":
            return df.persist()
        return df

    # ---- 1. change extraction -------------------------------------------------
    @cached_property
    def subs(self) -> DataFrame:
        return self._subs(self.src.dim)

    def _subs(self, dim: DataFrame) -> DataFrame:
        return self._with_cutoff(dl.with_trial_flag(dl.subscriptions(dim, self.categories), self.src.params))

    def _with_cutoff(self, rows: DataFrame) -> DataFrame:
        """With windows per category: the rows of their categories, with the cutoff (the frame is broadcast if small)."""
        if self.windows is None:
            return rows
        return rows.join(broadcast_bounded(self.windows.cutoffs), "subscription_category").select(*rows.columns, "cutoff_date")

    @cached_property
    def plan_delta(self) -> DataFrame:
        return dl.plan_delta(self.src.plans, self.rd, last=self.windows and self.windows.latest)

    @cached_property
    def plan_items(self) -> DataFrame:
        """Plan items of the window with their subscription.

        The plan delta grows with the window, not with the plan table; staged
        and bounded, it is broadcast, so the subscription dimension is streamed
        instead of shuffled.
        """
        by_plan = self.subs if self.src.dim_by_plan is None else self._subs(self.src.dim_by_plan)
        return self._cut(dl.plan_items(self._small(self.plan_delta, "plan_delta"), by_plan,
                                       self.own if self.windows else None), "plan_items")

    @cached_property
    def plans_starting(self) -> DataFrame:
        return dl.plans_starting(self.plan_items, self.own)

    @cached_property
    def plans_ending(self) -> DataFrame:
        return dl.plans_ending(self.plan_items, self.own)

    @cached_property
    def bill_docs(self) -> DataFrame:
        return self._cut(dl.bill_docs(self.src.bill_item, self.src.bill_hdr, self._bc(self.plan_items, "plan_items"),
                                      self._small), "bill_docs")

    @cached_property
    def bill_docs_sibling(self) -> DataFrame:
        return self._cut(dl.bill_docs_sibling(self.src.bill_item, self.src.bill_hdr,
                                              self._bc(self.plan_items, "plan_items"), self._small), "bill_docs_sibling")

    @cached_property
    def bill_docs_cancelled(self) -> DataFrame:
        return self._cut(dl.bill_docs_cancelled(self.src.bill_item, self.src.bill_hdr, self.src.scd, self.subs, self.rd,
                                                self._small), "bill_docs_cancelled")

    @cached_property
    def credit_memos(self) -> DataFrame:
        return self._cut(dl.credit_memos(self.src.bill_item, self.src.bill_hdr, self.src.order_line, self.src.order_hdr,
                                         self.subs, self.rd, self._small), "credit_memos")

    @cached_property
    def contract_starts(self) -> DataFrame:
        # the literal bound reaches the scan; a row's own cutoff is a column of the joined windows
        bounded = self.subs.where(c("contract_start_date_bp") >= F.lit(self.rd.cutoff)) if self.windows else self.subs
        return dl.contract_starts(bounded, self.own)

    # ---- 2. versions at the change points -----------------------------------
    def change_points(self) -> dict[str, DataFrame]:
        """Every change source reduced to ``(item keys, at_date)``."""
        self.subs, self.plan_items  # noqa: B018 - what the others start from
        self._together("bill_docs", "bill_docs_sibling", "bill_docs_cancelled", "credit_memos")
        window = (c("created_date") >= self.own.cutoff_text) & (c("created_date") <= self.own.today_text)
        return {
            "contract_start": event_points(self.contract_starts, "contract_start_date"),
            "plan_start": event_points(self.plans_starting, text_to_date("bp_start_date")),
            "plan_end": event_points(self.plans_ending, "event_date"),
            "cancelled_bill": event_points(self.bill_docs_cancelled, text_to_date("created_date")),
            "credit_memo": event_points(self.credit_memos, "created_date_yyyy_mm_dd"),
            "bill": event_points(self.bill_docs.where(window), text_to_date("created_date")),
            "sibling_bill": event_points(self.bill_docs_sibling.where(window), text_to_date("created_date")),
        }

    def versions_at(self, points: DataFrame) -> DataFrame:
        """Sales-document version valid at each point, re-dated to the point (12 columns).

        Points that are not broadcast are best passed through ``near_items``, so that the history stays in place.
        """
        return interval_join(points, self.src.scd, "at_date", [
            *[c(f"h.{k}") for k in ITEM_KEYS], c("e.at_date").alias("start_date"), *[c(f"h.{a}") for a in SCD_ROW[4:]]],
            hot_rows=self.hot_rows)

    @cached_property
    def scd_starts(self) -> DataFrame:
        return scd_rows_starting(self.src.scd, self.subs, self.rd.cutoff, self.rd.today)

    @cached_property
    def delta_versions(self) -> DataFrame:
        """Distinct change versions: one as-of join for all change points (deduplicated first)."""
        self.src.scd  # noqa: B018 - the widest table is stored first, while there is little else
        pts = list(self.change_points().values())
        points = pts[0]
        for p in pts[1:]:
            points = points.unionByName(p)
        # the points grow with the window, the history with all time: broadcast the points when bounded,
        # so the history is streamed through the as-of join instead of shuffled
        points = self._small(points.distinct(), "change_points", near=True)
        return self._cut(self.scd_starts.unionByName(self.versions_at(points)).distinct(), "delta_versions")

    # ---- 3. plans, bills, status --------------------------------------------
    @cached_property
    def with_plans(self) -> DataFrame:
        """Change versions left-joined to the plan item whose text interval holds the start date."""
        v = self.delta_versions.withColumn("end_date", typed_null("date")).withColumn(
            "_start_text", F.date_format("start_date", "yyyyMMdd"))
        return self._cut(interval_join(v, self.plan_items, "_start_text", [
            c(f"h.{x}") if x.startswith("bp_") else c(f"e.{x}") for x in PLANNED_COLS],
            start="bp_start_date", end="bp_end_date", how="left", hot_rows=self.hot_rows), "with_plans")

    @cached_property
    def billed_before(self) -> DataFrame:
        """Versions with an invoice of the same plan item created on or before their start."""
        t = self.with_plans.alias("t")
        b = self.bill_docs.alias("b")
        cond = all_of([c(f"t.{k}") == c(f"b.{k}") for k in ITEM_KEYS + ["bp_no", "bp_item"]]
                      + [text_to_date(c("b.created_date")) <= c("t.start_date")])
        return t.join(b, cond, "left_semi").select(*[c(f"t.{k}") for k in VERSION_KEYS]).distinct()

    @cached_property
    def sibling_billed_before(self) -> DataFrame:
        """Versions with a sibling-item invoice of the same plan, ended and created on or before them."""
        t = self.with_plans.alias("t")
        b = self.bill_docs_sibling.alias("b")
        cond = all_of([c(f"t.{k}") == c(f"b.{k}") for k in ITEM_KEYS + ["bp_no"]]
                      + [c("b.bp_end_date") <= c("t.bp_end_date"),
                         text_to_date(c("b.created_date")) <= c("t.start_date")])
        return t.join(b, cond, "left_semi").select(*[c(f"t.{k}") for k in VERSION_KEYS]).distinct()

    @cached_property
    def status_input(self) -> DataFrame:
        """Change versions with subscription, order header, memo and billed-before facts.

        The planned rows are broadcast (when bounded) into the inner joins with
        the subscription dimension and the order headers, which are streamed.
        """
        planned = self._bc(self.with_plans, "with_plans", near=True)
        t = planned.alias("t")
        d = self.subs.alias("d")
        # the order headers of the planned rows only: the full table is streamed past their keys
        v = self.src.order_hdr.join(planned.select(c("client").alias("mandt"), c("sales_document").alias("vbeln")).distinct(),
                                    ["mandt", "vbeln"], "left_semi").alias("v")
        m = self.credit_memos.select(
            *ITEM_KEYS, c("created_date_yyyy_mm_dd"), c("order_reason")).distinct().alias("m")
        b = self.billed_before.alias("b")
        b2 = self.sibling_billed_before.alias("b2")
        keys = all_of([c(f"t.{k}") == c(f"d.{k}") for k in ITEM_KEYS])
        return (
            t.join(d, keys, "inner")
            .join(v, (c("t.client") == c("v.mandt")) & (c("t.sales_document") == c("v.vbeln")), "inner")
            .join(m, all_of([c(f"t.{k}") == c(f"m.{k}") for k in ITEM_KEYS]
                            + [c("t.start_date") == c("m.created_date_yyyy_mm_dd")]), "left")
            .join(b, all_of([c(f"t.{k}") == c(f"b.{k}") for k in VERSION_KEYS]), "left")
            .join(b2, all_of([c(f"t.{k}") == c(f"b2.{k}") for k in VERSION_KEYS]), "left")
            .select(
                *[c(f"t.{x}") for x in PLANNED_COLS],
                c("d.sales_document_type"), c("d.contract_start_date_bp"), c("d.contract_end_date_bp"),
                c("d.payment_method"), c("d.billing_frequency"), c("d.subscription_category"),
                c("d.trial_order_flag"), c("v.order_reason"),
                c("m.sales_document").alias("memo_doc"), c("m.order_reason").alias("memo_reason"),
                c("b.sales_document").alias("billed_doc"), c("b2.sales_document").alias("billed2_doc"),
                text_to_date(c("t.bp_start_date")).alias("bp_start"),
            )
        )

    @cached_property
    def status_rows(self) -> DataFrame:
        """Rule-derived status versions in the target layout (plus category, plan update flag), distinct."""
        s = derive_status(self.status_input)
        s = init_inactive_flag(s)
        link = F.concat(*[c(k).cast("string") for k in VERSION_KEYS])
        s = s.select(
            "client", "sales_document", "sales_document_item", "start_date", typed_null("date").alias("end_date"),
            "sales_document_type", "billing_block_header", "billing_block_item", "bp_billing_block",
            "bp_net_price", c("bp_start").alias("bp_start_date"), "cancellation_reason",
            "cancellation_reason_old", c("contract_start_date_bp").alias("contract_start_date"),
            c("contract_end_date_bp").alias("contract_end_date"), "created_date", "reason_for_rejection",
            "subscription_status", "init_inactive_flag", "subscription_quantity", link.alias("link_id"),
            typed_null("string").alias("prev_link_id"), "subscription_category", "bp_upd_ind",
        ).distinct()
        return self._cut(s, "status_rows")

    # ---- 4. reopen ----------------------------------------------------------
    @cached_property
    def reopened(self) -> DataFrame:
        """Target versions covering the day before the cutoff, for items that changed.

        One row per changed item is built first (category and the greatest plan
        update flag), so the join cannot repeat a reopened version.
        """
        changed = self.status_rows.groupBy(*ITEM_KEYS).agg(
            F.max("subscription_category").alias("subscription_category"), F.max("bp_upd_ind").alias("bp_upd_ind"))
        changed = self._small(changed, "changed_items", near=True)   # the target history is streamed, not shuffled
        cut = F.lit(self.rd.cutoff_scd)
        last = F.lit(self.windows.latest.cutoff_scd) if self.windows else cut
        open_rows = self.src.target.where((c("start_date") <= last) & (c("end_date") >= cut))
        rows = open_rows.select(*TARGET_COLS).join(changed, ITEM_KEYS, "inner")
        if self.windows:
            own = self.windows.row()
            rows = self._with_cutoff(rows).where((c("start_date") <= own.cutoff_scd) & (c("end_date") >= own.cutoff_scd))
        return rows.select(*STATUS_COLS)

    @cached_property
    def union_reopened(self) -> DataFrame:
        return self.status_rows.unionByName(self.reopened)

    # ---- 5. one window pass ---------------------------------------------------
    @cached_property
    def versions(self) -> DataFrame:
        """Reactivation noise dropped, runs collapsed, versions linked and closed."""
        v = one_version_per_start(self.union_reopened)
        v = drop_reactivation(v)
        v = collapse_runs(v)
        v = link_versions(v)
        return close_intervals(v)

    # ---- 6. enrichment and merges ---------------------------------------------
    @cached_property
    def enriched(self) -> DataFrame:
        """Rebuilt versions with route to market and incoterm.

        The versions are few: broadcast, they stream the dimension, and the business data is reduced to their keys
        before the left join, so neither full-size table is shuffled.
        """
        versions = self._small(self.versions, "versions", near=True)
        v = versions.alias("v")
        d = self.src.dim.select(*ITEM_KEYS, "route_to_market").alias("d")
        keys = versions.select(c("client").alias("mandt"), c("sales_document").alias("vbeln"),
                               c("sales_document_item").alias("posnr")).distinct()
        k = self.src.business.select("mandt", "vbeln", "posnr", "inco3_l").join(
            keys, ["mandt", "vbeln", "posnr"], "left_semi").alias("k")
        return v.join(d, all_of([c(f"v.{x}") == c(f"d.{x}") for x in ITEM_KEYS]), "inner").join(
            k, (c("k.mandt") == c("v.client")) & (c("k.vbeln") == c("v.sales_document"))
            & (c("k.posnr") == c("v.sales_document_item")), "left").select(
            *[c(f"v.{x}") for x in STATUS_COLS], c("d.route_to_market"), c("k.inco3_l"))

    @cached_property
    def final_rows(self) -> DataFrame:
        return self._cut(
            reason_rewrite(self.enriched).withColumn("last_modified", F.lit(self.rd.today).cast("timestamp_ntz")).select(*FINAL_COLS),
            "final_rows")

    @cached_property
    def merged(self) -> DataFrame:
        """Target after the upsert on (item keys, start_date)."""
        return reduce(DataFrame.unionByName, self.merged_parts)

    @cached_property
    def merged_parts(self) -> list[DataFrame]:
        """``merged``, with a source beyond the broadcast bound as its updated and kept rows and its inserted ones."""
        source, near = self.final_rows, self._near
        if near is not None and not self._bounded("final_rows"):
            return list(upsert_near(self.src.target, source, VERSION_KEYS, FINAL_COLS[4:], FINAL_COLS, True, near, self.hot_rows))
        return [merge_upsert(self.src.target, source, VERSION_KEYS,
                             update=FINAL_COLS[4:], insert=FINAL_COLS, broadcast_bytes=self._broadcast_bytes)]

    @cached_property
    def plan_ranges(self) -> DataFrame:
        """Billing plans of the window on the run's subscriptions, with date-typed bounds.

        A run for some categories rewrites the flags of those alone; other cutoffs have their own window.
        """
        p = self._small(self.plan_delta, "plan_delta").drop("client").alias("p")
        dim = self.src.dim if self.categories is None else self.src.dim.where(
            c("subscription_category").isin(list(self.categories)))
        d = self._with_cutoff(dim).alias("d")
        rows = p.join(d, c("p.bp_no") == c("d.bill_plan_number"), "inner")
        if self.windows:
            rows = rows.where(dl.touches_window(self.windows.row()))
        return self._cut(rows.select(
            *[c(f"d.{k}") for k in ITEM_KEYS], c("p.bp_no"), c("p.bp_item"),
            text_to_date(c("p.bp_start_date")).alias("bp_start_date"),
            text_to_date(c("p.bp_end_date")).alias("bp_end_date"), c("p.bp_upd_ind")), "plan_ranges")

    @cached_property
    def merged_with_plan_flag(self) -> DataFrame:
        """Second merge: ``upd_ind`` from the plan whose interval holds the version start."""
        parts, source, near = self.merged_parts, self.plan_ranges, self._near
        if self.materialize == "stage" and near is None and not self._bounded("plan_ranges"):
            parts = [self._cut(self.merged, "merged")]    # the resolution reads it twice: the upsert is done once
        return reduce(DataFrame.unionByName, [merge_range_update(
            target, source, keys=ITEM_KEYS, at="start_date", start="bp_start_date",
            end="bp_end_date", set_col="upd_ind", from_col="bp_upd_ind", target_key=VERSION_KEYS,
            on_multi=self.on_multi_plan, prefer=["bp_start_date", "bp_item", "bp_no"],
            stage=(lambda rows, name=f"touched_{k}": self._cut(rows, name)) if self.materialize == "stage" else None,
            broadcast_bytes=self._broadcast_bytes, hot_rows=self.hot_rows,
            near=near and (lambda rows, name, k=k: near(rows, name if name == "ranges" else f"{name}_{k}")))
            for k, target in enumerate(parts)])
