"""Registered queries: one per operator of the inventory, over the fixture views.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the DuckDB oracle of the same key in ``tidemark.oracle``.
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_to_text, text_to_date
from tidemark.functions.predicates import absent, present
from tidemark.operators import deltas as dl
from tidemark.operators import governance as gov
from tidemark.operators import history as hs
from tidemark.operators import inventory as inv
from tidemark.operators.common import ITEM_KEYS, VERSION_KEYS
from tidemark.operators.intervals import interval_join
from tidemark.operators.neighbors import by_key_size
from tidemark.operators.rules import derive_status, init_inactive_flag
from tidemark.params import CategoryWindows, RunDates, RunParams, cutoff_lookup, run_dates_frame
from tidemark.plans.status_history import HistorySources, StatusHistoryJob
from tidemark.sources.fixtures import BASE_TABLES, Fixtures
from tidemark.sources.tables import split_points, split_predicates

c = F.col

FIXTURE_DATES = RunDates(cutoff=_dt.date(1998, 6, 1), today=_dt.date(1998, 6, 30))
FIXTURE_PARAMS = RunParams(as_of=_dt.date(1998, 6, 30), days_back=3, default_start=_dt.date(1998, 1, 1))
# Keys with more rows than this are cut into segments of half as many rows in whole-history window queries (same result).
HOT_ROWS = 1_000_000

SCHEMA_OF = {**{t: "tpch" for t in "region nation customer supplier part orders lineitem".split()},
             "events": "events",
             **{t: "corpus" for t in "documents embeddings pages benchmark labels conversations".split()}}


# The job of a session and folder is built once for a state of its files: its staged frames feed all queries that read
# them. When the files change, the old job and its stages go.
_JOBS: dict[tuple[str, str], tuple[str, StatusHistoryJob]] = {}
_LOCK = threading.RLock()


def _job(spark: SparkSession, sf_dir: str) -> StatusHistoryJob:
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        fx = Fixtures(spark, sf_dir)
        if key in _JOBS and _JOBS[key][0] != fx.version:
            _JOBS.pop(key)[1].drop_stages()
        if key not in _JOBS:
            _JOBS[key] = fx.version, StatusHistoryJob(HistorySources.from_fixtures(fx), FIXTURE_DATES)
        return _JOBS[key][1]


def forget_jobs() -> None:
    """Let the next query build its job anew (its stages are then computed again)."""
    with _LOCK:
        _JOBS.clear()


def _fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)


def _stage(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        with _LOCK:
            return getattr(_job(spark, sf_dir), name)
    return q


def _lookup(source: str, at, window: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        job = _job(spark, sf_dir)
        frame = getattr(job, source)
        if window:
            frame = frame.where(c("created_date").between(FIXTURE_DATES.cutoff_text, FIXTURE_DATES.today_text))
        at_col = at() if callable(at) else c(at)
        return job.versions_at(job.near_items(frame.select(*ITEM_KEYS, at_col.alias("at_date"))))
    return q


# ---- sources, projections, filters ----------------------------------------------

def q_scan_table(spark, sf_dir):
    return _fx(spark, sf_dir).orders


def q_project_mixed(spark, sf_dir):
    o = _fx(spark, sf_dir).orders
    return o.select("o_orderkey", o["o_custkey"], c("o_orderstatus"), "o_orderdate", "o_totalprice").withColumns({
        "order_day": F.to_date("o_orderdate"), "order_day_text": date_to_text("o_orderdate"),
    }).select("o_orderkey", "o_custkey", "o_orderstatus", "order_day", "order_day_text", "o_totalprice")


def q_rename_cols(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    p = dl.plan_delta(fx.plans, FIXTURE_DATES)
    j = p.join(fx.dim, p["bp_no"] == fx.dim["bill_plan_number"]).drop(p["client"])
    return j.select("client", "sales_document", "bp_no", "bp_item", "bp_start_date", "contract_start_date_bp") \
        .withColumnsRenamed({"bp_start_date": "bp_start", "contract_start_date_bp": "contract_start_date"})


def q_typed_null(spark, sf_dir):
    return _job(spark, sf_dir).delta_versions.withColumn("end_date", F.lit(None).cast("string"))


def q_jdbc_like_category_filter(spark, sf_dir):
    return dl.category_filter(_fx(spark, sf_dir).dim, "building")


def q_distinct_category(spark, sf_dir):
    return dl.distinct_categories(_fx(spark, sf_dir).dim)


def q_filter_conj(spark, sf_dir):
    return dl.subscriptions(_fx(spark, sf_dir).dim, ["BUILDING"])


def q_cutoff_lookup(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return cutoff_lookup(dl.distinct_categories(fx.dim), fx.cutoff_log, FIXTURE_PARAMS)


def q_run_dates(spark, sf_dir):
    return run_dates_frame(q_cutoff_lookup(spark, sf_dir), FIXTURE_PARAMS.as_of)


def q_date_roundtrip(spark, sf_dir):
    p = _fx(spark, sf_dir).plans
    d = text_to_date("ofkdat")
    return p.select("bp_no", "bp_item", "ofkdat", d.alias("ofk_date"), F.date_add(d, 1).alias("ofk_next"),
                    F.date_sub(d, 1).alias("ofk_prev"), date_to_text(F.date_sub(d, 1)).alias("ofk_prev_text"),
                    text_to_date("fkdat").alias("fk_date"))


def q_filter_codes(spark, sf_dir):
    return dl.cancel_reason_docs(_fx(spark, sf_dir).hist)


def q_blank_predicates(spark, sf_dir):
    h = _fx(spark, sf_dir).hist
    return h.select(*VERSION_KEYS, present("billing_block_header").alias("header_block_present"),
                    absent("billing_block_item").alias("item_block_absent"),
                    absent("first_pmt_success_date").alias("first_payment_absent"),
                    c("reason_for_rejection").isNull().alias("rejection_is_null"))


def q_as_of_snapshot(spark, sf_dir):
    h = _fx(spark, sf_dir).hist
    return h.where(F.lit(FIXTURE_DATES.cutoff_scd).between(c("start_date"), c("end_date")))


def q_text_date_window(spark, sf_dir):
    b = _fx(spark, sf_dir).bill_item
    return b.where(c("created_date").between(FIXTURE_DATES.cutoff_text, FIXTURE_DATES.today_text))


def q_self_alias_join(spark, sf_dir):
    """The change rows checked twice against one frame under two aliases (same item / same plan end)."""
    job = _job(spark, sf_dir)
    t = job.with_plans
    b = job.bill_docs_cancelled.withColumn("_created", text_to_date("created_date"))
    same_item = b.select(*ITEM_KEYS, "bp_no", "bp_item", c("_created").alias("start_date")).distinct() \
        .withColumn("billed_same_item", F.lit(True)).alias("a")
    same_end = b.select(*ITEM_KEYS, "bp_no", "bp_end_date", c("_created").alias("start_date")).distinct() \
        .withColumn("billed_same_end", F.lit(True)).alias("b2")
    tt = t.alias("t")
    j = tt.join(same_item, [c(f"t.{k}") == c(f"a.{k}") for k in ITEM_KEYS + ["bp_no", "bp_item", "start_date"]], "left")
    j = j.join(same_end, [c(f"t.{k}") == c(f"b2.{k}") for k in ITEM_KEYS + ["bp_no", "bp_end_date", "start_date"]], "left")
    return j.select(*[c(f"t.{k}") for k in VERSION_KEYS], c("t.bp_no"), c("t.bp_item"),
                    F.coalesce(c("a.billed_same_item"), F.lit(False)).alias("billed_same_item"),
                    F.coalesce(c("b2.billed_same_end"), F.lit(False)).alias("billed_same_end"))


# ---- rules on the fixture status input -----------------------------------------------

def _rule_facts(job: StatusHistoryJob) -> dict[str, DataFrame]:
    """What the rules read besides history and dimension, stored by item: order reasons, first bills, plans, memos.

    Each is narrow and moved in a job of its own, whose shuffle files go with it. The facts name a document, or document
    and item; the items of the dimension give them the whole key (rows repeat no more than there).
    """
    fx, doc = job.src, ["sales_document", "sales_document_item"]
    items = fx.dim.select(*ITEM_KEYS).distinct()
    reasons = fx.order_hdr.select(c("mandt").alias("client"), c("vbeln").alias("sales_document"), "order_reason")
    first_bill = fx.bill_item.groupBy(*doc).agg(F.min("created_date").alias("_first_bill"))
    plans = dl.plan_delta(fx.plans, FIXTURE_DATES).select(
        "client", c("bp_no").alias("sales_document"), "bp_no", "bp_item", c("bp_start_date").alias("_from"),
        c("bp_end_date").alias("_to"), "bp_billing_block", "bp_net_price", "bp_upd_ind")
    facts = {"reasons": job.by_item(items.join(reasons, ["client", "sales_document"]).distinct(), "rule_reasons"),
             "first_bill": job.by_item(items.join(first_bill, doc), "rule_first_bill"),
             "plans": job.by_item(items.join(plans, ["client", "sales_document"]), "rule_plans")}
    memo_docs = fx.bill_hdr.where(c("fkart") == dl.CREDIT_MEMO).select("mandt", c("vbeln").alias("billing_document"))
    origin = fx.order_line.select("mandt", c("vbeln").alias("sales_document"), c("posnr").alias("sales_document_item"),
                                  "vgbel", "vgpos")
    memo_reasons = fx.order_hdr.select("mandt", c("vbeln").alias("sales_document"), c("order_reason").alias("memo_reason"))
    memos = job.part(fx.bill_item.join(memo_docs, ["mandt", "billing_document"], "left_semi").select(
        "mandt", *doc, c("created_date").alias("_memo_day")).distinct(), "rule_memo_items")
    memos = job.part(memos.join(origin, ["mandt", *doc]).join(memo_reasons, ["mandt", "sales_document"]).select(
        c("mandt").alias("client"), c("vgbel").alias("sales_document"), c("vgpos").alias("sales_document_item"),
        "memo_reason", "_memo_day").distinct(), "rule_memo_origins")
    memos = memos.join(items, ITEM_KEYS, "left_semi").drop("client").distinct()
    facts["memos"] = job.by_item(items.join(memos, doc).withColumn("memo_doc", c("sales_document")), "rule_memos")
    job.drop_parts("rule_memo_items", "rule_memo_origins")
    return facts


def _fixture_status_input(spark, sf_dir) -> DataFrame:
    """The whole history with the facts the rules read: plans, memos, invoices, order headers, trial offers.

    Built with DataFrame operators; the oracle states the same relation in SQL of its own. History, dimension and facts are
    stored by item, so the wide rows stay where they are, through the joins and the distinct.
    """
    fx, job = _fx(spark, sf_dir), _job(spark, sf_dir)
    hist = fx.hist      # the widest table is stored first, while there is little else
    with _LOCK:
        facts = job.kept("rule_facts", lambda: _rule_facts(job))
    own = dl.with_trial_flag(fx.dim, fx.params).select(
        *ITEM_KEYS, "contract_start_date_bp", "contract_end_date_bp", "payment_method", "billing_frequency",
        "subscription_category", "trial_order_flag")
    v = (hist.withColumn("_day", date_to_text("start_date")).join(own, ITEM_KEYS).join(facts["reasons"], ITEM_KEYS)
         .join(facts["first_bill"], ITEM_KEYS, "left"))
    planned = interval_join(v, facts["plans"], "_day", [
        c("e.*"), c("h.bp_no"), c("h.bp_item"), c("h.bp_billing_block"), c("h.bp_net_price"), c("h.bp_upd_ind"),
        text_to_date(c("h._from")).alias("bp_start")], start="_from", end="_to", how="left", count_first="intervals")
    rows = interval_join(planned, facts["memos"], "_day", [c("e.*"), c("h.memo_reason"), c("h.memo_doc")],
                         start="_memo_day", end="_memo_day", how="left", count_first="intervals")
    billed = (c("_first_bill") <= c("_day"))
    return rows.withColumn("billed_doc", F.when(billed, c("sales_document"))).drop("_day", "_first_bill").distinct()


def q_status_rules(spark, sf_dir):
    s = derive_status(_fixture_status_input(spark, sf_dir))
    return s.select(*VERSION_KEYS, "bp_no", "bp_item", "subscription_status", "status_rule")


def q_init_inactive_flag(spark, sf_dir):
    s = init_inactive_flag(derive_status(_fixture_status_input(spark, sf_dir)))
    return s.select(*VERSION_KEYS, "bp_no", "bp_item", "subscription_status", "init_inactive_flag")


# ---- windows on the sales-document history ---------------------------------------------

def _link(df: DataFrame) -> DataFrame:
    return df.withColumn("link_id", F.concat(*[c(k).cast("string") for k in VERSION_KEYS]))


def _versions(steps, keys=ITEM_KEYS):
    """A chain of window steps over a whole history, split for hot keys where there are any."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        fx = _fx(spark, sf_dir)
        if keys is ITEM_KEYS:
            return by_key_size(fx.hist, keys, HOT_ROWS, steps)
        return by_key_size(fx.user_hist, keys, HOT_ROWS, steps, order="start_ts")
    return q


q_lag_status = _versions(lambda d, split: hs.lag_status(d, split=split))
q_drop_reactivation = _versions(lambda d, split: hs.drop_reactivation(d, split=split))
q_collapse_runs = _versions(lambda d, split: hs.collapse_runs(d, split=split))
q_link_versions = _versions(lambda d, split: hs.link_versions(_link(hs.collapse_runs(d, split=split)), split=split))
q_close_intervals = _versions(lambda d, split: hs.close_intervals(hs.collapse_runs(d, split=split), split=split))
q_close_intervals_observed = _versions(lambda d, split: hs.close_intervals_observed(
    _link(hs.collapse_runs(d, split=split)).withColumn("prev_link_id", F.lit(None).cast("string")), split=split))


def _user_intervals(d: DataFrame, split: str | None) -> DataFrame:
    key = dict(keys=["user_id"], order=["start_ts"], split=split)
    return hs.close_intervals(hs.collapse_runs(d, status="status", **key), start="start_ts", end="end_ts", **key)


q_user_status_intervals = _versions(_user_intervals, keys=["user_id"])


def q_reason_rewrite(spark, sf_dir):
    return _job(spark, sf_dir).final_rows


def _cutoff_job(spark, sf_dir) -> StatusHistoryJob:
    """One job whose categories have the cutoffs of the log: three different ones."""
    windows = CategoryWindows.of(q_cutoff_lookup(spark, sf_dir), FIXTURE_PARAMS.as_of)
    return StatusHistoryJob(HistorySources.from_fixtures(_fx(spark, sf_dir)), windows)


def q_final_rows_by_cutoff(spark, sf_dir):
    return _cutoff_job(spark, sf_dir).final_rows


def q_plan_ranges_by_cutoff(spark, sf_dir):
    return _cutoff_job(spark, sf_dir).plan_ranges


# ---- governance --------------------------------------------------------------------------

def q_row_filter_if(spark, sf_dir):
    """A filter with two arms: rows without a country are shown, of the others every second country."""
    fn = gov.register_sql_function(spark, "tidemark_country_filter", "country_name STRING",
                                   "IF(country_name IS NULL, true, right(country_name, 1) IN ('0', '2', '4', '6', '8'))")
    return gov.apply_row_filter(_fx(spark, sf_dir).customer_geo, fn, ["country_name"])


def _allowed_countries(*names: str):
    return lambda country: gov.if_filter(country.isNull(), False, country.isin(list(names)))


def q_row_filter_null_safe(spark, sf_dir):
    reg = gov.PolicyRegistry()
    reg.set_row_filter("customer_geo", _allowed_countries("NATION_1", "NATION_2", "NATION_3"), ["country_name"])
    fx = _fx(spark, sf_dir)
    return gov.secured(fx.customer_geo, "customer_geo", reg, "bob", fx.membership)


def q_tag_rule_filter(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    reg = gov.PolicyRegistry()
    reg.add_tag_rule(gov.TagRule("two_nations", "geo", _allowed_countries("NATION_4", "NATION_5"), ["admins"]))
    df = gov.tag_column(fx.customer_geo, "country_name", "geo")
    return gov.secured(df, "customer_geo", reg, "alice", fx.membership)


def q_tag_rule_two_columns(spark, sf_dir):
    """Suppliers and customers by order line pair: both tagged countries must be allowed."""
    fx = _fx(spark, sf_dir)
    supplier = fx.supplier.join(fx.nation, c("s_nationkey") == c("n_nationkey")).select(
        c("s_suppkey"), c("n_name").alias("supplier_country"))
    pairs = fx.lineitem.select("l_orderkey", "l_suppkey").distinct().join(fx.orders, c("l_orderkey") == c("o_orderkey")).join(
        fx.customer_geo, c("o_custkey") == c("c_custkey")).join(supplier, c("l_suppkey") == c("s_suppkey")).select(
        "l_orderkey", "l_suppkey", "country_name", "supplier_country")
    for column in ("country_name", "supplier_country"):
        pairs = gov.tag_column(pairs, column, "geo")
    reg = gov.PolicyRegistry()
    reg.add_tag_rule(gov.TagRule("some_nations", "geo", _allowed_countries(*[f"NATION_{k}" for k in range(3, 9)]),
                                 ["admins"]))
    return gov.secured(pairs, "pairs", reg, "alice", fx.membership)


def q_column_mask_group(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    reg = gov.PolicyRegistry()
    reg.set_mask("customer_geo", "c_name", "HR", "(hidden)")
    return gov.secured(fx.customer_geo, "customer_geo", reg, "bob", fx.membership)


def q_column_mask_member(spark, sf_dir):
    """The same mask for a member of the group: the values are clear."""
    fx = _fx(spark, sf_dir)
    reg = gov.PolicyRegistry()
    reg.set_mask("customer_geo", "c_name", "HR", "(hidden)")
    return gov.secured(fx.customer_geo, "customer_geo", reg, "alice", fx.membership)


def q_column_mask_function(spark, sf_dir):
    """A mask that is a SQL function of the value: all but the last three characters are hidden."""
    fx = _fx(spark, sf_dir)
    mask = gov.register_sql_function(spark, "tidemark_last_three", "name STRING", "concat('..', right(name, 3))")
    reg = gov.PolicyRegistry()
    reg.set_mask("customer_geo", "c_name", "HR", mask)
    return gov.secured(fx.customer_geo, "customer_geo", reg, "bob", fx.membership)


def q_membership_nested(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return gov.all_memberships(fx.customer_groups, fx.group_nesting)


def q_groups_of_user(spark, sf_dir):
    """All groups of the first customer, direct ones and those they are in."""
    fx = _fx(spark, sf_dir)
    return gov.groups_of(fx.customer_groups, fx.group_nesting, fx.customer.agg(F.min("c_name")).first()[0])


def _policy_view(principal: str):
    """One view, asked by different principals: rows of the countries they may see, names for members of a group."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        fx = _fx(spark, sf_dir)
        names = {"customer_geo": "tidemark_customers", "country_access": "tidemark_access", "managers": "tidemark_managers"}
        managers = fx.country_access.select("principal", F.when(c("principal") == "building", "HR").otherwise("sales").alias(
            "group_name")).distinct()
        for key, name in names.items():
            (managers if key == "managers" else getattr(fx, key)).createOrReplaceTempView(name)
        with _LOCK:
            who = gov.set_principal(spark, principal)
            gov.secured_view(spark, "tidemark_seen", names["customer_geo"], membership=names["managers"], who=who,
                             allowed=("country_name", names["country_access"]), masks={"c_name": ("HR", "'(hidden)'")})
            return spark.sql("SELECT * FROM tidemark_seen")
    return q


def q_split_scan(spark, sf_dir):
    """The orders by the disjoint predicates that a JDBC read would send, on a date and on a text column."""
    orders = _fx(spark, sf_dir).orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
    parts = [orders.where(p) for p in split_predicates("o_orderdate", split_points(orders, "o_orderdate", 6))]
    by_date = parts[0]
    for part in parts[1:]:
        by_date = by_date.unionByName(part)
    texts = [by_date.where(p) for p in split_predicates("o_orderpriority", split_points(orders, "o_orderpriority", 3))]
    out = texts[0]
    for part in texts[1:]:
        out = out.unionByName(part)
    return out


# ---- inventory ---------------------------------------------------------------------------------

def _sizes(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return inv.table_sizes({f"testdata.{SCHEMA_OF[t]}.{t}": fx.table(t) for t in BASE_TABLES})


def q_inventory_by_schema(spark, sf_dir):
    return inv.inventory_by_schema(_sizes(spark, sf_dir), unit=1e6, size_col="schema_size_mb")


def q_inventory_by_table(spark, sf_dir):
    return inv.inventory_by_table(_sizes(spark, sf_dir), unit=1e6, size_col="size_mb")


def q_inventory_skip_schemas(spark, sf_dir):
    """Table sizes without the schemas that a report leaves out."""
    return inv.inventory_by_table(inv.without_schemas(_sizes(spark, sf_dir), ["events", "corpus"]), unit=1e6, size_col="size_mb")


def q_inventory_files(spark, sf_dir):
    """Sizes of the stored files of every table, from a listing (no oracle: SQL does not see the files)."""
    paths = {f"testdata.{SCHEMA_OF[t]}.{t}": f"{sf_dir}/{t}.parquet" for t in BASE_TABLES}
    return inv.inventory_by_table(inv.stored_sizes(spark, paths), unit=1e6, size_col="size_mb")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_table": q_scan_table,
        "project_mixed": q_project_mixed,
        "rename_cols": q_rename_cols,
        "typed_null": q_typed_null,
        "jdbc_like_category_filter": q_jdbc_like_category_filter,
        "distinct_category": q_distinct_category,
        "filter_conj": q_filter_conj,
        "cutoff_lookup": q_cutoff_lookup,
        "run_dates": q_run_dates,
        "date_roundtrip": q_date_roundtrip,
        "filter_codes": q_filter_codes,
        "blank_predicates": q_blank_predicates,
        "as_of_snapshot": q_as_of_snapshot,
        "text_date_window": q_text_date_window,
        "plan_delta_filter": _stage("plan_delta"),
        "plan_join": _stage("plan_items"),
        "contract_start_delta": _stage("contract_starts"),
        "param_flag": _stage("subs"),
        "bill_docs": _stage("bill_docs"),
        "bill_docs_sibling": _stage("bill_docs_sibling"),
        "bill_docs_cancelled": _stage("bill_docs_cancelled"),
        "credit_memo_origin": _stage("credit_memos"),
        "scd_start_delta": _stage("scd_starts"),
        "scd_at_contract_start": _lookup("contract_starts", "contract_start_date"),
        "scd_at_plan_start": _lookup("plans_starting", lambda: text_to_date("bp_start_date")),
        "scd_after_plan_end": _lookup("plans_ending", "event_date"),
        "scd_at_credit_memo": _lookup("credit_memos", "created_date_yyyy_mm_dd"),
        "scd_at_cancelled_bill": _lookup("bill_docs_cancelled", lambda: text_to_date("created_date")),
        "scd_at_bill": _lookup("bill_docs", lambda: text_to_date("created_date"), window=True),
        "scd_at_sibling_bill": _lookup("bill_docs_sibling", lambda: text_to_date("created_date"), window=True),
        "delta_union_distinct": _stage("delta_versions"),
        "scd_plan_left_interval": _stage("with_plans"),
        "billed_before": _stage("billed_before"),
        "sibling_billed_before": _stage("sibling_billed_before"),
        "status_join": _stage("status_input"),
        "self_alias_join": q_self_alias_join,
        "status_rules": q_status_rules,
        "init_inactive_flag": q_init_inactive_flag,
        "status_distinct": _stage("status_rows"),
        "lag_status": q_lag_status,
        "drop_reactivation": q_drop_reactivation,
        "collapse_runs": q_collapse_runs,
        "link_versions": q_link_versions,
        "close_intervals": q_close_intervals,
        "close_intervals_observed": q_close_intervals_observed,
        "user_status_intervals": q_user_status_intervals,
        "reopen_open_rows": _stage("reopened"),
        "union_reopened": _stage("union_reopened"),
        "rebuild_intervals": _stage("versions"),
        "enrich_final": _stage("enriched"),
        "reason_rewrite": q_reason_rewrite,
        "merge_upsert": _stage("merged"),
        "merge_range_update": _stage("merged_with_plan_flag"),
        "final_rows_by_cutoff": q_final_rows_by_cutoff,
        "plan_ranges_by_cutoff": q_plan_ranges_by_cutoff,
        "row_filter_if": q_row_filter_if,
        "row_filter_null_safe": q_row_filter_null_safe,
        "tag_rule_filter": q_tag_rule_filter,
        "column_mask_group": q_column_mask_group,
        "tag_rule_two_columns": q_tag_rule_two_columns,
        "column_mask_member": q_column_mask_member,
        "column_mask_function": q_column_mask_function,
        "membership_nested": q_membership_nested,
        "groups_of_user": q_groups_of_user,
        "policy_view_member": _policy_view("building"),
        "policy_view_other": _policy_view("machinery"),
        "split_scan": q_split_scan,
        "inventory_files": q_inventory_files,
        "inventory_skip_schemas": q_inventory_skip_schemas,
        "inventory_by_schema": q_inventory_by_schema,
        "inventory_by_table": q_inventory_by_table,
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History versions rebuilt from scratch: run collapse + interval closing."""
    return q_close_intervals(spark, sf_dir)
