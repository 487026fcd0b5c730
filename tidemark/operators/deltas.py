"""Change extraction: the rows of each source that fall into the run window.

Each function is one declarative DataFrame; filters are literals built from
``RunDates`` so they fold and push into the scans. Header tables used only as
filters are applied as ``left_semi`` joins: the output carries no header
column, so an existence join cannot fan out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import UNSET_TEXT_DATE, text_to_date
from tidemark.operators.common import ITEM_KEYS, all_of, broadcast_bounded
from tidemark.params import RowDates, RunDates

# Fixed codes of the source system.
ACTIVE_SUBSCRIPTION_TYPE = "IN"
CONTRACT_DOC_TYPE = "ZCSB"
INVOICE = "F2"
CREDIT_MEMO = "G2"
CANCEL_REASONS_WITH_BILLS = ["S3", "SC"]
TRIAL_PARAM_CATEGORY = "TWP_OFFERS"
TRIAL_PARAM_NAME = "OFFER_TYPE"

PLAN_COLUMNS = [
    "client", "sales_document", "sales_document_item", "bp_no", "bp_item",
    "bp_start_date", "bp_end_date", "bp_billing_block", "bp_net_price", "bp_upd_ind",
]

c = F.col

# Stages a change frame under a name and hints a broadcast when it is small.
Small = Callable[[DataFrame, str], DataFrame]


def subscriptions(dim: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Active contract subscriptions (``IN`` / ``ZCSB``), optionally for some categories."""
    conds = [c("subscription_type") == ACTIVE_SUBSCRIPTION_TYPE, c("sales_document_type") == CONTRACT_DOC_TYPE]
    if categories is not None:
        conds.append(c("subscription_category").isin(list(categories)))
    return dim.where(all_of(conds))


def category_filter(dim: DataFrame, category: str) -> DataFrame:
    """Source-side category lookup: ``subscription_category = upper(param)``."""
    return dim.where(c("subscription_category") == F.upper(F.lit(category))).select(
        "subscription_category", "subscription_type", "sales_document_type")


def distinct_categories(dim: DataFrame) -> DataFrame:
    return subscriptions(dim).select("subscription_category").distinct()


def with_trial_flag(subs: DataFrame, params: DataFrame) -> DataFrame:
    """``trial_order_flag`` = Y when the offer type is listed as a trial offer.

    The parameter list is deduplicated and size-checked before it is
    broadcast, so the left join keeps exactly one row per subscription.
    """
    offers = (
        params.where((c("param_categ") == TRIAL_PARAM_CATEGORY) & (c("param_name") == TRIAL_PARAM_NAME))
        .select(c("param_val").alias("_trial_offer")).distinct()
    )
    return (
        subs.join(broadcast_bounded(offers), c("offer_type") == c("_trial_offer"), "left")
        .withColumn("trial_order_flag", F.when(c("offer_type") == c("_trial_offer"), "Y").otherwise("N"))
        .drop("_trial_offer")
    )


def touches_window(rd: RunDates | RowDates, guard_all: bool = False, last: RunDates | None = None) -> Column:
    """The plan item's dates touch the window. With ``last``, the window of some cutoff from ``rd`` to ``last``."""
    o, f, e = c("ofkdat"), c("fkdat"), c("bp_end_date")
    guard = (o != UNSET_TEXT_DATE) & (f != UNSET_TEXT_DATE)
    in_window = (o >= rd.cutoff_text) & (o < rd.today_text)
    spans_cutoff = (o <= (last or rd).cutoff_scd_text) & (e >= rd.cutoff_scd_text)
    spans_today = (o <= rd.today_text) & (e >= rd.today_text)
    return guard & (in_window | spans_cutoff | spans_today) if guard_all else (guard & in_window) | spans_cutoff | spans_today


def plan_delta(plans: DataFrame, rd: RunDates, guard_all: bool = False, last: RunDates | None = None) -> DataFrame:
    """Billing plan items touching the window, with ``bp_start_date``.

    Kept verbatim: the unset-date guard binds only to the first branch
    (``guard & in_window | spans_cutoff | spans_today``); ``guard_all=True``
    applies it to all three. ``last`` widens the window to all cutoffs from ``rd`` to it (``plan_items`` then takes each row's own).
    """
    o, f = c("ofkdat"), c("fkdat")
    return plans.where(touches_window(rd, guard_all, last)).withColumn("bp_start_date", F.when(o > f, f).otherwise(o))


def own_cutoff(subs: DataFrame, alias: str) -> list[Column]:
    """The cutoff column of subscriptions that carry one."""
    return [c(f"{alias}.cutoff_date")] if "cutoff_date" in subs.columns else []


def plan_items(plan_rows: DataFrame, subs: DataFrame, own: RowDates | None = None) -> DataFrame:
    """Billing plan rows joined to their subscription (``bp_no = bill_plan_number``).

    ``own`` keeps the rows that touch the window of their subscription's cutoff, which the result then carries.
    """
    p = plan_rows.drop("client").alias("p")
    s = subs.alias("s")
    rows = p.join(s, c("p.bp_no") == c("s.bill_plan_number"), "inner")
    return (rows if own is None else rows.where(touches_window(own))).select(
        c("s.client"), c("s.sales_document"), c("s.sales_document_item"),
        c("p.bp_no"), c("p.bp_item"), c("p.bp_start_date"), c("p.bp_end_date"),
        c("p.bp_billing_block"), c("p.bp_net_price"), c("p.bp_upd_ind"), c("s.subscription_category"),
        *own_cutoff(subs, "s"),
    )


def since_own_cutoff(rows: DataFrame, subs: DataFrame, at: Column, small: Small, name: str) -> DataFrame:
    """Rows (with item keys) of which some subscription exists whose cutoff is not after ``at`` (a date).

    The earliest cutoff of an item decides, so subscriptions are one row per item and cannot repeat a row.
    """
    rows = small(rows, name)
    keys = rows.select(*ITEM_KEYS).distinct()
    first = subs.join(keys, ITEM_KEYS, "left_semi").groupBy(*ITEM_KEYS).agg(F.min("cutoff_date").alias("_own_cutoff"))
    return rows.join(first, ITEM_KEYS).where(at >= c("_own_cutoff")).select(*rows.columns)


def plans_starting(items: DataFrame, rd: RunDates | RowDates) -> DataFrame:
    """Plan items whose start falls in ``[cutoff, today]`` (text dates, inclusive)."""
    return items.where(c("bp_start_date").between(rd.cutoff_text, rd.today_text))


def plans_ending(items: DataFrame, rd: RunDates | RowDates) -> DataFrame:
    """Plan items ending in ``[cutoff - 1, today - 1]``; the event is the day after the end."""
    return items.where(c("bp_end_date").between(rd.cutoff_scd_text, rd.yesterday_text)).withColumn(
        "event_date", F.date_add(text_to_date("bp_end_date"), 1))


def as_is(rows: DataFrame, name: str) -> DataFrame:
    """Default of ``small``: leave a change frame to Spark."""
    return rows


def existing(rows: DataFrame, table: DataFrame, on: dict[str, str], small: Small = as_is, name: str = "rows") -> DataFrame:
    """``rows`` whose key (``on``: column of rows -> column of table) occurs in a full-size table.

    ``small`` stages the rows and hints a broadcast when they are few: the table is then reduced to their keys in one
    streamed pass, and only the reduced keys are joined. No side is shuffled at full size.
    """
    rows = small(rows, name)
    keys = rows.select(*[c(a).alias(b) for a, b in on.items()]).distinct()
    hit = table.join(keys, list(on.values()), "left_semi").select(*[c(b).alias(f"_hit_{b}") for b in on.values()]).distinct()
    return rows.join(hit, all_of([c(a) == c(f"_hit_{b}") for a, b in on.items()]), "left_semi")


def of_kind(rows: DataFrame, bill_hdr: DataFrame, kind: str, small: Small = as_is, name: str = "rows") -> DataFrame:
    """Billing items (``client``, ``billing_document``) whose header is of type ``kind``."""
    return existing(rows, bill_hdr.where(c("fkart") == kind), {"client": "mandt", "billing_document": "vbeln"}, small, name)


def bill_docs(bill_item: DataFrame, bill_hdr: DataFrame, items: DataFrame, small: Small = as_is) -> DataFrame:
    """Invoice items billed against a plan item of the delta (same plan and item).

    The plan items of the window come first (pass them broadcast); the headers are asked for the few rows left.
    """
    b, p = bill_item.alias("b"), items.alias("p")
    cond = (c("p.client") == c("b.mandt")) & (c("p.bp_no") == c("b.bp_no")) & (c("p.bp_item") == c("b.bp_item"))
    rows = b.join(p, cond, "inner").select(
        c("p.client"), c("b.billing_document"), c("b.billing_document_item"),
        c("p.sales_document"), c("p.sales_document_item"), c("p.bp_no"), c("p.bp_item"), c("b.created_date"),
        *own_cutoff(items, "p"))
    return of_kind(rows, bill_hdr, INVOICE, small, "bill_rows")


def bill_docs_sibling(bill_item: DataFrame, bill_hdr: DataFrame, items: DataFrame, small: Small = as_is) -> DataFrame:
    """Invoice items of another item of the same plan that ends on the same day."""
    b, p = bill_item.alias("b"), items.alias("p")
    cond = ((c("p.client") == c("b.mandt")) & (c("p.bp_no") == c("b.bp_no"))
            & (c("p.bp_end_date") == c("b.bp_end_date")) & (c("p.bp_item") != c("b.bp_item")))
    rows = b.join(p, cond, "inner").select(
        c("p.client"), c("b.billing_document"), c("b.billing_document_item"),
        c("p.sales_document"), c("p.sales_document_item"), c("p.bp_no"), c("p.bp_end_date"), c("b.created_date"),
        *own_cutoff(items, "p"))
    return of_kind(rows, bill_hdr, INVOICE, small, "sibling_rows")


def cancel_reason_docs(scd: DataFrame) -> DataFrame:
    """Items that carry a cancellation reason after which bills still matter."""
    return scd.where(c("cancellation_reason").isin(CANCEL_REASONS_WITH_BILLS)).select(
        "client", "sales_document", "sales_document_item")


def bill_docs_cancelled(bill_item: DataFrame, bill_hdr: DataFrame, scd: DataFrame, subs: DataFrame,
                        rd: RunDates, small: Small = as_is) -> DataFrame:
    """Invoice items created in the window for items with cancellation reason S3/SC.

    The window comes first; headers, reasons and subscriptions are existence tests on its rows, so an item with
    many history rows does not multiply its bills.
    """
    rows = bill_item.where(c("created_date").between(rd.cutoff_text, rd.today_text)).select(
        c("mandt").alias("client"), "billing_document", "billing_document_item", "sales_document",
        "sales_document_item", "bp_no", "bp_item", "bp_end_date", "created_date")
    own = {k: k for k in ITEM_KEYS}
    rows = of_kind(rows, bill_hdr, INVOICE, small, "window_rows")
    rows = existing(rows, cancel_reason_docs(scd), own, small, "window_invoices")
    if "cutoff_date" in subs.columns:
        return since_own_cutoff(rows, subs, text_to_date(c("created_date")), small, "window_cancelled")
    return existing(rows, subs, own, small, "window_cancelled")


def credit_memos(bill_item: DataFrame, bill_hdr: DataFrame, order_line: DataFrame, order_hdr: DataFrame,
                 subs: DataFrame, rd: RunDates, small: Small = as_is) -> DataFrame:
    """Credit memos created in the window, attributed to the subscription they originate from.

    memo item -> sales order line -> originating subscription (``vgbel/vgpos``);
    the order reason comes from the memo's own sales order header. The memos of the window come first and meet each
    full-size table as the broadcast side.
    """
    rows = bill_item.where(c("created_date").between(rd.cutoff_text, rd.today_text)).select(
        c("mandt").alias("client"), "billing_document", "billing_document_item", "sales_document",
        "sales_document_item", "created_date")
    m = small(of_kind(rows, bill_hdr, CREDIT_MEMO, small, "window_memos"), "memos").alias("m")
    lines = order_line.alias("o").join(
        m, (c("m.client") == c("o.mandt")) & (c("m.sales_document") == c("o.vbeln"))
        & (c("m.sales_document_item") == c("o.posnr")), "inner").select(
        "m.*", c("o.vgbel"), c("o.vgpos"))
    lines = small(lines, "memo_lines").alias("m")
    owned = subs.alias("s").join(
        lines, (c("s.client") == c("m.client")) & (c("s.sales_document") == c("m.vgbel"))
        & (c("s.sales_document_item") == c("m.vgpos")), "inner")
    if "cutoff_date" in subs.columns:
        owned = owned.where(text_to_date(c("m.created_date")) >= c("s.cutoff_date"))
    owned = owned.select(
        c("m.client"), c("m.billing_document"), c("m.billing_document_item"), c("m.sales_document").alias("memo_order"),
        c("s.sales_document"), c("s.sales_document_item"), c("m.created_date"), c("s.billing_frequency"))
    owned = small(owned, "memo_owners").alias("m")
    return order_hdr.alias("a").join(
        owned, (c("a.mandt") == c("m.client")) & (c("a.vbeln") == c("m.memo_order")), "inner").select(
        c("m.client"), c("m.billing_document"), c("m.billing_document_item"), c("m.sales_document"),
        c("m.sales_document_item"), c("m.created_date"), c("m.billing_frequency"), c("a.order_reason"),
        text_to_date(c("m.created_date")).alias("created_date_yyyy_mm_dd"))


def contract_starts(subs: DataFrame, rd: RunDates | RowDates) -> DataFrame:
    """Subscriptions whose contract starts in the window, after the item was created."""
    return (
        subs.where(c("contract_start_date_bp").between(F.lit(rd.cutoff), F.lit(rd.today))
                   & (c("contract_start_date_bp") > c("created_date_item")))
        .select(*ITEM_KEYS, c("created_date_item").alias("created_date"),
                c("contract_start_date_bp").alias("contract_start_date"))
    )
