"""Status derivation: an ordered rule list evaluated as one CASE expression.

Every rule marks a version INACTIVE; when none fires it is ACTIVE. Rules keep
the source's exact predicates, including its NULL behaviour: a ``!=`` against
a NULL code is NULL, so that rule does not fire. ``status_rule`` records the
number of the first rule that fired (NULL when ACTIVE), for audit.

Inputs are named through ``StatusInputs`` so the rules run on any frame that
carries the needed columns under other names.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions import predicates
from tidemark.operators.history import ACTIVE, INACTIVE

# Fixed code lists of the rules.
HARD_CANCEL_REASONS = ["S2", "Z8", "HC", "HD", "HE", "HA", "SD", "SF", "HL"]
FREE_ORDER_REASONS = ["911", "912", "913", "921"]
KEEP_BILLING_BLOCKS = ["30", "43", "44"]
CANCEL_WITH_BILLS = ["S3", "SC"]
MEMO_CANCEL_REASONS = ["SCC", "HCC"]
PAY_UPFRONT = "PUF"
SERVICE_CATEGORY = "SERV"


@dataclass(frozen=True)
class StatusInputs:
    """Column names the rules read."""

    start_date: str = "start_date"
    contract_start: str = "contract_start_date_bp"
    contract_end: str = "contract_end_date_bp"
    billing_block_header: str = "billing_block_header"
    billing_block_item: str = "billing_block_item"
    reason: str = "cancellation_reason"
    old_reason: str = "cancellation_reason_old"
    rejection: str = "reason_for_rejection"
    plan_update: str = "bp_upd_ind"
    plan_start: str = "bp_start"
    plan_block: str = "bp_billing_block"
    plan_price: str = "bp_net_price"
    frequency: str = "billing_frequency"
    category: str = "subscription_category"
    payment: str = "payment_method"
    order_reason: str = "order_reason"
    memo_doc: str = "memo_doc"
    memo_reason: str = "memo_reason"
    billed_doc: str = "billed_doc"
    billed2_doc: str = "billed2_doc"
    trial_flag: str = "trial_order_flag"
    first_payment: str = "first_pmt_success_date"


def _ne_all(col: Column, values: list[str]) -> Column:
    """``col != v1 AND col != v2 ...`` (NULL when col is NULL)."""
    out = col != values[0]
    for v in values[1:]:
        out = out & (col != v)
    return out


def _eq_any(col: Column, values: list[str]) -> Column:
    """``col = v1 OR col = v2 ...`` (NULL when col is NULL and nothing matches)."""
    out = col == values[0]
    for v in values[1:]:
        out = out | (col == v)
    return out


def status_rules(df: DataFrame, names: StatusInputs = StatusInputs()) -> list[Column]:
    """The 16 INACTIVE rules, in evaluation order."""
    cols = {f.name: (F.col(getattr(names, f.name)) if getattr(names, f.name) in df.columns
                     else F.lit(None)) for f in fields(names)}

    def is_str(field: str) -> bool:
        n = getattr(names, field)
        return n in df.columns and isinstance(df.schema[n].dataType, StringType)

    def present(field: str) -> Column:
        return predicates.present(cols[field], is_str(field))

    def absent(field: str) -> Column:
        return predicates.absent(cols[field], is_str(field))

    start, reason, freq = cols["start_date"], cols["reason"], cols["frequency"]
    rej, order_reason, block = cols["rejection"], cols["order_reason"], cols["plan_block"]
    with_bills = _eq_any(reason, CANCEL_WITH_BILLS)
    paid_order = _ne_all(order_reason, FREE_ORDER_REASONS)
    return [
        start < cols["contract_start"],                                                      # 1
        start > cols["contract_end"],                                                        # 2
        (cols["billing_block_header"] != "") & cols["billing_block_header"].isNotNull(),     # 3
        (cols["billing_block_item"] != "") & cols["billing_block_item"].isNotNull(),         # 4
        (reason == "SC") & (cols["plan_update"] == "RTNE"),                                  # 5
        (reason == "SA") & (freq != PAY_UPFRONT) & (start == cols["plan_start"]),            # 6
        _eq_any(reason, HARD_CANCEL_REASONS),                                                # 7
        (((rej != "S4") & (rej != "") & rej.isNotNull())
         | ((rej == "S4") & ((reason != "S5") & (reason != "HB")))),                         # 8
        (cols["category"] != SERVICE_CATEGORY) & paid_order & cols["plan_price"].isNull(),   # 9
        with_bills & ((freq == PAY_UPFRONT) | (order_reason == "921")),                      # 10
        (freq == PAY_UPFRONT) & present("memo_doc"),                                         # 11
        (reason == "NB") & (freq != PAY_UPFRONT) & _eq_any(cols["memo_reason"], MEMO_CANCEL_REASONS),  # 12
        ((cols["payment"] != "06") & with_bills & _ne_all(cols["old_reason"], ["S4", "SB"])
         & (cols["contract_start"] == cols["plan_start"])),                                  # 13
        (with_bills & (start <= cols["plan_start"]) & _ne_all(block, KEEP_BILLING_BLOCKS)
         & (cols["billed_doc"].isNull() & cols["billed2_doc"].isNull())),                    # 14
        (cols["trial_flag"] == "Y") & (cols["first_payment"].isNull() | (cols["first_payment"] == "")),  # 15
        ((cols["category"] != SERVICE_CATEGORY) & paid_order & (block != "") & block.isNotNull()
         & _ne_all(block, KEEP_BILLING_BLOCKS) & absent("billed_doc") & absent("billed2_doc")),  # 16
    ]


def first_matching_rule(df: DataFrame, names: StatusInputs = StatusInputs()) -> Column:
    """Number (1-16) of the first rule that fires, NULL when none does."""
    rules = status_rules(df, names)
    expr = F.when(rules[0], F.lit(1))
    for i, r in enumerate(rules[1:], start=2):
        expr = expr.when(r, F.lit(i))
    return expr


def derive_status(df: DataFrame, names: StatusInputs = StatusInputs(), status: str = "subscription_status",
                  rule: str | None = "status_rule") -> DataFrame:
    """Add ``status`` (INACTIVE if any rule fires, else ACTIVE) and the first firing rule."""
    first = first_matching_rule(df, names)
    out = df.withColumn(rule or "_status_rule", first)
    rule_col = F.col(rule or "_status_rule")
    out = out.withColumn(status, F.when(rule_col.isNull(), ACTIVE).otherwise(INACTIVE))
    return out if rule else out.drop("_status_rule")


def init_inactive_flag(df: DataFrame, contract_start: str = "contract_start_date_bp",
                       status: str = "subscription_status") -> DataFrame:
    """Y when an INACTIVE version starts at creation or before the contract starts."""
    inactive = F.col(status) == INACTIVE
    flag = (F.when((F.col("created_date") == F.col("start_date")) & inactive, "Y")
            .when((F.col("start_date") < F.col(contract_start)) & inactive, "Y")
            .otherwise("N"))
    return df.withColumn("init_inactive_flag", flag)


def reason_rewrite(df: DataFrame, status: str = "subscription_status", route: str = "route_to_market",
                   inco: str = "inco3_l") -> DataFrame:
    """Clear the rejection and set reason SA for app-store billing errors and SC+RTNE, when INACTIVE.

    Both new values are computed from the original columns in one projection.
    """
    inactive = F.col(status) == INACTIVE
    app_store_error = inactive & (F.col(route) == "APP STORE") & (F.col(inco) == "BILLING_ERROR")
    returned = inactive & (F.col("cancellation_reason") == "SC") & (F.col("bp_upd_ind") == "RTNE")
    return df.withColumns({
        "reason_for_rejection": F.when(app_store_error, "").when(returned, "").otherwise(F.col("reason_for_rejection")),
        "cancellation_reason": F.when(app_store_error, "SA").when(returned, "SA").otherwise(F.col("cancellation_reason")),
    })
