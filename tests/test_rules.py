"""Status rules: each rule fires alone on a hand-written row; NULL codes do not fire."""

import datetime as dt

import pytest
from pyspark.sql import Row

from tidemark.operators.rules import derive_status, init_inactive_flag, reason_rewrite

D = dt.date

# A row on which no rule fires (ACTIVE).
BASE = dict(
    start_date=D(2021, 9, 10), contract_start_date_bp=D(2021, 9, 1), contract_end_date_bp=D(2023, 9, 1),
    billing_block_header="", billing_block_item="", cancellation_reason="", cancellation_reason_old="",
    reason_for_rejection="", bp_upd_ind="", bp_start=D(2021, 9, 5), bp_billing_block="30",
    bp_net_price=10.0, billing_frequency="MON", subscription_category="SERV", payment_method="06",
    order_reason="911", memo_doc=None, memo_reason=None, billed_doc="B1", billed2_doc=None,
    trial_order_flag="N", first_pmt_success_date="20210901", created_date=D(2021, 9, 1),
)
SCHEMA = (
    "start_date date, contract_start_date_bp date, contract_end_date_bp date, billing_block_header string, "
    "billing_block_item string, cancellation_reason string, cancellation_reason_old string, "
    "reason_for_rejection string, bp_upd_ind string, bp_start date, bp_billing_block string, "
    "bp_net_price double, billing_frequency string, subscription_category string, payment_method string, "
    "order_reason string, memo_doc string, memo_reason string, billed_doc string, billed2_doc string, "
    "trial_order_flag string, first_pmt_success_date string, created_date date"
)

FIRES = {
    1: dict(start_date=D(2021, 8, 1), contract_end_date_bp=D(2023, 9, 1)),
    2: dict(start_date=D(2024, 1, 1)),
    3: dict(billing_block_header="08"),
    4: dict(billing_block_item="09"),
    5: dict(cancellation_reason="SC", bp_upd_ind="RTNE", billing_frequency="MON", order_reason="911"),
    6: dict(cancellation_reason="SA", bp_start=D(2021, 9, 10)),
    7: dict(cancellation_reason="HL"),
    8: dict(reason_for_rejection="R1"),
    9: dict(subscription_category="BUILDING", order_reason="SCC", bp_net_price=None),
    10: dict(cancellation_reason="S3", billing_frequency="PUF"),
    11: dict(billing_frequency="PUF", memo_doc="M1"),
    12: dict(cancellation_reason="NB", memo_doc="M1", memo_reason="HCC"),
    13: dict(cancellation_reason="SC", payment_method="01", cancellation_reason_old="SA",
             contract_start_date_bp=D(2021, 9, 5), start_date=D(2021, 9, 10), order_reason="911",
             billing_frequency="MON", bp_start=D(2021, 9, 5)),
    14: dict(cancellation_reason="S3", bp_start=D(2021, 9, 20), bp_billing_block="12", billed_doc=None),
    15: dict(trial_order_flag="Y", first_pmt_success_date=""),
    16: dict(subscription_category="BUILDING", order_reason="SCC", bp_billing_block="12", billed_doc=""),
}

# The same rules with the code they test set to NULL: `!=`/`=` against NULL is NULL, so nothing fires.
NULL_DOES_NOT_FIRE = {
    3: dict(billing_block_header=None),
    4: dict(billing_block_item=None),
    5: dict(cancellation_reason="SC", bp_upd_ind=None),
    6: dict(cancellation_reason="SA", billing_frequency=None, bp_start=D(2021, 9, 10)),
    7: dict(cancellation_reason=None),
    8: dict(reason_for_rejection=None),
    9: dict(subscription_category="BUILDING", order_reason=None, bp_net_price=None),
    10: dict(cancellation_reason="S3", billing_frequency=None, order_reason=None),
    11: dict(billing_frequency="PUF", memo_doc=None),
    12: dict(cancellation_reason="NB", memo_reason=None, memo_doc="M1"),
    13: dict(cancellation_reason="SC", payment_method=None, contract_start_date_bp=D(2021, 9, 5)),
    14: dict(cancellation_reason="S3", bp_start=D(2021, 9, 20), bp_billing_block=None, billed_doc=None),
    15: dict(trial_order_flag=None, first_pmt_success_date=""),
    16: dict(subscription_category="BUILDING", order_reason="SCC", bp_billing_block=None, billed_doc=""),
}


def _status(spark, overrides):
    row = {**BASE, **overrides}
    df = spark.createDataFrame([Row(**row)], SCHEMA)
    r = derive_status(df).select("subscription_status", "status_rule").first()
    return r["subscription_status"], r["status_rule"]


def test_base_row_is_active(spark):
    assert _status(spark, {}) == ("ACTIVE", None)


@pytest.mark.parametrize("rule", sorted(FIRES))
def test_rule_fires(spark, rule):
    assert _status(spark, FIRES[rule]) == ("INACTIVE", rule)


@pytest.mark.parametrize("rule", sorted(NULL_DOES_NOT_FIRE))
def test_null_does_not_fire(spark, rule):
    status, fired = _status(spark, NULL_DOES_NOT_FIRE[rule])
    assert fired != rule


def test_first_match_wins(spark):
    # rules 3 and 4 both fire; 3 is reported
    assert _status(spark, dict(billing_block_header="08", billing_block_item="09")) == ("INACTIVE", 3)


def test_init_inactive_flag(spark):
    rows = [
        Row(start_date=D(2021, 9, 1), created_date=D(2021, 9, 1), contract_start_date_bp=D(2021, 8, 1), subscription_status="INACTIVE"),
        Row(start_date=D(2021, 7, 1), created_date=D(2021, 6, 1), contract_start_date_bp=D(2021, 8, 1), subscription_status="INACTIVE"),
        Row(start_date=D(2021, 9, 1), created_date=D(2021, 9, 1), contract_start_date_bp=D(2021, 8, 1), subscription_status="ACTIVE"),
        Row(start_date=D(2021, 9, 2), created_date=D(2021, 9, 1), contract_start_date_bp=D(2021, 8, 1), subscription_status="INACTIVE"),
    ]
    df = spark.createDataFrame(rows)
    assert [r.init_inactive_flag for r in init_inactive_flag(df).collect()] == ["Y", "Y", "N", "N"]


def test_reason_rewrite_reads_original_values(spark):
    rows = [
        Row(subscription_status="INACTIVE", route_to_market="APP STORE", inco3_l="BILLING_ERROR",
            cancellation_reason="S3", bp_upd_ind="", reason_for_rejection="R1"),
        Row(subscription_status="INACTIVE", route_to_market="DIRECT", inco3_l=None,
            cancellation_reason="SC", bp_upd_ind="RTNE", reason_for_rejection="R1"),
        Row(subscription_status="ACTIVE", route_to_market="APP STORE", inco3_l="BILLING_ERROR",
            cancellation_reason="SC", bp_upd_ind="RTNE", reason_for_rejection="R1"),
    ]
    out = reason_rewrite(spark.createDataFrame(rows)).collect()
    assert [(r.cancellation_reason, r.reason_for_rejection) for r in out] == [("SA", ""), ("SA", ""), ("SC", "R1")]


@pytest.mark.parametrize("query", ["status_rules", "init_inactive_flag"])
def test_rules_read_the_history_where_it_is_stored(spark, query):
    """Neither the joins with the facts nor the distinct move the wide rows; the trial offers alone are few and moved."""
    from tests.conftest import SF001
    from tidemark.queries import queries

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries()[query](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        moved = plan.count("Exchange hashpartitioning(")
        assert "SortMergeJoin" in plan and moved == plan.count("Exchange hashpartitioning(_trial_offer#")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
