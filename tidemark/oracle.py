"""DuckDB oracle SQL for every registered query.

Each stage is one SQL statement with ``{name}`` placeholders for the views
it reads (fixture views, base tables or other stages). ``render`` inlines the
transitive dependencies as CTEs in dependency order; base tables are the
driver's pre-registered views. The SQL is written independently of the Spark
code, which imports none of it: it states the semantics, the Spark side the execution.
"""

from __future__ import annotations

from tidemark.sources.fixtures import BASE_TABLES, VIEWS, view_deps

# Fixture run window (see FIXTURES.md): cutoff 1998-06-01, today 1998-06-30.
CUT_T, CUT_SCD_T, TODAY_T, YDAY_T = "'19980601'", "'19980531'", "'19980630'", "'19980629'"
CUT_D, CUT_SCD_D, TODAY_D = "DATE '1998-06-01'", "DATE '1998-05-31'", "DATE '1998-06-30'"

KEYS = ["client", "sales_document", "sales_document_item"]
VKEYS = KEYS + ["start_date"]
SCD_ATTRS = ["billing_block_header", "billing_block_item", "cancellation_reason", "cancellation_reason_old",
             "reason_for_rejection", "subscription_quantity", "created_date", "first_pmt_success_date"]
STATUS_COLS = [
    "client", "sales_document", "sales_document_item", "start_date", "end_date", "sales_document_type",
    "billing_block_header", "billing_block_item", "bp_billing_block", "bp_net_price", "bp_start_date",
    "cancellation_reason", "cancellation_reason_old", "contract_start_date", "contract_end_date",
    "created_date", "reason_for_rejection", "subscription_status", "init_inactive_flag",
    "subscription_quantity", "link_id", "prev_link_id", "subscription_category", "bp_upd_ind",
]
TARGET_COLS = STATUS_COLS[:-2]
FINAL_COLS = TARGET_COLS + ["last_modified"]


def on(a: str, b: str, cols: list[str]) -> str:
    return " AND ".join(f"{a}.{x} = {b}.{x}" for x in cols)


def sel(alias: str, cols: list[str]) -> str:
    return ", ".join(f"{alias}.{x}" for x in cols)


def tdate(expr: str) -> str:
    return f"CAST(try_strptime({expr}, '%Y%m%d') AS DATE)"


def w(order: str = "start_date", keys: list[str] = KEYS) -> str:
    return f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {order})"


def lookup(points_view: str, at: str, where: str = "") -> str:
    """Version of ``hist`` valid at each point, re-dated to it (12 columns)."""
    return f"""
SELECT {sel('h', KEYS)}, e.at_date AS start_date, {sel('h', SCD_ATTRS)}
FROM (SELECT client, sales_document, sales_document_item, {at} AS at_date FROM {{{points_view}}} {where}) e
JOIN {{hist}} h ON {on('e', 'h', KEYS)} AND h.start_date <= e.at_date AND h.end_date >= e.at_date"""


RULES_CASE = """CASE
 WHEN start_date < contract_start_date_bp THEN 1
 WHEN start_date > contract_end_date_bp THEN 2
 WHEN billing_block_header <> '' AND billing_block_header IS NOT NULL THEN 3
 WHEN billing_block_item <> '' AND billing_block_item IS NOT NULL THEN 4
 WHEN cancellation_reason = 'SC' AND bp_upd_ind = 'RTNE' THEN 5
 WHEN cancellation_reason = 'SA' AND billing_frequency <> 'PUF' AND start_date = bp_start THEN 6
 WHEN cancellation_reason IN ('S2','Z8','HC','HD','HE','HA','SD','SF','HL') THEN 7
 WHEN (reason_for_rejection <> 'S4' AND reason_for_rejection <> '' AND reason_for_rejection IS NOT NULL)
   OR (reason_for_rejection = 'S4' AND cancellation_reason <> 'S5' AND cancellation_reason <> 'HB') THEN 8
 WHEN subscription_category <> 'SERV' AND order_reason <> '911' AND order_reason <> '912' AND order_reason <> '913'
   AND order_reason <> '921' AND bp_net_price IS NULL THEN 9
 WHEN (cancellation_reason = 'S3' OR cancellation_reason = 'SC') AND (billing_frequency = 'PUF' OR order_reason = '921') THEN 10
 WHEN billing_frequency = 'PUF' AND memo_doc IS NOT NULL THEN 11
 WHEN cancellation_reason = 'NB' AND billing_frequency <> 'PUF' AND (memo_reason = 'SCC' OR memo_reason = 'HCC') THEN 12
 WHEN payment_method <> '06' AND (cancellation_reason = 'S3' OR cancellation_reason = 'SC')
   AND cancellation_reason_old <> 'S4' AND cancellation_reason_old <> 'SB' AND contract_start_date_bp = bp_start THEN 13
 WHEN (cancellation_reason = 'S3' OR cancellation_reason = 'SC') AND start_date <= bp_start
   AND bp_billing_block <> '30' AND bp_billing_block <> '43' AND bp_billing_block <> '44'
   AND billed_doc IS NULL AND {billed2} IS NULL THEN 14
 WHEN trial_order_flag = 'Y' AND (first_pmt_success_date IS NULL OR first_pmt_success_date = '') THEN 15
 WHEN subscription_category <> 'SERV' AND order_reason <> '911' AND order_reason <> '912' AND order_reason <> '913'
   AND order_reason <> '921' AND bp_billing_block <> '' AND bp_billing_block IS NOT NULL
   AND bp_billing_block <> '30' AND bp_billing_block <> '43' AND bp_billing_block <> '44'
   AND billed_doc IS NULL AND {billed2} IS NULL THEN 16
END"""

INIT_FLAG = ("CASE WHEN created_date = start_date AND subscription_status = 'INACTIVE' THEN 'Y' "
             "WHEN start_date < contract_start_date_bp AND subscription_status = 'INACTIVE' THEN 'Y' ELSE 'N' END")


def ruled(view: str, billed2: str = "billed2_doc") -> str:
    return f"""
SELECT *, CASE WHEN status_rule IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS subscription_status
FROM (SELECT * EXCLUDE (subscription_status), {RULES_CASE.format(billed2=billed2)} AS status_rule FROM {{{view}}})"""


def ruled_pipeline(view: str) -> str:
    return f"""
SELECT *, CASE WHEN status_rule IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS subscription_status
FROM (SELECT *, {RULES_CASE.format(billed2='billed2_doc')} AS status_rule FROM {{{view}}})"""


_DEDUPE_ORDER = ", ".join(
    ["CASE WHEN subscription_status = 'INACTIVE' THEN 0 WHEN subscription_status = 'ACTIVE' THEN 1 ELSE 2 END"]
    + [f"{x} ASC NULLS FIRST" for x in STATUS_COLS if x not in VKEYS])

_TABLE_SCHEMAS = {t: "tpch" for t in "region nation customer supplier part orders lineitem".split()}
_TABLE_SCHEMAS.update(events="events")
_TABLE_SCHEMAS.update({t: "corpus" for t in "documents embeddings pages benchmark labels conversations".split()})

_SIZE_EXPR = {
    "region": "4 * count(*) + sum(coalesce(strlen(r_name), 0))",
    "nation": "8 * count(*) + sum(coalesce(strlen(n_name), 0))",
    "customer": "20 * count(*) + sum(coalesce(strlen(c_name), 0) + coalesce(strlen(c_mktsegment), 0))",
    "supplier": "20 * count(*) + sum(coalesce(strlen(s_name), 0))",
    "part": "20 * count(*) + sum(coalesce(strlen(p_name), 0) + coalesce(strlen(p_brand), 0) + coalesce(strlen(p_type), 0))",
    "orders": "32 * count(*) + sum(coalesce(strlen(o_orderstatus), 0) + coalesce(strlen(o_orderpriority), 0))",
    "lineitem": "68 * count(*) + sum(coalesce(strlen(l_returnflag), 0) + coalesce(strlen(l_linestatus), 0))",
    "events": "32 * count(*) + sum(coalesce(strlen(event_type), 0) + coalesce(strlen(props), 0))",
    "documents": "16 * count(*) + sum(coalesce(strlen(text), 0) + coalesce(strlen(lang), 0) + coalesce(strlen(source), 0))",
    "embeddings": "12 * count(*) + sum(4 * coalesce(len(embedding), 0))",
    "pages": "8 * count(*) + sum(coalesce(strlen(url), 0) + coalesce(strlen(html), 0))",
    "benchmark": "8 * count(*) + sum(coalesce(strlen(text), 0))",
    "labels": "16 * count(*)",
    "conversations": "16 * count(*) + sum(coalesce(strlen(role), 0) + coalesce(strlen(text), 0))",
}

STAGES: dict[str, str] = {
    "own_log": """
SELECT wrkflw_nm, max(attr_val_dt) AS attr_val_dt FROM {cutoff_log}
WHERE schma_nm = 'common' AND grp_nm = 'SUBSCRIPTION' AND attr_nm = 'CUTOFF' GROUP BY wrkflw_nm""",
    # ---- fixture-level views used by the rule queries
    "memo": """
SELECT d.client, d.sales_document, d.sales_document_item, a.order_reason, i.created_date
FROM {bill_item} i
JOIN {bill_hdr} b ON b.mandt = i.mandt AND b.vbeln = i.billing_document AND b.fkart = 'G2'
JOIN {order_line} o ON o.mandt = i.mandt AND o.vbeln = i.sales_document AND o.posnr = i.sales_document_item
JOIN {dim} d ON d.client = o.mandt AND d.sales_document = o.vgbel AND d.sales_document_item = o.vgpos
JOIN {order_hdr} a ON a.mandt = o.mandt AND a.vbeln = i.sales_document""",
    "billed": """
SELECT DISTINCT h.client, h.sales_document, h.sales_document_item, h.start_date
FROM {hist} h
JOIN {bill_item} i ON i.sales_document = h.sales_document AND i.sales_document_item = h.sales_document_item AND i.created_date <= replace(CAST(h.start_date AS STRING), '-', '')""",
    "plan_delta": """
SELECT *,
 CASE WHEN ofkdat > fkdat THEN fkdat ELSE ofkdat END AS bp_start_date
FROM {plans}
WHERE (ofkdat<>'00000000' AND fkdat<>'00000000' AND ofkdat>='19980601' AND ofkdat<'19980630') OR (ofkdat<='19980531' AND bp_end_date>='19980531') OR (ofkdat<='19980630' AND bp_end_date>='19980630')""",
    "status_input": """
SELECT DISTINCT h.*, p.bp_no, p.bp_item,
 CASE WHEN p.bp_start_date = '00000000' THEN NULL ELSE CAST(substr(p.bp_start_date,1,4) || '-' || substr(p.bp_start_date,5,2) || '-' || substr(p.bp_start_date,7,2) AS DATE) END AS bp_start, p.bp_billing_block, p.bp_net_price, p.bp_upd_ind, d.contract_start_date_bp, d.contract_end_date_bp, d.payment_method, d.billing_frequency, d.subscription_category, v.order_reason, m.sales_document AS memo_doc, m.order_reason AS memo_reason, b.sales_document AS billed_doc,
 CASE WHEN q.param_val IS NOT NULL THEN 'Y' ELSE 'N' END AS trial_order_flag
FROM {hist} h
JOIN {dim} d ON d.client = h.client AND d.sales_document = h.sales_document AND d.sales_document_item = h.sales_document_item
JOIN {order_hdr} v ON v.mandt = h.client AND v.vbeln = h.sales_document
LEFT JOIN {plan_delta} p ON p.client = h.client AND p.bp_no = h.sales_document AND replace(CAST(h.start_date AS STRING), '-', '') BETWEEN p.bp_start_date AND p.bp_end_date
LEFT JOIN {memo} m ON m.sales_document = h.sales_document AND m.sales_document_item = h.sales_document_item AND m.created_date = replace(CAST(h.start_date AS STRING), '-', '')
LEFT JOIN {billed} b ON b.sales_document = h.sales_document AND b.sales_document_item = h.sales_document_item AND b.start_date = h.start_date
LEFT JOIN (SELECT * FROM {params} WHERE param_categ = 'TWP_OFFERS' AND param_name = 'OFFER_TYPE') q ON q.param_val = d.offer_type""",
    "fixture_ruled": ruled("status_input", billed2="NULL"),
    # ---- pipeline stages
    "subs": """
SELECT d.*, CASE WHEN d.offer_type = q.param_val THEN 'Y' ELSE 'N' END AS trial_order_flag
FROM {dim} d
LEFT JOIN (SELECT DISTINCT param_val FROM {params} WHERE param_categ = 'TWP_OFFERS' AND param_name = 'OFFER_TYPE') q
 ON d.offer_type = q.param_val
WHERE d.subscription_type = 'IN' AND d.sales_document_type = 'ZCSB'""",
    "plan_items": """
SELECT s.client, s.sales_document, s.sales_document_item, p.bp_no, p.bp_item, p.bp_start_date, p.bp_end_date,
 p.bp_billing_block, p.bp_net_price, p.bp_upd_ind, s.subscription_category
FROM {plan_delta} p JOIN {subs} s ON p.bp_no = s.bill_plan_number""",
    "plans_starting": f"SELECT * FROM {{plan_items}} WHERE bp_start_date BETWEEN {CUT_T} AND {TODAY_T}",
    "plans_ending": f"""
SELECT *, {tdate('bp_end_date')} + 1 AS event_date
FROM {{plan_items}} WHERE bp_end_date BETWEEN {CUT_SCD_T} AND {YDAY_T}""",
    "invoice_items": """
SELECT i.* FROM {bill_item} i
WHERE EXISTS (SELECT 1 FROM {bill_hdr} h WHERE h.fkart = 'F2' AND h.mandt = i.mandt AND h.vbeln = i.billing_document)""",
    "bill_docs": """
SELECT p.client, b.billing_document, b.billing_document_item, p.sales_document, p.sales_document_item,
 p.bp_no, p.bp_item, b.created_date
FROM {invoice_items} b JOIN {plan_items} p ON p.client = b.mandt AND p.bp_no = b.bp_no AND p.bp_item = b.bp_item""",
    "bill_docs_sibling": """
SELECT p.client, b.billing_document, b.billing_document_item, p.sales_document, p.sales_document_item,
 p.bp_no, p.bp_end_date, b.created_date
FROM {invoice_items} b JOIN {plan_items} p
 ON p.client = b.mandt AND p.bp_no = b.bp_no AND p.bp_end_date = b.bp_end_date AND p.bp_item <> b.bp_item""",
    "bill_docs_cancelled": f"""
SELECT i.mandt AS client, i.billing_document, i.billing_document_item, i.sales_document, i.sales_document_item,
 i.bp_no, i.bp_item, i.bp_end_date, i.created_date
FROM {{invoice_items}} i
WHERE i.created_date BETWEEN {CUT_T} AND {TODAY_T}
 AND EXISTS (SELECT 1 FROM {{hist}} h WHERE h.cancellation_reason IN ('S3', 'SC') AND h.client = i.mandt
             AND h.sales_document = i.sales_document AND h.sales_document_item = i.sales_document_item)
 AND EXISTS (SELECT 1 FROM {{subs}} s WHERE s.client = i.mandt AND s.sales_document = i.sales_document
             AND s.sales_document_item = i.sales_document_item)""",
    "credit_memos": f"""
SELECT m.mandt AS client, m.billing_document, m.billing_document_item, s.sales_document, s.sales_document_item,
 m.created_date, s.billing_frequency, a.order_reason, {tdate('m.created_date')} AS created_date_yyyy_mm_dd
FROM {{bill_item}} m
JOIN {{order_line}} o ON m.mandt = o.mandt AND m.sales_document = o.vbeln AND m.sales_document_item = o.posnr
JOIN {{subs}} s ON s.client = o.mandt AND s.sales_document = o.vgbel AND s.sales_document_item = o.vgpos
JOIN {{order_hdr}} a ON a.mandt = o.mandt AND a.vbeln = m.sales_document
WHERE m.created_date BETWEEN {CUT_T} AND {TODAY_T}
 AND EXISTS (SELECT 1 FROM {{bill_hdr}} h WHERE h.fkart = 'G2' AND h.mandt = m.mandt AND h.vbeln = m.billing_document)""",
    "contract_starts": f"""
SELECT client, sales_document, sales_document_item, created_date_item AS created_date,
 contract_start_date_bp AS contract_start_date
FROM {{subs}}
WHERE contract_start_date_bp BETWEEN {CUT_D} AND {TODAY_D} AND contract_start_date_bp > created_date_item""",
    "scd_starts": f"""
SELECT {sel('h', KEYS)}, h.start_date, {sel('h', SCD_ATTRS)}
FROM {{hist}} h
WHERE h.start_date BETWEEN {CUT_D} AND {TODAY_D}
 AND EXISTS (SELECT 1 FROM {{subs}} s WHERE {on('s', 'h', KEYS)})""",
    "scd_at_contract_start": lookup("contract_starts", "contract_start_date"),
    "scd_at_plan_start": lookup("plans_starting", tdate("bp_start_date")),
    "scd_after_plan_end": lookup("plans_ending", "event_date"),
    "scd_at_cancelled_bill": lookup("bill_docs_cancelled", tdate("created_date")),
    "scd_at_credit_memo": lookup("credit_memos", "created_date_yyyy_mm_dd"),
    "scd_at_bill": lookup("bill_docs", tdate("created_date"), f"WHERE created_date BETWEEN {CUT_T} AND {TODAY_T}"),
    "scd_at_sibling_bill": lookup("bill_docs_sibling", tdate("created_date"),
                                  f"WHERE created_date BETWEEN {CUT_T} AND {TODAY_T}"),
    "delta_versions": """
SELECT * FROM {scd_starts}
UNION SELECT * FROM {scd_at_contract_start}
UNION SELECT * FROM {scd_at_plan_start}
UNION SELECT * FROM {scd_after_plan_end}
UNION SELECT * FROM {scd_at_cancelled_bill}
UNION SELECT * FROM {scd_at_credit_memo}
UNION SELECT * FROM {scd_at_bill}
UNION SELECT * FROM {scd_at_sibling_bill}""",
    "with_plans": f"""
SELECT {sel('v', KEYS)}, v.start_date, CAST(NULL AS DATE) AS end_date,
 v.billing_block_header, v.billing_block_item, v.cancellation_reason, v.cancellation_reason_old,
 v.reason_for_rejection, v.subscription_quantity, v.created_date, p.bp_no, p.bp_item, p.bp_start_date,
 p.bp_end_date, p.bp_billing_block, p.bp_net_price, v.first_pmt_success_date, p.bp_upd_ind
FROM {{delta_versions}} v
LEFT JOIN {{plan_items}} p ON {on('v', 'p', KEYS)}
 AND strftime(v.start_date, '%Y%m%d') >= p.bp_start_date AND strftime(v.start_date, '%Y%m%d') <= p.bp_end_date""",
    "billed_before": f"""
SELECT DISTINCT {sel('t', VKEYS)} FROM {{with_plans}} t
WHERE EXISTS (SELECT 1 FROM {{bill_docs}} b WHERE {on('t', 'b', KEYS + ['bp_no', 'bp_item'])}
              AND {tdate('b.created_date')} <= t.start_date)""",
    "sibling_billed_before": f"""
SELECT DISTINCT {sel('t', VKEYS)} FROM {{with_plans}} t
WHERE EXISTS (SELECT 1 FROM {{bill_docs_sibling}} b WHERE {on('t', 'b', KEYS + ['bp_no'])}
              AND b.bp_end_date <= t.bp_end_date AND {tdate('b.created_date')} <= t.start_date)""",
    "pipeline_status_input": f"""
SELECT t.*, d.sales_document_type, d.contract_start_date_bp, d.contract_end_date_bp, d.payment_method,
 d.billing_frequency, d.subscription_category, d.trial_order_flag, v.order_reason,
 m.sales_document AS memo_doc, m.order_reason AS memo_reason, b.sales_document AS billed_doc,
 b2.sales_document AS billed2_doc, {tdate('t.bp_start_date')} AS bp_start
FROM {{with_plans}} t
JOIN {{subs}} d ON {on('t', 'd', KEYS)}
JOIN {{order_hdr}} v ON t.client = v.mandt AND t.sales_document = v.vbeln
LEFT JOIN (SELECT DISTINCT client, sales_document, sales_document_item, created_date_yyyy_mm_dd, order_reason
           FROM {{credit_memos}}) m ON {on('t', 'm', KEYS)} AND t.start_date = m.created_date_yyyy_mm_dd
LEFT JOIN {{billed_before}} b ON {on('t', 'b', VKEYS)}
LEFT JOIN {{sibling_billed_before}} b2 ON {on('t', 'b2', VKEYS)}""",
    "pipeline_ruled": ruled_pipeline("pipeline_status_input"),
    "status_rows": f"""
SELECT DISTINCT client, sales_document, sales_document_item, start_date, CAST(NULL AS DATE) AS end_date,
 sales_document_type, billing_block_header, billing_block_item, bp_billing_block, bp_net_price,
 bp_start AS bp_start_date, cancellation_reason, cancellation_reason_old,
 contract_start_date_bp AS contract_start_date, contract_end_date_bp AS contract_end_date, created_date,
 reason_for_rejection, subscription_status, {INIT_FLAG} AS init_inactive_flag, subscription_quantity,
 client || CAST(sales_document AS VARCHAR) || CAST(sales_document_item AS VARCHAR) || CAST(start_date AS VARCHAR) AS link_id,
 CAST(NULL AS VARCHAR) AS prev_link_id, subscription_category, bp_upd_ind
FROM {{pipeline_ruled}}""",
    "reopened": f"""
SELECT {sel('o', TARGET_COLS)}, c.subscription_category, c.bp_upd_ind
FROM {{status_hist}} o
JOIN (SELECT client, sales_document, sales_document_item, max(subscription_category) AS subscription_category,
             max(bp_upd_ind) AS bp_upd_ind FROM {{status_rows}} GROUP BY ALL) c ON {on('o', 'c', KEYS)}
WHERE o.start_date <= {CUT_SCD_D} AND o.end_date >= {CUT_SCD_D}""",
    "union_reopened": "SELECT * FROM {status_rows} UNION ALL SELECT * FROM {reopened}",
    "deduped": f"""
SELECT * EXCLUDE (_rn) FROM (
 SELECT *, row_number() OVER (PARTITION BY {', '.join(VKEYS)} ORDER BY {_DEDUPE_ORDER}) AS _rn
 FROM {{union_reopened}}) WHERE _rn = 1""",
    "dropped": f"""
SELECT * EXCLUDE (_prev) FROM (SELECT *, lag(subscription_status) {w()} AS _prev FROM {{deduped}})
WHERE NOT coalesce(subscription_status = 'ACTIVE' AND _prev = 'INACTIVE' AND cancellation_reason = 'SC'
                   AND cancellation_reason_old = 'SA', false)""",
    "collapsed": f"""
SELECT * EXCLUDE (_prev) FROM (SELECT *, lag(subscription_status) {w()} AS _prev FROM {{dropped}})
WHERE NOT coalesce(subscription_status = _prev, false)""",
    "versions": f"""
SELECT * REPLACE (lag(link_id) {w()} AS prev_link_id,
                  coalesce(lead(start_date) {w()} - 1, DATE '9999-12-31') AS end_date)
FROM {{collapsed}}""",
    "enriched": f"""
SELECT {sel('v', STATUS_COLS)}, d.route_to_market, k.inco3_l
FROM {{versions}} v JOIN {{dim}} d ON {on('v', 'd', KEYS)}
LEFT JOIN {{business}} k ON k.mandt = v.client AND k.vbeln = v.sales_document AND k.posnr = v.sales_document_item""",
    "final_rows": """
SELECT client, sales_document, sales_document_item, start_date, end_date, sales_document_type,
 billing_block_header, billing_block_item, bp_billing_block, bp_net_price, bp_start_date,
 CASE WHEN subscription_status = 'INACTIVE' AND route_to_market = 'APP STORE' AND inco3_l = 'BILLING_ERROR' THEN 'SA'
      WHEN subscription_status = 'INACTIVE' AND cancellation_reason = 'SC' AND bp_upd_ind = 'RTNE' THEN 'SA'
      ELSE cancellation_reason END AS cancellation_reason,
 cancellation_reason_old, contract_start_date, contract_end_date, created_date,
 CASE WHEN subscription_status = 'INACTIVE' AND route_to_market = 'APP STORE' AND inco3_l = 'BILLING_ERROR' THEN ''
      WHEN subscription_status = 'INACTIVE' AND cancellation_reason = 'SC' AND bp_upd_ind = 'RTNE' THEN ''
      ELSE reason_for_rejection END AS reason_for_rejection,
 subscription_status, init_inactive_flag, subscription_quantity, link_id, prev_link_id,
 TIMESTAMP '1998-06-30 00:00:00' AS last_modified
FROM {enriched}""",
    "merged": "SELECT " + ", ".join(
        [f"coalesce(t.{k}, s.{k}) AS {k}" for k in VKEYS]
        + [f"CASE WHEN s._src IS NOT NULL THEN s.{x} ELSE t.{x} END AS {x}" for x in TARGET_COLS[4:]]
        + ["CASE WHEN s._src IS NOT NULL THEN s.last_modified END AS last_modified"]) + f"""
FROM {{status_hist}} t
FULL OUTER JOIN (SELECT *, true AS _src FROM {{final_rows}}) s ON {on('t', 's', VKEYS)}""",
    "plan_ranges": f"""
SELECT {sel('d', KEYS)}, p.bp_no, p.bp_item, {tdate('p.bp_start_date')} AS bp_start_date,
 {tdate('p.bp_end_date')} AS bp_end_date, p.bp_upd_ind
FROM {{plan_delta}} p JOIN {{dim}} d ON p.bp_no = d.bill_plan_number""",
    "merged_with_plan_flag": f"""
SELECT m.*, r.bp_upd_ind AS upd_ind
FROM {{merged}} m
LEFT JOIN (
 SELECT * FROM (
  SELECT {sel('t', VKEYS)}, p.bp_upd_ind, row_number() OVER (
    PARTITION BY {sel('t', VKEYS)}
    ORDER BY p.bp_start_date DESC, p.bp_item DESC, p.bp_no DESC, p.bp_upd_ind DESC) AS _rn
  FROM {{merged}} t JOIN {{plan_ranges}} p ON {on('t', 'p', KEYS)}
   AND t.start_date >= p.bp_start_date AND t.start_date <= p.bp_end_date)
 WHERE _rn = 1) r ON {on('m', 'r', VKEYS)}""",
    # ---- size inventory over the given tables
    "table_sizes": " UNION ALL ".join(
        f"SELECT 'testdata.{_TABLE_SCHEMAS[t]}.{t}' AS name, CAST({_SIZE_EXPR[t]} AS BIGINT) AS sizeinbytes FROM {{{t}}}"
        for t in BASE_TABLES),
}

# The stages of one run, from the plan delta to the rows it merges: what depends on the run's cutoff and categories.
RUN_STAGES = ["plan_delta", "subs", "plan_items", "plans_starting", "plans_ending", "bill_docs", "bill_docs_sibling",
              "bill_docs_cancelled", "credit_memos", "contract_starts", "scd_starts", "scd_at_contract_start",
              "scd_at_plan_start", "scd_after_plan_end", "scd_at_cancelled_bill", "scd_at_credit_memo", "scd_at_bill",
              "scd_at_sibling_bill", "delta_versions", "with_plans", "billed_before", "sibling_billed_before",
              "pipeline_status_input", "pipeline_ruled", "status_rows", "reopened", "union_reopened", "deduped", "dropped",
              "collapsed", "versions", "enriched", "final_rows", "plan_ranges"]

# The runs by cutoff that the log of FIXTURE_PARAMS asks for: (name, cutoff, the day before, categories).
RUNS = [("a", "1998-05-29", "1998-05-28", "= 'BUILDING'"), ("b", "1998-05-12", "1998-05-11", "= 'SERV'"),
        ("c", "1998-01-01", "1997-12-31", "NOT IN ('BUILDING', 'SERV')")]


def run_stage(name: str, run: tuple[str, str, str, str]) -> str:
    """The stage of one run: the dates of its window, its own predecessors, and its categories' subscriptions."""
    tag, cutoff, day_before, categories = run
    sql = STAGES[name]
    for old, new in (("1998-06-01", cutoff), ("1998-05-31", day_before)):
        sql = sql.replace(old, new).replace(old.replace("-", ""), new.replace("-", ""))
    for dep in RUN_STAGES:
        sql = sql.replace("{" + dep + "}", "{" + f"{dep}_{tag}" + "}")
    if name == "subs":
        sql += f" AND d.subscription_category {categories}"
    if name == "plan_ranges":
        sql += f" WHERE d.subscription_category {categories}"
    return sql


STAGES |= {f"{name}_{run[0]}": run_stage(name, run) for run in RUNS for name in RUN_STAGES}

# Registered query -> final SQL over stages/views.
QUERIES: dict[str, str] = {
    "scan_table": "SELECT * FROM {orders}",
    "project_mixed": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_day,
 strftime(o_orderdate, '%Y%m%d') AS order_day_text, o_totalprice
FROM {orders}""",
    "rename_cols": """
SELECT d.client, d.sales_document, p.bp_no, p.bp_item, p.bp_start_date AS bp_start,
 d.contract_start_date_bp AS contract_start_date
FROM {plan_delta} p JOIN {dim} d ON p.bp_no = d.bill_plan_number""",
    "typed_null": "SELECT *, CAST(NULL AS VARCHAR) AS end_date FROM {delta_versions}",
    "jdbc_like_category_filter": """
SELECT subscription_category, subscription_type, sales_document_type FROM {dim}
WHERE subscription_category = upper('building')""",
    "distinct_category": """
SELECT DISTINCT subscription_category FROM {dim}
WHERE subscription_type = 'IN' AND sales_document_type = 'ZCSB'""",
    "filter_conj": """
SELECT * FROM {dim}
WHERE subscription_type = 'IN' AND sales_document_type = 'ZCSB' AND subscription_category = 'BUILDING'""",
    "cutoff_lookup": """
SELECT c.subscription_category, coalesce(CAST(l.attr_val_dt - INTERVAL 3 DAY AS DATE), DATE '1998-01-01') AS cutoff_date
FROM (SELECT DISTINCT subscription_category FROM {dim} WHERE subscription_type = 'IN' AND sales_document_type = 'ZCSB') c
LEFT JOIN {own_log} l ON 'STATUS_HISTORY_' || c.subscription_category = l.wrkflw_nm""",
    "run_dates": """
SELECT subscription_category, cutoff_date, CAST(cutoff_date - 1 AS DATE) AS cutoff_scd_date,
 strftime(cutoff_date - 1, '%Y%m%d') AS cutoff_scd_text, strftime(cutoff_date, '%Y%m%d') AS cutoff_text,
 '19980630' AS today_text, '19980629' AS yesterday_text
FROM (SELECT c.subscription_category, coalesce(CAST(l.attr_val_dt - INTERVAL 3 DAY AS DATE), DATE '1998-01-01') AS cutoff_date
      FROM (SELECT DISTINCT subscription_category FROM {dim} WHERE subscription_type = 'IN' AND sales_document_type = 'ZCSB') c
      LEFT JOIN {own_log} l ON 'STATUS_HISTORY_' || c.subscription_category = l.wrkflw_nm)""",
    "date_roundtrip": f"""
SELECT bp_no, bp_item, ofkdat, {tdate('ofkdat')} AS ofk_date, {tdate('ofkdat')} + 1 AS ofk_next,
 {tdate('ofkdat')} - 1 AS ofk_prev, strftime({tdate('ofkdat')} - 1, '%Y%m%d') AS ofk_prev_text,
 {tdate('fkdat')} AS fk_date
FROM {{plans}}""",
    "filter_codes": """
SELECT client, sales_document, sales_document_item FROM {hist} WHERE cancellation_reason IN ('S3', 'SC')""",
    "blank_predicates": """
SELECT client, sales_document, sales_document_item, start_date,
 (billing_block_header <> '' AND billing_block_header IS NOT NULL) AS header_block_present,
 (billing_block_item IS NULL OR billing_block_item = '') AS item_block_absent,
 (first_pmt_success_date IS NULL OR first_pmt_success_date = '') AS first_payment_absent,
 reason_for_rejection IS NULL AS rejection_is_null
FROM {hist}""",
    "as_of_snapshot": f"SELECT * FROM {{hist}} WHERE {CUT_SCD_D} BETWEEN start_date AND end_date",
    "text_date_window": f"SELECT * FROM {{bill_item}} WHERE created_date BETWEEN {CUT_T} AND {TODAY_T}",
    "plan_delta_filter": "SELECT * FROM {plan_delta}",
    "plan_join": "SELECT * FROM {plan_items}",
    "contract_start_delta": "SELECT * FROM {contract_starts}",
    "param_flag": "SELECT * FROM {subs}",
    "bill_docs": "SELECT * FROM {bill_docs}",
    "bill_docs_sibling": "SELECT * FROM {bill_docs_sibling}",
    "bill_docs_cancelled": "SELECT * FROM {bill_docs_cancelled}",
    "credit_memo_origin": "SELECT * FROM {credit_memos}",
    "scd_start_delta": "SELECT * FROM {scd_starts}",
    "scd_at_contract_start": "SELECT * FROM {scd_at_contract_start}",
    "scd_at_plan_start": "SELECT * FROM {scd_at_plan_start}",
    "scd_after_plan_end": "SELECT * FROM {scd_after_plan_end}",
    "scd_at_credit_memo": "SELECT * FROM {scd_at_credit_memo}",
    "scd_at_cancelled_bill": "SELECT * FROM {scd_at_cancelled_bill}",
    "scd_at_bill": "SELECT * FROM {scd_at_bill}",
    "scd_at_sibling_bill": "SELECT * FROM {scd_at_sibling_bill}",
    "delta_union_distinct": "SELECT * FROM {delta_versions}",
    "scd_plan_left_interval": "SELECT * FROM {with_plans}",
    "billed_before": "SELECT * FROM {billed_before}",
    "sibling_billed_before": "SELECT * FROM {sibling_billed_before}",
    "status_join": "SELECT * FROM {pipeline_status_input}",
    "self_alias_join": f"""
SELECT {sel('t', VKEYS)}, t.bp_no, t.bp_item,
 EXISTS (SELECT 1 FROM {{bill_docs_cancelled}} a WHERE {on('t', 'a', KEYS + ['bp_no', 'bp_item'])}
         AND {tdate('a.created_date')} = t.start_date) AS billed_same_item,
 EXISTS (SELECT 1 FROM {{bill_docs_cancelled}} b WHERE {on('t', 'b', KEYS + ['bp_no', 'bp_end_date'])}
         AND {tdate('b.created_date')} = t.start_date) AS billed_same_end
FROM {{with_plans}} t""",
    "status_rules": """
SELECT client, sales_document, sales_document_item, start_date, bp_no, bp_item, subscription_status, status_rule
FROM {fixture_ruled}""",
    "init_inactive_flag": f"""
SELECT client, sales_document, sales_document_item, start_date, bp_no, bp_item, subscription_status,
 {INIT_FLAG} AS init_inactive_flag
FROM {{fixture_ruled}}""",
    "status_distinct": "SELECT * FROM {status_rows}",
    "lag_status": f"SELECT *, lag(subscription_status) {w()} AS lag_subscription_status FROM {{hist}}",
    "drop_reactivation": f"""
SELECT * EXCLUDE (_prev) FROM (SELECT *, lag(subscription_status) {w()} AS _prev FROM {{hist}})
WHERE NOT coalesce(subscription_status = 'ACTIVE' AND _prev = 'INACTIVE' AND cancellation_reason = 'SC'
                   AND cancellation_reason_old = 'SA', false)""",
    "collapse_runs": f"""
SELECT * EXCLUDE (_prev) FROM (SELECT *, lag(subscription_status) {w()} AS _prev FROM {{hist}})
WHERE NOT coalesce(subscription_status = _prev, false)""",
    "link_versions": f"""
SELECT *, lag(link_id) {w()} AS prev_link_id FROM (
 SELECT * EXCLUDE (_prev), client || CAST(sales_document AS VARCHAR) || CAST(sales_document_item AS VARCHAR)
   || CAST(start_date AS VARCHAR) AS link_id
 FROM (SELECT *, lag(subscription_status) {w()} AS _prev FROM {{hist}})
 WHERE NOT coalesce(subscription_status = _prev, false))""",
    "close_intervals": f"""
SELECT * REPLACE (coalesce(lead(start_date) {w()} - 1, DATE '9999-12-31') AS end_date) FROM (
 SELECT * EXCLUDE (_prev) FROM (SELECT *, lag(subscription_status) {w()} AS _prev FROM {{hist}})
 WHERE NOT coalesce(subscription_status = _prev, false))""",
    "close_intervals_observed": f"""
SELECT * REPLACE (CASE WHEN lag(link_id) {w()} IS NULL THEN prev_link_id END AS prev_link_id,
                  CASE WHEN lead(start_date - 1) {w()} IS NULL THEN '9999-12-31' END AS end_date) FROM (
 SELECT * EXCLUDE (_prev), client || CAST(sales_document AS VARCHAR) || CAST(sales_document_item AS VARCHAR)
   || CAST(start_date AS VARCHAR) AS link_id, CAST(NULL AS VARCHAR) AS prev_link_id
 FROM (SELECT *, lag(subscription_status) {w()} AS _prev FROM {{hist}})
 WHERE NOT coalesce(subscription_status = _prev, false))""",
    "user_status_intervals": f"""
SELECT *, coalesce(lead(start_ts) {w('start_ts', ['user_id'])} - INTERVAL 1 MICROSECOND,
                   TIMESTAMP '9999-12-31 00:00:00') AS end_ts
FROM (SELECT * EXCLUDE (_prev) FROM (SELECT *, lag(status) {w('start_ts', ['user_id'])} AS _prev FROM {{user_hist}})
      WHERE NOT coalesce(status = _prev, false))""",
    "reopen_open_rows": "SELECT * FROM {reopened}",
    "union_reopened": "SELECT * FROM {union_reopened}",
    "rebuild_intervals": "SELECT * FROM {versions}",
    "enrich_final": "SELECT * FROM {enriched}",
    "reason_rewrite": "SELECT " + ", ".join(FINAL_COLS) + " FROM {final_rows}",
    "merge_upsert": "SELECT * FROM {merged}",
    "final_rows_by_cutoff": " UNION ALL ".join("SELECT " + ", ".join(FINAL_COLS) + f" FROM {{final_rows_{run[0]}}}" for run in RUNS),
    "plan_ranges_by_cutoff": " UNION ALL ".join(f"SELECT * FROM {{plan_ranges_{run[0]}}}" for run in RUNS),
    "merge_range_update": "SELECT * FROM {merged_with_plan_flag}",
    # governance over customers with their country
    "row_filter_if": """
SELECT * FROM {customer_geo}
WHERE IF(country_name IS NULL, true, right(country_name, 1) IN ('0', '2', '4', '6', '8'))""",
    "row_filter_null_safe": """
SELECT * FROM {customer_geo}
WHERE IF(country_name IS NULL, false, country_name IN ('NATION_1', 'NATION_2', 'NATION_3'))""",
    "tag_rule_filter": """
SELECT * FROM {customer_geo}
WHERE IF(country_name IS NULL, false, country_name IN ('NATION_4', 'NATION_5'))""",
    "column_mask_group": """
SELECT c_custkey, '(hidden)' AS c_name, c_acctbal, c_mktsegment, country_name FROM {customer_geo}""",
    "column_mask_member": "SELECT * FROM {customer_geo}",
    "column_mask_function": """
SELECT c_custkey, '..' || right(c_name, 3) AS c_name, c_acctbal, c_mktsegment, country_name FROM {customer_geo}""",
    "membership_nested": """
SELECT principal, group_name, max(direct) AS direct FROM (
 SELECT principal, group_name, true AS direct FROM {customer_groups}
 UNION ALL SELECT g.principal, c.in_group, false FROM {customer_groups} g JOIN (
  WITH RECURSIVE inside(group_name, in_group) AS (
   SELECT group_name, in_group FROM {group_nesting} UNION
   SELECT i.group_name, n.in_group FROM inside i JOIN {group_nesting} n ON i.in_group = n.group_name)
  SELECT * FROM inside WHERE group_name <> in_group) c ON c.group_name = g.group_name)
GROUP BY ALL""",
    "groups_of_user": """
SELECT group_name, max(direct) AS direct FROM (
 SELECT group_name, true AS direct FROM {customer_groups} WHERE principal = (SELECT min(c_name) FROM {customer})
 UNION ALL SELECT in_group, false FROM (
  WITH RECURSIVE inside(group_name, in_group) AS (
   SELECT group_name, in_group FROM {group_nesting} WHERE group_name IN (
     SELECT group_name FROM {customer_groups} WHERE principal = (SELECT min(c_name) FROM {customer})) UNION
   SELECT i.group_name, n.in_group FROM inside i JOIN {group_nesting} n ON i.in_group = n.group_name)
  SELECT * FROM inside WHERE group_name <> in_group))
GROUP BY ALL""",
    "policy_view_member": """
SELECT g.* FROM {customer_geo} g
WHERE EXISTS (SELECT 1 FROM {country_access} a WHERE a.principal = 'building' AND a.country_name = g.country_name)""",
    "policy_view_other": """
SELECT c_custkey, '(hidden)' AS c_name, c_acctbal, c_mktsegment, country_name FROM {customer_geo} g
WHERE EXISTS (SELECT 1 FROM {country_access} a WHERE a.principal = 'machinery' AND a.country_name = g.country_name)""",
    "split_scan": "SELECT o_orderkey, o_orderdate, o_orderpriority FROM {orders}",
    "tag_rule_two_columns": """
SELECT DISTINCT l_orderkey, l_suppkey, g.country_name, n_name AS supplier_country
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer_geo} g ON o_custkey = c_custkey
JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
WHERE g.country_name IN ('NATION_3', 'NATION_4', 'NATION_5', 'NATION_6', 'NATION_7', 'NATION_8')
 AND n_name IN ('NATION_3', 'NATION_4', 'NATION_5', 'NATION_6', 'NATION_7', 'NATION_8')""",
    "inventory_by_schema": """
SELECT split_part(name, '.', 1) AS catalog_name, split_part(name, '.', 2) AS schema_name,
 round(sum(round(sizeinbytes / 1000000, 2)), 2) AS schema_size_mb
FROM {table_sizes} WHERE sizeinbytes > 0 GROUP BY ALL HAVING schema_size_mb > 0""",
    "inventory_skip_schemas": """
SELECT split_part(name, '.', 1) AS catalog_name, split_part(name, '.', 2) AS schema_name,
 split_part(name, '.', -1) AS table_name, sizeinbytes, round(sizeinbytes / 1000000, 2) AS size_mb
FROM {table_sizes} WHERE sizeinbytes > 0 AND split_part(name, '.', 2) <> 'events' AND split_part(name, '.', 2) <> 'corpus'""",
    "inventory_by_table": """
SELECT split_part(name, '.', 1) AS catalog_name, split_part(name, '.', 2) AS schema_name,
 split_part(name, '.', -1) AS table_name, sizeinbytes, round(sizeinbytes / 1000000, 2) AS size_mb
FROM {table_sizes} WHERE sizeinbytes > 0""",
}


def _resolve(name: str) -> str:
    if name in STAGES:
        return STAGES[name]
    if name in VIEWS:
        return VIEWS[name]
    raise KeyError(name)


def render(sql: str) -> str:
    """Inline every view/stage ``sql`` depends on as a CTE (dependencies first)."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen or name in BASE_TABLES:
            return
        seen.add(name)
        for dep in view_deps(_resolve(name)):
            visit(dep)
        order.append(name)

    for dep in view_deps(sql):
        visit(dep)
    names = {n: n for n in view_deps(sql)}
    ctes = []
    for n in order:
        body = _resolve(n)
        # a stage that several others read is computed once
        ctes.append(f"{n} AS {'MATERIALIZED ' if n in STAGES else ''}({body.format(**{d: d for d in view_deps(body)})}\n)")
    final = sql.format(**names)
    return ("WITH " + ",\n".join(ctes) + "\n" + final) if ctes else final


def oracle_sql() -> dict[str, str]:
    return {k: render(v) for k, v in QUERIES.items()}
