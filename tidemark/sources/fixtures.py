"""Fixture views: the source schemas of the history job, derived from the test tables.

Each view is one SQL statement over the given parquet tables. The same text
runs on Spark (``spark.sql`` with DataFrame arguments, no global temp views)
and, as CTEs, in the DuckDB oracle, so both sides see identical inputs.
Placeholders ``{name}`` name another view or a base table.
"""

from __future__ import annotations

import hashlib
import os
import string
import threading
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.common import ITEM_KEYS
from tidemark.sources.tables import drop_stages, stage_by_key, stage_table

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Run window pinned for the fixtures: as_of 1998-06-30, cutoff 1998-06-01.
FIXTURE_TODAY = "1998-06-30"
FIXTURE_CUTOFF = "1998-06-01"

VIEWS: dict[str, str] = {
    # FPLT: billing plan items
    "plans": """
SELECT '010' AS client, l_orderkey AS bp_no, l_linenumber AS bp_item,
 CASE WHEN l_linenumber % 5 = 0 THEN '00000000' ELSE replace(CAST(CAST(min(l_shipdate) AS DATE) AS STRING), '-', '') END AS ofkdat,
 replace(CAST(CAST(max(l_shipdate) AS DATE) AS STRING), '-', '') AS fkdat,
 replace(CAST(last_day(CAST(max(l_shipdate) + INTERVAL 30 DAY AS DATE)) AS STRING), '-', '') AS bp_end_date,
 CASE WHEN l_linenumber % 4 = 0 THEN '30' WHEN l_linenumber % 3 = 0 THEN '' WHEN l_linenumber % 2 = 0 THEN '12' END AS bp_billing_block,
 CASE WHEN max(l_tax) > 0.06 THEN NULL ELSE min(l_extendedprice) END AS bp_net_price,
 CASE WHEN max(l_returnflag) = 'R' THEN 'RTNE' ELSE '' END AS bp_upd_ind
FROM {lineitem}
GROUP BY l_orderkey, l_linenumber""",
    # DIM_SUBSCRIPTION
    "dim": """
SELECT '010' AS client, o_orderkey AS sales_document, 10 AS sales_document_item,
 CAST(o_orderdate AS DATE) AS created_date_item, '0' || substr(o_orderpriority, 1, 1) AS payment_method,
 CASE WHEN o_custkey % 5 < 3 AND first_ship IS NOT NULL THEN first_ship ELSE CAST(o_orderdate + INTERVAL 15 DAY AS DATE) END AS contract_start_date_bp,
 CASE WHEN o_custkey % 5 < 3 AND first_ship IS NOT NULL THEN CAST(first_ship + INTERVAL 1460 DAY AS DATE) ELSE CAST(o_orderdate + INTERVAL 730 DAY AS DATE) END AS contract_end_date_bp,
 CASE WHEN o_orderstatus = 'P' THEN 'ZOTH' ELSE 'ZCSB' END AS sales_document_type,
 CASE WHEN c_mktsegment = 'MACHINERY' THEN 'SERV' ELSE c_mktsegment END AS subscription_category, o_orderpriority AS offer_type,
 CASE WHEN o_custkey % 4 = 0 THEN 'APP STORE' ELSE 'DIRECT' END AS route_to_market,
 CASE WHEN o_custkey % 3 = 0 THEN 'PUF' ELSE 'MON' END AS billing_frequency, o_orderkey AS bill_plan_number, 'IN' AS subscription_type
FROM {orders}
JOIN {customer} ON o_custkey = c_custkey
LEFT JOIN (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS first_ship FROM {lineitem} GROUP BY l_orderkey) s ON l_orderkey = o_orderkey""",
    # SCD_SALES_DOCUMENT: closed-interval history of sales document items
    "hist": """
SELECT '010' AS client, l_orderkey AS sales_document, 10 AS sales_document_item,
 CAST(l_shipdate AS DATE) AS start_date,
 coalesce(CAST(lead(CAST(l_shipdate AS DATE)) OVER (PARTITION BY l_orderkey ORDER BY CAST(l_shipdate AS DATE)) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS end_date,
 CASE WHEN max(l_suppkey) % 9 = 1 THEN '08' WHEN max(l_suppkey) % 9 < 5 THEN '' END AS billing_block_header,
 CASE WHEN max(l_partkey) % 13 = 1 THEN '09' WHEN max(l_partkey) % 13 < 7 THEN '' END AS billing_block_item,
 CASE max(l_suppkey) % 8 WHEN 0 THEN 'SC' WHEN 1 THEN 'S3' WHEN 2 THEN 'SA' WHEN 3 THEN 'NB' WHEN 4 THEN 'S2' WHEN 5 THEN '' WHEN 7 THEN 'SC' END AS cancellation_reason,
 CASE max(l_partkey) % 4 WHEN 0 THEN 'SA' WHEN 1 THEN 'S4' WHEN 2 THEN '' END AS cancellation_reason_old,
 CASE max(l_partkey) % 17 WHEN 0 THEN 'S4' WHEN 1 THEN 'R1' WHEN 2 THEN '' END AS reason_for_rejection,
 round(max(l_quantity), 0) AS subscription_quantity,
 CAST(min(CAST(l_shipdate AS DATE)) OVER (PARTITION BY l_orderkey) AS DATE) AS created_date,
 CASE WHEN l_orderkey % 3 = 0 THEN '' WHEN l_orderkey % 3 = 1 THEN '19980101' END AS first_pmt_success_date,
 CASE WHEN max(l_returnflag) = 'R' THEN 'INACTIVE' ELSE 'ACTIVE' END AS subscription_status
FROM {lineitem}
GROUP BY l_orderkey, l_shipdate""",
    # VBRK: billing document headers
    "bill_hdr": """
SELECT '010' AS mandt, o_orderkey AS vbeln,
 CASE WHEN o_orderstatus = 'P' OR o_custkey % 3 = 1 THEN 'G2' ELSE 'F2' END AS fkart
FROM {orders}""",
    # VBRP: billing document items
    "bill_item": """
SELECT '010' AS mandt, l_orderkey AS billing_document, l_linenumber AS billing_document_item, l_orderkey AS sales_document, 10 AS sales_document_item, l_orderkey AS bp_no, l_linenumber AS bp_item,
 replace(CAST(last_day(CAST(max(l_shipdate) + INTERVAL 30 DAY AS DATE)) AS STRING), '-', '') AS bp_end_date,
 replace(CAST(CAST(min(l_shipdate) + INTERVAL 5 DAY AS DATE) AS STRING), '-', '') AS created_date
FROM {lineitem}
GROUP BY l_orderkey, l_linenumber""",
    # VBAP: sales order items, with their originating document
    "order_line": """
SELECT '010' AS mandt, o_orderkey AS vbeln, 10 AS posnr, o_orderkey - o_orderkey % 2 AS vgbel, 10 AS vgpos
FROM {orders}""",
    # VBAK: sales order headers
    "order_hdr": """
SELECT '010' AS mandt, o_orderkey AS vbeln,
 CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '911' WHEN '2' THEN 'SCC' WHEN '3' THEN '921' WHEN '4' THEN '' WHEN '5' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'HCC' END END AS order_reason
FROM {orders}""",
    # VBKD: business data of sales documents
    "business": """
SELECT '010' AS mandt, o_orderkey AS vbeln, 10 AS posnr,
 CASE WHEN o_custkey % 5 = 0 THEN 'BILLING_ERROR' END AS inco3_l
FROM {orders}""",
    # SUBSCRIPTION_PARAMS (policy table, fixed size)
    "params": """
SELECT *
FROM (VALUES ('TWP_OFFERS','OFFER_TYPE','1-URGENT'),('TWP_OFFERS','OFFER_TYPE','2-HIGH'),('OTHER','OFFER_TYPE','5-LOW')) AS t(param_categ, param_name, param_val)""",
    # process_delta_log: last processed date per schema, group, workflow with category, and attribute
    "cutoff_log": """
SELECT *
FROM (VALUES ('common','SUBSCRIPTION','STATUS_HISTORY_BUILDING','CUTOFF',DATE '1998-06-01'),('common','SUBSCRIPTION','STATUS_HISTORY_SERV','CUTOFF',DATE '1998-05-15'),('common','SUBSCRIPTION','OTHER_JOB_BUILDING','CUTOFF',DATE '1998-06-20'),('common','SUBSCRIPTION','STATUS_HISTORY_SERV','ROWS',DATE '1998-06-21'),('other','SUBSCRIPTION','STATUS_HISTORY_HOUSEHOLD','CUTOFF',DATE '1998-06-22')) AS t(schma_nm, grp_nm, wrkflw_nm, attr_nm, attr_val_dt)""",
    # second history, keyed by user
    "user_hist": """
SELECT user_id, ts AS start_ts, event_type,
 CASE WHEN event_type = 'error' THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
FROM {events}""",
    # group membership (policy table)
    "membership": """
SELECT *
FROM (VALUES ('alice','HR'),('alice','admins'),('bob','eng')) AS t(principal, group_name)""",
    # groups of customers: one per country, one per market segment
    "customer_groups": """
SELECT c_name AS principal, 'country ' || n_name AS group_name
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL SELECT c_name, 'segment ' || c_mktsegment FROM {customer}""",
    # groups in groups: countries in regions, regions in one group, which is in the group of some countries (cycles)
    "group_nesting": """
SELECT 'country ' || n_name AS group_name, 'region ' || r_name AS in_group
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL SELECT 'region ' || r_name, 'everywhere' FROM {region}
UNION ALL SELECT 'everywhere', 'country ' || n_name FROM {nation} WHERE n_nationkey % 10 = 3
UNION ALL SELECT 'segment ' || c_mktsegment, 'region ' || r_name
FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM {customer} WHERE c_custkey % 50 = 0) JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # countries whose customers each segment's manager may see (access table of the policy view)
    "country_access": """
SELECT DISTINCT lower(c_mktsegment) AS principal, n_name AS country_name
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey WHERE c_acctbal > 9000""",
    # customers with their country: the governed table of the policy queries
    "customer_geo": """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n_name AS country_name
FROM {customer}
LEFT JOIN {nation} ON c_nationkey = n_nationkey""",
    # SCD_IN_SUBS_STATUS: the status history the run merges into, derived from hist
    "status_hist": """
SELECT h.client, h.sales_document, h.sales_document_item, h.start_date, h.end_date,
 d.sales_document_type, h.billing_block_header, h.billing_block_item,
 CAST(NULL AS STRING) AS bp_billing_block, CAST(NULL AS DOUBLE) AS bp_net_price, CAST(NULL AS DATE) AS bp_start_date,
 h.cancellation_reason, h.cancellation_reason_old,
 d.contract_start_date_bp AS contract_start_date, d.contract_end_date_bp AS contract_end_date,
 h.created_date, h.reason_for_rejection, h.subscription_status,
 CASE WHEN h.subscription_status = 'INACTIVE' AND h.created_date = h.start_date THEN 'Y' ELSE 'N' END AS init_inactive_flag,
 h.subscription_quantity,
 h.client || CAST(h.sales_document AS STRING) || CAST(h.sales_document_item AS STRING) || CAST(h.start_date AS STRING) AS link_id,
 CAST(NULL AS STRING) AS prev_link_id
FROM {hist} h
JOIN {dim} d ON d.client = h.client AND d.sales_document = h.sales_document AND d.sales_document_item = h.sales_document_item""",
}


# Staged views that are grouped and joined by item are bucketed by it, as stored source tables would be. The status history
# comes out of its statement clustered by item already. The order lines are moved once, by order, for all views.
BY_ITEM = {"dim", "hist", "status_hist"}
CLUSTERED = {"status_hist"}
LINES = ("lineitem", "l_orderkey", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                    "l_tax", "l_returnflag", "l_shipdate"])
# Stored bytes of order lines per bucket, and the least and greatest number of buckets.
BUCKET_BYTES, MIN_BUCKETS, MAX_BUCKETS = 4 * 1024 * 1024, 8, 4096


def view_deps(sql: str) -> list[str]:
    return [name for _, name, _, _ in string.Formatter().parse(sql) if name]


OF_LINES = [name for name, sql in VIEWS.items() if LINES[0] in view_deps(sql)]


# Derived views staged once per process and session (they stand for stored source tables).
_STAGED: dict[tuple[str, str, str, str], DataFrame] = {}


def _session_key(spark: SparkSession) -> str:
    """The Spark application id (a new session after a stop gets a new one)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - sessions without a SparkContext
        return str(id(spark))


def files_version(spark: SparkSession, sf_dir: str) -> str:
    """Changes when a file of the folder does: names, lengths and times from a listing (files, and folders of files)."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(sf_dir).getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(folder) -> list[str]:
        out = []
        for f in fs.listStatus(folder):
            out.append(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}")
            if f.isDirectory():
                out += listed(f.getPath())
        return out

    return hashlib.md5("\n".join(sorted(listed(path(sf_dir)))).encode()).hexdigest()


_PROCESS_TOKEN = f"{os.getpid()}-{uuid.uuid4().hex[:8]}"
_LOCK = threading.RLock()


class Fixtures:
    """Fixture views for one scale-factor directory.

    With ``stage=True`` (default) each derived view is written once per process
    as parquet under the session's checkpoint folder and read back, like the
    stored source tables it stands for (bucketed by item, see ``BY_ITEM``); queries then
    scan it instead of re-deriving it from the raw tables. A view is staged when a
    query first reads it. ``stage=False`` keeps pure views.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stage: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.stage = stage
        self.version = files_version(spark, self.sf_dir)
        self._cache: dict[str, DataFrame] = {}

    @cached_property
    def buckets(self) -> int:
        """Buckets of the staged views: they grow in number with the order lines."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/lineitem.parquet")
        size = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
        return min(MAX_BUCKETS, max(MIN_BUCKETS, -(-size // BUCKET_BYTES)))

    def _key(self, name: str) -> tuple[str, str, str, str]:
        return _session_key(self.spark), self.sf_dir, self.version, name

    def _path(self, name: str) -> str:
        return f"fixtures-{_PROCESS_TOKEN}/{self.sf_dir.strip('/').replace('/', '_')}/{self.version}/{name}"

    def _staged(self, name: str, key: tuple, make) -> DataFrame:
        if key not in _STAGED:
            _STAGED[key] = make(self._path(name))
        return _STAGED[key]

    def _dependency(self, name: str) -> DataFrame:
        """What a view reads under ``name``: the order lines come clustered by order, so that no view moves them again."""
        if not self.stage or name != LINES[0]:
            return self.table(name)
        name, by, columns = LINES
        return self._staged(f"{name}-by-{by}", self._key(f"{name} by {by}"), lambda path: stage_by_key(
            self.table(name).select(*columns), path, [by], self.buckets))

    def _drop_lines(self) -> None:
        """The order lines stored by order go once every view that reads them is staged."""
        name, by, _ = LINES
        if all(self._key(view) in _STAGED for view in OF_LINES) and _STAGED.pop(self._key(f"{name} by {by}"), None) is not None:
            drop_stages(self.spark, self._path(f"{name}-by-{by}"))

    def table(self, name: str) -> DataFrame:
        with _LOCK:
            return self._table(name)

    def _table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                key = self._key(name)
                if self.stage and key in _STAGED:
                    self._cache[name] = _STAGED[key]
                    return self._cache[name]
                sql = VIEWS[name]
                deps = {d: self._dependency(d) for d in view_deps(sql)}
                df = self.spark.sql(sql, **deps) if deps else self.spark.sql(sql)
                if self.stage:
                    view = df
                    df = self._staged(name, key, lambda path: stage_by_key(
                        view, path, ITEM_KEYS, self.buckets, moved=name not in CLUSTERED)
                        if name in BY_ITEM else stage_table(view, path))
                    self._drop_lines()
                self._cache[name] = df
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in VIEWS and name not in BASE_TABLES):
            raise AttributeError(name)
        return self.table(name)

    @cached_property
    def names(self) -> list[str]:
        return list(VIEWS)
