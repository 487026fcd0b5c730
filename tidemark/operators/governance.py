"""Row filters, column masks and tag rules as DataFrame operators.

Open-source Spark has no catalog-side policy DDL, so the rewrite a governed
catalog would apply on every SELECT is made explicit: ``secured(df, ...)``
returns the frame a principal may see. Policies are plain ``Column``
expressions (or SQL temporary functions, which Spark inlines into the plan),
so filtering stays in whole-stage codegen and pushes down like any predicate.

Membership is resolved once per principal and group into a boolean literal;
the membership table is a policy table, and the lookup reads at most one row.
Groups may be members of groups (``group_closure``), in cycles too.

``secured_view`` states the same policies as one SQL view that resolves them when it is queried: the principal is a
session variable (or ``current_user()``), the allowed values are a semi join and the masks a lookup.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import stage_table

TAG_KEY = "tags"
# Rows of all memberships that one task makes distinct.
MEMBERSHIP_ROWS = 1_000_000


# ---- predicates and SQL functions --------------------------------------------

def register_sql_function(spark: SparkSession, name: str, params: str, body: str,
                          returns: str | None = None) -> Callable[..., Column]:
    """``CREATE OR REPLACE TEMPORARY FUNCTION name(params) [RETURNS t] RETURN body``.

    Returns a callable building ``name(col, ...)`` so the function can serve as
    a row filter or a mask.
    """
    ret = f" RETURNS {returns}" if returns else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}){ret} RETURN {body}")
    return lambda *cols: F.call_function(name, *[F.col(x) if isinstance(x, str) else x for x in cols])


def if_filter(cond: Column, when_true: Column | bool, when_false: Column | bool) -> Column:
    """``IF(cond, expr1, expr2)`` where the arms are predicates or booleans."""
    t = when_true if isinstance(when_true, Column) else F.lit(when_true)
    f = when_false if isinstance(when_false, Column) else F.lit(when_false)
    return F.when(cond, t).otherwise(f)


def apply_row_filter(df: DataFrame, fn: Callable[..., Column], columns: Sequence[str]) -> DataFrame:
    """Keep rows where ``fn(*columns)`` is true; a NULL result drops the row. Duplicates stay."""
    return df.where(F.coalesce(fn(*[F.col(x) for x in columns]), F.lit(False)))


# ---- membership and masks --------------------------------------------------------

def is_member(membership: DataFrame, principal: str, group: str,
              principal_col: str = "principal", group_col: str = "group_name") -> bool:
    """True when ``principal`` belongs to ``group`` (reads at most one row)."""
    hit = membership.where((F.col(principal_col) == principal) & (F.col(group_col) == group)).limit(1)
    return len(hit.take(1)) > 0


def group_closure(nesting: DataFrame, group_col: str = "group_name", in_col: str = "in_group") -> DataFrame:
    """Every group with every other group it is in, directly or through groups: distinct ``group_col, in_col``.

    Each round extends the pairs found last by one step and keeps the new ones, so a cycle ends it and a pair that many
    paths lead to is followed once (a recursive query with UNION ALL would follow every path). Rounds are as many as the
    longest chain of groups; pairs are staged, and only their emptiness reaches the driver.
    """
    run = uuid.uuid4().hex[:12]
    a, b = F.col(group_col), F.col(in_col)
    step = nesting.where(a.isNotNull() & b.isNotNull() & (a != b)).select(a.alias(group_col), b.alias(in_col)).distinct()
    step = stage_table(step, f"groups/{run}/step")
    found = new = step
    k = 0
    while not new.isEmpty():
        longer = new.select(a, b.alias("_via")).join(step.select(a.alias("_via"), b), "_via").select(group_col, in_col)
        new = stage_table(longer.where(a != b).distinct().join(found, [group_col, in_col], "left_anti"), f"groups/{run}/new-{k}")
        found = stage_table(found.unionByName(new), f"groups/{run}/found-{k}")
        k += 1
    return found


def all_memberships(membership: DataFrame, nesting: DataFrame, principal_col: str = "principal",
                    group_col: str = "group_name", in_col: str = "in_group") -> DataFrame:
    """``principal_col, group_col, direct``: the groups of every principal, its own and those that they are in.

    Nested groups multiply the rows, so they are counted first (own rows by group, times the groups that one is in) and
    dealt to as many tasks as hold ``MEMBERSHIP_ROWS`` each before they are made distinct.
    """
    own = membership.where(F.col(principal_col).isNotNull() & F.col(group_col).isNotNull()).select(principal_col, group_col)
    closure = group_closure(nesting, group_col, in_col)
    through = own.join(closure, group_col).select(F.col(principal_col), F.col(in_col).alias(group_col))
    outer = closure.groupBy(group_col).agg(F.count(F.lit(1)).alias("_outer"))
    rows = own.groupBy(group_col).count().join(outer, group_col, "left").agg(
        F.sum(F.col("count") * (F.coalesce("_outer", F.lit(0)) + 1))).first()[0] or 0
    both = own.withColumn("direct", F.lit(True)).unionByName(through.withColumn("direct", F.lit(False)))
    both = both.repartition(max(1, -(-rows // MEMBERSHIP_ROWS)), principal_col, group_col)
    return both.groupBy(principal_col, group_col).agg(F.max("direct").alias("direct"))


def groups_of(membership: DataFrame, nesting: DataFrame, principal: str, principal_col: str = "principal",
              group_col: str = "group_name", in_col: str = "in_group") -> DataFrame:
    """The groups of one user, ``group_col, direct`` (the listing of a user's groups)."""
    own = membership.where(F.col(principal_col) == principal)
    return all_memberships(own, nesting, principal_col, group_col, in_col).select(group_col, "direct")


Mask = object | Callable[[Column], Column]


def mask_column(df: DataFrame, column: str, visible: bool | Column, mask: Mask) -> DataFrame:
    """Full value when ``visible``, else ``mask``: a constant, or a function of the value (a registered SQL one, say).

    The masked value is cast to the column's type.
    """
    vis = visible if isinstance(visible, Column) else F.lit(bool(visible))
    dtype = df.schema[column].dataType
    masked = mask(F.col(column)) if callable(mask) else F.lit(mask)
    return df.withColumn(column, F.when(vis, F.col(column)).otherwise(masked.cast(dtype)))


# ---- tags ----------------------------------------------------------------------------

def tag_column(df: DataFrame, column: str, tag: str) -> DataFrame:
    """Attach ``tag`` to a column's metadata; it survives projections and parquet round trips."""
    meta = dict(df.schema[column].metadata)
    meta[TAG_KEY] = sorted(set(meta.get(TAG_KEY, [])) | {tag})
    return df.withMetadata(column, meta)


def tagged_columns(df: DataFrame, tag: str) -> list[str]:
    return [f.name for f in df.schema.fields if tag in f.metadata.get(TAG_KEY, [])]


# ---- policies ------------------------------------------------------------------------------

@dataclass
class RowFilterPolicy:
    fn: Callable[..., Column]
    columns: list[str]


@dataclass
class MaskPolicy:
    column: str
    group: str
    mask: Mask


@dataclass
class TagRule:
    """Row filter applied to every table with a column tagged ``tag``, for members of ``groups``."""

    name: str
    tag: str
    fn: Callable[..., Column]
    groups: list[str]


@dataclass
class PolicyRegistry:
    """Policies keyed by table name: one row filter per table (setting a second replaces the first)."""

    row_filters: dict[str, RowFilterPolicy] = field(default_factory=dict)
    masks: dict[str, list[MaskPolicy]] = field(default_factory=dict)
    tag_rules: list[TagRule] = field(default_factory=list)

    def set_row_filter(self, table: str, fn: Callable[..., Column], columns: Sequence[str]) -> None:
        self.row_filters[table] = RowFilterPolicy(fn, list(columns))

    def drop_row_filter(self, table: str) -> None:
        self.row_filters.pop(table, None)

    def set_mask(self, table: str, column: str, group: str, mask: Mask) -> None:
        self.masks.setdefault(table, [])
        self.masks[table] = [m for m in self.masks[table] if m.column != column] + [MaskPolicy(column, group, mask)]

    def add_tag_rule(self, rule: TagRule) -> None:
        self.tag_rules = [r for r in self.tag_rules if r.name != rule.name] + [rule]


def apply_tag_rule(df: DataFrame, rule: TagRule, member_of: Callable[[str], bool]) -> DataFrame:
    """Apply ``rule`` to ``df`` if it has a column with the rule's tag and the principal is in a target group.

    With several tagged columns a row must pass on each of them.
    """
    cols = tagged_columns(df, rule.tag)
    if not cols or not any(member_of(g) for g in rule.groups):
        return df
    for column in cols:
        df = apply_row_filter(df, rule.fn, [column])
    return df


def secured(df: DataFrame, table: str, registry: PolicyRegistry, principal: str, membership: DataFrame) -> DataFrame:
    """The rows and values of ``table`` that ``principal`` may see."""
    cache: dict[str, bool] = {}

    def member_of(group: str) -> bool:
        if group not in cache:
            cache[group] = is_member(membership, principal, group)
        return cache[group]

    out = df
    if table in registry.row_filters:
        p = registry.row_filters[table]
        out = apply_row_filter(out, p.fn, p.columns)
    for rule in registry.tag_rules:
        out = apply_tag_rule(out, rule, member_of)
    for m in registry.masks.get(table, []):
        out = mask_column(out, m.column, member_of(m.group), m.mask)
    return out


# ---- policies resolved by the query -----------------------------------------------------------

def set_principal(spark: SparkSession, principal: str, variable: str = "tidemark_principal") -> str:
    """Set (declare, if need be) the session variable that names who is asking; returns its name."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {variable} STRING DEFAULT :who", args={"who": principal})
    return variable


def secured_view(spark: SparkSession, name: str, table: str, *, membership: str, who: str,
                 allowed: tuple[str, str] | None = None, masks: dict[str, tuple[str, str]] | None = None,
                 principal_col: str = "principal", group_col: str = "group_name", temporary: bool = True) -> str:
    """Create the view ``name`` over ``table`` in which filter and masks follow who asks, and return its SQL.

    ``who`` is a SQL expression: a session variable (``set_principal``; such a view is temporary) or ``current_user()``
    (the view may be stored). ``allowed`` = (column, access table): a row is shown if the access table (``principal_col``
    and the same column) holds its value for the principal; a NULL is not shown. ``masks``: column -> (group, SQL
    expression of the masked value); members of the group see the value.
    """
    columns = []
    for column in spark.table(table).columns:
        shown = f"t.`{column}`"
        if masks and column in masks:
            group, masked = masks[column]
            literal = group.replace("'", "''")
            inside = (f"(SELECT count(*) > 0 FROM {membership} m WHERE m.`{principal_col}` = {who} "
                      f"AND m.`{group_col}` = '{literal}')")
            shown = f"CASE WHEN {inside} THEN {shown} ELSE {masked} END AS `{column}`"
        columns.append(shown)
    sql = f"SELECT {', '.join(columns)} FROM {table} t"
    if allowed:
        column, access = allowed
        sql += f" LEFT SEMI JOIN {access} a ON a.`{principal_col}` = {who} AND a.`{column}` = t.`{column}`"
    spark.sql(f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}VIEW {name} AS {sql}")
    return sql
