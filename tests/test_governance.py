"""Row filters, masks, membership and tag rules on the literal tables of the governance demos."""

import pytest
from pyspark.sql import Row

from tidemark.operators import governance as gov

CITIES = [("Lyon", "France"), ("Porto", "Portugal"), ("Gent", "Belgium"), ("Nowhere", None)]
EMPLOYEE = [("emp_a", "000-00-0001"), ("emp_b", "000-00-0002"), ("emp_c", "000-00-0003")]
MEMBERS = [("alice", "HR"), ("alice", "admins"), ("bob", "eng")]


def _cities(spark):
    return spark.createDataFrame(CITIES, "city_name string, country_name string")


def _members(spark):
    return spark.createDataFrame(MEMBERS, "principal string, group_name string")


def test_sql_function_filter_true_on_both_arms_keeps_everything(spark):
    fn = gov.register_sql_function(spark, "t_country_filter", "country_name STRING",
                                   "IF(country_name IS NULL, true, length(country_name) > 0)")
    assert gov.apply_row_filter(_cities(spark), fn, ["country_name"]).count() == 4


def test_if_filter_with_predicate_arms_and_null_drop(spark):
    fn = lambda c: gov.if_filter(c.isNull(), False, (c == "Portugal") | (c == "France"))
    out = sorted(r.city_name for r in gov.apply_row_filter(_cities(spark), fn, ["country_name"]).collect())
    assert out == ["Lyon", "Porto"]
    # a filter yielding NULL drops the row
    nullish = lambda c: c == "France"
    assert gov.apply_row_filter(_cities(spark), nullish, ["country_name"]).count() == 1


def test_duplicates_are_not_removed(spark):
    df = _cities(spark).unionAll(_cities(spark))
    assert gov.apply_row_filter(df, lambda c: gov.if_filter(c.isNull(), True, True), ["country_name"]).count() == 8


def test_registry_second_filter_replaces_first_and_drop(spark):
    reg = gov.PolicyRegistry()
    reg.set_row_filter("cities", lambda c: c == "France", ["country_name"])
    reg.set_row_filter("cities", lambda c: c == "Belgium", ["country_name"])
    out = gov.secured(_cities(spark), "cities", reg, "bob", _members(spark)).collect()
    assert [r.city_name for r in out] == ["Gent"]
    reg.drop_row_filter("cities")
    assert gov.secured(_cities(spark), "cities", reg, "bob", _members(spark)).count() == 4


def test_column_mask_by_group(spark):
    emp = spark.createDataFrame(EMPLOYEE, "emp_name string, ssn string")
    reg = gov.PolicyRegistry()
    reg.set_mask("employee", "ssn", "HR", "#")
    hr = gov.secured(emp, "employee", reg, "alice", _members(spark)).collect()
    other = gov.secured(emp, "employee", reg, "bob", _members(spark)).collect()
    assert [r.ssn for r in hr] == [e[1] for e in EMPLOYEE]
    assert {r.ssn for r in other} == {"#"}


def test_mask_by_sql_function(spark):
    emp = spark.createDataFrame(EMPLOYEE, "emp_name string, ssn string")
    reg = gov.PolicyRegistry()
    reg.set_mask("employee", "ssn", "HR", gov.register_sql_function(spark, "t_tail", "v STRING", "right(v, 2)"))
    assert sorted(r.ssn for r in gov.secured(emp, "employee", reg, "bob", _members(spark)).collect()) == ["01", "02", "03"]
    assert sorted(r.ssn for r in gov.secured(emp, "employee", reg, "alice", _members(spark)).collect()) == [
        e[1] for e in EMPLOYEE]


def test_tag_rule_filters_every_tagged_column(spark):
    df = spark.createDataFrame([(1, "France", "Portugal"), (2, "France", "France"), (3, None, "France")],
                               "id long, home string, work string")
    for column in ("home", "work"):
        df = gov.tag_column(df, column, "geo")
    rule = gov.TagRule("french", "geo", lambda c: c == "France", ["admins"])
    assert [r.id for r in gov.apply_tag_rule(df, rule, lambda group: True).collect()] == [2]


def test_membership(spark):
    m = _members(spark)
    assert gov.is_member(m, "alice", "admins") and not gov.is_member(m, "bob", "admins")


def test_tag_rule_applies_to_tagged_tables_for_members_only(spark, tmp_path):
    tagged = gov.tag_column(_cities(spark), "country_name", "country")
    # the tag survives a projection and a parquet round trip
    tagged.select("city_name", "country_name").write.parquet(str(tmp_path / "c"))
    reread = spark.read.parquet(str(tmp_path / "c"))
    assert gov.tagged_columns(reread, "country") == ["country_name"]
    reg = gov.PolicyRegistry()
    reg.add_tag_rule(gov.TagRule("by_country", "country", lambda c: c == "Portugal", ["admins"]))
    assert gov.secured(reread, "cities", reg, "alice", _members(spark)).count() == 1   # admin: rule applies
    assert gov.secured(reread, "cities", reg, "bob", _members(spark)).count() == 4     # not in group
    assert gov.secured(_cities(spark), "cities", reg, "alice", _members(spark)).count() == 4  # untagged table


# ---- groups in groups, and policies resolved by the query ---------------------------------------

def _closure(edges):
    found = {(a, b) for a, b in edges if a and b}
    while True:
        more = {(a, d) for a, b in found for c_, d in edges if c_ == b and d} - found
        if not more:
            return {(a, b) for a, b in found if a != b}
        found |= more


@pytest.mark.parametrize("edges", [
    [], [("a", "b"), ("b", "c"), ("c", "a")], [("a", "a")], [("a", "b"), ("a", "b"), (None, "c"), ("b", None)],
    [(f"g{k}", f"g{k + 1}") for k in range(12)], [(f"g{i}", f"g{j}") for i in range(6) for j in range(6)]])
def test_group_closure_with_cycles(spark, edges):
    df = spark.createDataFrame(edges, "group_name string, in_group string")
    assert {tuple(r) for r in gov.group_closure(df).collect()} == _closure(edges)


def test_groups_of_a_user(spark):
    nesting = spark.createDataFrame([("eng", "staff"), ("staff", "all"), ("all", "staff")], "group_name string, in_group string")
    own = spark.createDataFrame([("ann", "eng"), ("ann", "staff"), ("bob", "all"), (None, "eng"), ("eve", None)],
                                "principal string, group_name string")
    assert {tuple(r) for r in gov.groups_of(own, nesting, "ann").collect()} == {("eng", True), ("staff", True), ("all", False)}
    every = gov.all_memberships(own, nesting)
    assert gov.is_member(every, "bob", "staff") and not gov.is_member(every, "bob", "eng") and not gov.is_member(every, "eve", "all")


def test_one_view_two_principals(spark):
    spark.createDataFrame([(1, "x", "US"), (2, "y", "FR"), (3, "z", None)], "id int, name string, country string").createOrReplaceTempView("pv_rows")
    spark.createDataFrame([("ann", "HR"), ("bob", "eng"), ("o'neil", "it's")], "principal string, group_name string").createOrReplaceTempView("pv_members")
    spark.createDataFrame([("ann", "US"), ("ann", "US"), ("ann", "FR"), ("bob", "FR")], "principal string, country string").createOrReplaceTempView("pv_access")
    who = gov.set_principal(spark, "ann")
    gov.secured_view(spark, "pv_seen", "pv_rows", membership="pv_members", who=who, allowed=("country", "pv_access"),
                     masks={"name": ("HR", "concat(left(name, 0), '-')")})

    def seen(principal):
        gov.set_principal(spark, principal)
        return sorted(tuple(r) for r in spark.table("pv_seen").collect())

    assert seen("ann") == [(1, "x", "US"), (2, "y", "FR")]
    assert seen("bob") == [(2, "-", "FR")]
    assert seen("o'neil") == []
    gov.secured_view(spark, "pv_seen", "pv_rows", membership="pv_members", who=who, masks={"name": ("it's", "'-'")})
    assert [r[1] for r in seen("o'neil")] == ["x", "y", "z"] and [r[1] for r in seen("bob")] == ["-"] * 3


def test_a_stored_view_for_the_current_user(spark):
    spark.createDataFrame([(1, "US"), (2, "FR")], "id int, country string").write.mode("overwrite").saveAsTable("pv_stored")
    user = spark.sql("SELECT current_user()").first()[0]
    spark.createDataFrame([(user, "FR"), ("other", "US")], "principal string, country string").write.mode("overwrite").saveAsTable("pv_stored_access")
    gov.secured_view(spark, "pv_stored_seen", "pv_stored", membership="pv_stored_access", who="current_user()",
                     allowed=("country", "pv_stored_access"), temporary=False)
    assert [tuple(r) for r in spark.newSession().table("pv_stored_seen").collect()] == [(2, "FR")]


def test_memberships_are_dealt_by_their_number(spark, monkeypatch):
    own = spark.createDataFrame([(f"p{k}", "g0") for k in range(10)] + [("p0", "g0"), ("p1", "g1")], "principal string, group_name string")
    nesting = spark.createDataFrame([("g0", "g1"), ("g1", "g2"), ("g2", "g3")], "group_name string, in_group string")
    monkeypatch.setattr(gov, "MEMBERSHIP_ROWS", 8)
    got = gov.all_memberships(own, nesting)
    # 11 rows of a group that is in three others, one of a group in two: 47 rows, 8 to a task
    assert "hashpartitioning(principal" in got._jdf.queryExecution().executedPlan().toString()
    assert ", 6), REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    rows = {(r.principal, r.group_name): r.direct for r in got.collect()}
    assert rows == {(f"p{k}", f"g{g}"): g == 0 or (k, g) == (1, 1) for k in range(10) for g in range(4)}
    assert gov.all_memberships(own.limit(0), nesting).count() == 0
