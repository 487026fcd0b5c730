"""Mixing against a plain statement of targets and budgets."""

import re
from fractions import Fraction

import pytest

from tests.llm.conftest import frame
from tidemark.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Share by weight, stop at three times the size, share the rest again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    fixed, left, open_ = {}, Fraction(sum(sizes.values())), set(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            return fixed | share
        for s in above:
            fixed[s] = Fraction(3 * sizes[s])
            left -= fixed[s]
        open_ -= above
    return fixed


def check(rows, texts_with_source):
    sizes = {}
    for _, text, source in texts_with_source:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    target = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(target[r.source]))
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 3, s


def with_sources(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


def test_targets_and_taken_words(messy):
    out = mixing.mix(messy).collect()
    assert len(out) == messy.count()
    check(out, with_sources(messy))
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(messy.repartition(5)).collect()))   # reruns agree


def test_one_hot_source_small_sources_stop_at_three_times(workers):
    rows = [(k, f"w{k} " * 50, "big") for k in range(60)] + [(100, "a b", "little"), (101, "c", None), (102, "", "zero")]
    df = workers.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    check(out, rows)
    assert {r.doc_id: r.taken for r in out}[100] == 6


def test_nested_budgets_take_the_same_hashes(workers):
    df = workers.createDataFrame([(k, "w " * (1 + k % 9), "ab"[k % 2]) for k in range(300)],
                                 "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    for s in "ab":
        own = sorted((r.hash, r.taken // r.size, r.taken % r.size) for r in out if r.source == s)
        copies = [c for _, c, _ in own]
        assert copies == sorted(copies, reverse=True) and sum(p > 0 for _, _, p in own) <= 1


def test_equal_hashes_share_the_rest(workers):
    df = workers.createDataFrame([(1, "w " * 10, "a")] * 20 + [(2, "w " * 400, "b")], "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    assert len({r.taken for r in out if r.source == "a"}) == 1
    check_sum = sum(r.taken for r in out if r.source == "a")
    assert abs(check_sum - [r.target for r in out if r.source == "a"][0]) <= 20


def test_mixed_rows_hold_the_taken_words(messy):
    plan = {}
    for r in mixing.mix(messy).collect():
        plan[r.source] = plan.get(r.source, 0) + r.taken
    got = {}
    rows = mixing.mixed(messy).collect()
    assert rows and rows[0].__fields__ == messy.columns
    for r in rows:
        got[r.source] = got.get(r.source, 0) + len(WORD.findall(r.text))
    assert got == {s: n for s, n in plan.items() if n}


def test_empty_table(no_rows):
    assert mixing.mix(no_rows).collect() == [] and mixing.mixed(no_rows).collect() == []


def test_first_words(workers):
    df = workers.createDataFrame([(" a  b\tc d", 2), ("one", 1), ("x y", 9)], "t string, n int")
    from pyspark.sql import functions as F
    assert [r[0] for r in df.select(mixing.first_words(F.col("t"), F.col("n"))).collect()] == [" a  b", "one", "x y"]


def test_frame_has_clashing_columns(messy):
    assert {"key", "size", "hash", "target"} <= set(messy.columns) and frame is not None


def test_targets_do_not_depend_on_the_files_of_a_session(workers):
    from tests.conftest import SF001
    from tidemark.llm import queries

    def rows():
        return sorted(map(tuple, queries.queries()["op4_mixing"](workers, SF001).collect()))

    before = rows()
    workers.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        assert rows() == before
    finally:
        workers.conf.unset("spark.sql.files.maxRecordsPerFile")
