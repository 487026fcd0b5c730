"""Spelling variants against edit distances of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.conftest import SF001
from tests.llm.conftest import frame, sentence
from tidemark.llm import spelling


def deletions(w):
    return {w[:k] + w[k + 1:] for k in range(len(w))}


def one_edit(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return (len(a) - len(b) == 1 and b in deletions(a)) or (len(b) - len(a) == 1 and a in deletions(b))


def plain_words(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run
            if len(word) >= 7:
                count[word] += 1
    return {w: n for w, n in count.items() if n >= 2}


def plain_forms(words, ratio=10, pairs=None):
    by = {}
    if pairs is None:
        pairs = ((a, b) for a in words for b in words if one_edit(a, b))
    for a, b in pairs:
        by.setdefault(a, []).append(b)
    best = {w: min(by[w], key=lambda x: (-words[x], x)) for w in by}
    form = {w: best.get(w) if w in best and words[best[w]] >= ratio * n else None for w, n in words.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(by.get(w, [])), words.get(form[w])) for w, n in words.items())


def result(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=lambda r: r[0])


def vocabulary(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.fixture(scope="module")
def words():
    rnd = random.Random(3)
    out = {}
    for _ in range(60):
        w = "".join(rnd.choice("abcdeéß÷") for _ in range(rnd.randrange(1, 12)))
        out[w] = rnd.choice([2, 3, 30, 400, 5000])
        for _ in range(rnd.randrange(6)):
            k = rnd.randrange(len(w))
            w = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("abzé") + w[k:], w[:k] + rnd.choice("abzé") + w[k + 1:]]) or "a"
            out.setdefault(w, rnd.choice([1, 3, 3, 30, 400, 60_000]))
    return out


@pytest.mark.parametrize("symbols, most", [(None, 4096), (2, 4096), (2, 1), (3, 20), (90, 1)])
def test_forms(workers, words, symbols, most):
    found = result(spelling.spelling_forms(vocabulary(workers, words), symbols=symbols, most_comparisons=most))
    assert found == plain_forms(words)
    assert any(r[1] and r[2] != r[1] for r in found)  # a chain of forms


def test_chain_of_forms(workers):
    words = {"a" * (7 + k): 10 ** k for k in range(12)}
    found = {r[0]: r[2] for r in result(spelling.spelling_forms(vocabulary(workers, words)))}
    assert set(found.values()) == {"a" * 18}


def test_many_words_behind_one_reduced_word(workers):
    rnd = random.Random(1)  # a third of the vocabulary consists of letters that share a symbol
    share = [c for c, s in zip(spelling.LETTERS, spelling.reducing(4)) if s == spelling.reducing(4)[0]][:12]
    words = {"".join(rnd.choice(share) for _ in range(7)): rnd.choice([2, 50]) for _ in range(300)}
    words |= {"".join(rnd.choice(spelling.LETTERS) for _ in range(8)): 2 for _ in range(600)}
    found = result(spelling.spelling_forms(vocabulary(workers, words), symbols=4, most_comparisons=100))
    assert found == plain_forms(words)


def test_words_of_documents(workers, messy_rows, no_rows):
    rnd = random.Random(6)
    rows = list(messy_rows) + [(500 + k, " ".join(rnd.choice(["Strasse", "STRASSE", "Straße", "strasses", "éléphant", "elephant",
                                                               "éléphants", "a1bcdefghijk", "x" * 40]) for _ in range(30)))
                               for k in range(40)]
    words = plain_words(rows)
    assert result(spelling.spelling_variants(frame(workers, rows))) == plain_forms(words)
    assert result(spelling.spelling_variants(no_rows)) == []


def test_registered_query(workers):
    from tidemark.llm import queries

    docs = workers.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    words = plain_words(docs)
    by_hole = {}
    for w in words:  # candidates share a deletion or are one
        for d in deletions(w) | {w}:
            by_hole.setdefault(d, set()).add(w)
    pairs = {(a, b) for group in by_hole.values() for a in group for b in group if one_edit(a, b)}
    found = result(queries.queries()["op11_spelling"](workers, SF001))
    assert found == plain_forms(words, pairs=pairs)
    assert any(r[1] for r in found)


@given(st.text(alphabet=spelling.LETTERS, min_size=1, max_size=9), st.integers(2, 95))
def test_reducing_keeps_letters_apart_only_with_a_symbol_each(word, symbols):
    table = spelling.reducing(symbols)
    assert len(table) == len(spelling.LETTERS) and len(set(table)) == min(symbols, len(spelling.LETTERS))


def test_neighbourhood_is_full(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("abca",), ("",), ("a",)], "w string").select("w", spelling.neighbourhood(F.col("w"), 3).alias("s"))
    for w, s in df.collect():
        s = list(s)
        every = {w} if w else set()
        every |= deletions(w) | {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in "abc"}
        every |= {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in "abc"}
        assert len(s) == len(set(s)) and set(s) == every
