"""I-Match fingerprints: pairing and edits by brute force, properties of fingerprints and likeness."""

import random
from hashlib import sha256

import numpy as np
import pytest

from tests.llm.conftest import sentence
from tidemark.llm import imatch

SCHEMA = "doc_id long, text string, tie int, key string, range int, extra boolean"


def plain(rows):
    """(doc_id, n_chars, sha256 of the edited text) in id order; ties must be told apart by the caller."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: r[0])
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        out.append((i, len(t), sha256((t[:len(t) - half] + following[:half]).encode()).hexdigest()))
    return out


def compare(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1, "k", 3, True) for i, t in rows], SCHEMA)
    return imatch.compare_edits(df, **options).collect()


def test_edited_texts_and_ranges(workers, messy_rows):
    rows = [(i, t) for i, t in messy_rows if i not in (None, 400)] + [(500, "naïve café ß"), (501, "x"), (502, "日本語のテキスト")]
    for per_range in (1, 3, 2048):
        got = compare(workers, rows, rows_per_range=per_range)
        assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == plain(rows)
        texts = {}
        for r in got:
            texts.setdefault(dict(rows)[r.doc_id] or "", set()).add(r.fingerprint)
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            assert (r.near_edited == 1) >= (r.fingerprint == r.edited_fingerprint)
        assert all(len(f) == 1 for f in texts.values())          # equal texts, equal fingerprints


def test_repeated_and_null_ids_and_one_row(workers):
    rows = [(None, "first of all"), (1, "a b c d"), (1, "a b c d"), (1, "other words here"), (2, None)]
    got = compare(workers, rows, rows_per_range=1)
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t in rows) and len(got) == 5
    one = compare(workers, [(7, "only one row")])
    assert [(r.doc_id, r.near_next, r.edited_sha256) for r in one] == [(7, 1.0, sha256(b"only oonly o").hexdigest())]


def test_empty_table(workers):
    assert compare(workers, []) == []


def test_the_lexicon_is_the_band(workers):
    rows = [(k, f"common word{k % 10} rare{k}") for k in range(100)]
    df = workers.createDataFrame(rows, "doc_id long, text string")
    from tidemark.llm.common import Stages
    codes = imatch.lexicon(df, Stages(workers, "t"), (0.05, 0.5))
    assert codes.tolist() == imatch.term_codes(b" ".join(b"word%d" % k for k in range(10))).tolist()


def test_copies_count_once_in_the_lexicon(workers):
    rows = [(k, f"common word{k % 10} rare{k}") for k in range(100)] + [(1000 + k, "common word1 rare1") for k in range(200)]
    df = workers.createDataFrame(rows + [(5000, None), (5001, None)], "doc_id long, text string")
    from tidemark.llm.common import Stages
    codes = imatch.lexicon(df, Stages(workers, "t"), (0.05, 0.5))
    assert codes.tolist() == imatch.term_codes(b" ".join(b"word%d" % k for k in range(10))).tolist()


def test_a_third_of_copies_and_near_copies_keep_their_likeness(workers):
    rnd = random.Random(8)
    terms = [f"t{k}" for k in range(6000)]
    base = rnd.sample(terms, 200)
    rows = []
    for k in range(300):
        if k < 30:
            words = base
        elif k < 110:  # near copies: one word differs
            words = list(base)
            words[rnd.randrange(200)] = f"own{k}"
        else:
            words = rnd.sample(terms, 200)
        rows.append((k, " ".join(words)))
    near = {r.doc_id: (r.near_edited, r.near_next) for r in compare(workers, rows, rows_per_range=50)}
    group, rest = [near[k] for k in range(30, 109)], [near[k] for k in range(110, 299)]
    assert all(near[k] == (1.0, 1.0) or near[k][1] > 0.5 for k in range(109))
    assert min(n for _, n in group) > 0.5 and min(e for e, _ in group) > 0.25      # half of the terms stay
    assert np.mean([e for e, _ in rest]) > 0.2 and np.mean([n for _, n in rest]) < 0.1


def test_few_lexicon_terms_and_many_are_compared_over_all_terms():
    words = [f"w{k}" for k in range(60)]
    prints = imatch.Fingerprints(imatch.term_codes(" ".join(words[:imatch.LEAST_TERMS]).encode()))
    a, b = (prints.of(" ".join(x).encode()) for x in (words, words[1:]))
    assert a[:8] != imatch.EMPTY == b[:8] and imatch.likeness(a, b) == imatch.likeness(b, a) > 0.7
    few = imatch.Fingerprints(imatch.term_codes(b""))                        # no lexicon at all
    assert imatch.likeness(few.of(b"x y z"), few.of(b"z y x")) == 1.0 == imatch.likeness(few.of(b""), few.of(b" "))


def test_published_fingerprints_tell_the_likeness(workers, messy_rows):
    rows = [(i, t) for i, t in messy_rows if i not in (None, 400)]
    got = sorted(compare(workers, rows, band=(0.02, 1.0)), key=lambda r: r.doc_id)
    lists = {imatch.EMPTY == r.fingerprint[:8] for r in got}
    assert lists == {True, False}                                            # few and many lexicon terms
    for r, after in zip(got, got[1:] + got[:1]):
        assert r.near_edited == imatch.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == imatch.likeness(r.fingerprint, after.fingerprint)


def test_subsets_keep_their_share_of_the_terms(monkeypatch):
    codes = imatch.term_codes(" ".join(f"t{k}" for k in range(60_000)).encode())
    prints = imatch.Fingerprints(codes)
    share = prints.member.mean(axis=0)
    assert np.allclose(share, imatch.SUBSETS, rtol=0.2) and len(set(share)) > 40
    monkeypatch.setattr(imatch, "CHUNK_TERMS", 1000)
    assert (prints._members(codes) == prints.member).all()
    with pytest.raises(ValueError):
        imatch.Fingerprints(codes, (0.3,))


def test_likeness_grows_with_what_two_texts_share():
    rnd = random.Random(3)
    terms = [f"t{k}" for k in range(4000)]
    prints = imatch.Fingerprints(imatch.term_codes(" ".join(terms).encode()))
    near = []
    for kept in (400, 380, 200, 0):
        values = []
        for _ in range(12):
            a = rnd.sample(terms, 400)
            b = a[:kept] + rnd.sample(terms, 400 - kept)
            values.append(imatch.likeness(prints.of(" ".join(a).encode()), prints.of(" ".join(b).encode())))
        near.append(float(np.mean(values)))
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3] and near[1] > 0.6 and near[3] < 0.2


def test_order_and_case_of_terms_do_not_matter():
    prints = imatch.Fingerprints(imatch.term_codes(b"ab cd ef"))
    assert prints.of(b"ab cd, EF") == prints.of(b"ef-cd ab ab") != prints.of(b"ab cd")
    assert prints.of(b"") == prints.of(b" .") and len(prints.of(b"")) == 16 * (1 + len(imatch.SUBSETS))
    assert sentence(random.Random(1), 2)
