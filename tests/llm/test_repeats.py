"""Removal of repeated byte strings against a plain statement over all strings."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import frame, sentence
from tidemark.llm import repeats


def plain(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[k:k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        covered = np.zeros(len(t) + 1, dtype=int)
        for k in range(len(t) - length + 1):
            if count[t[k:k + length]] > 1:
                covered[k] += 1 if k == 0 or not covered[k] else 0
                covered[k:k + length] = 1
        cut = covered[:-1].astype(bool)
        kept = bytes(b for b, c in zip(t, cut) if not c)
        spans = int((np.diff(np.concatenate(([0], cut.astype(int)))) == 1).sum())
        out.append((i, len(t), int(cut.sum()), spans, sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def result(df, **options):
    rows = repeats.remove_repeats(df, **options).collect()
    assert all(sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in rows)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows),
                  key=lambda r: (r[0] is None, r))


@pytest.fixture(scope="module")
def rows(messy_rows):
    rnd = random.Random(9)
    passage, line = sentence(rnd, 30), sentence(rnd, 9)
    out = [(i, t) for i, t in messy_rows if i != 300]
    out += [(1000 + k, sentence(rnd, 20) + " " + passage + " " + sentence(rnd, 20)) for k in range(12)]
    out += [(1100 + k, "\n".join([line, sentence(rnd, 8)] * 2 + [line])) for k in range(6)]
    out += [(1200, "ab" * 150), (1201, "a" * 200), (1202, "a" * 90), (1203, "é" * 70), (1204, passage + passage),
            (1205, passage[3:]), (1206, passage[:-2] + "é")]
    return out


@pytest.mark.parametrize("length, most_group", [(40, 20_000), (33, 3), (64, 1), (400, 20_000)])
def test_every_repeated_byte(workers, rows, length, most_group):
    assert result(frame(workers, rows), length=length, most_group=most_group) == plain(rows, length)


def test_very_long_text_in_segments(workers, monkeypatch):
    rnd = random.Random(5)
    a = sentence(rnd, 4000)
    rows = [(1, a + " tail"), (2, sentence(rnd, 500) + a[5000:9000]), (3, a[-100:])]
    want = plain(rows, 50)
    assert result(frame(workers, rows), length=50) == want
    # the same boundaries whatever the segment size
    data = a.encode()
    whole = {tuple(x) for x in zip(*repeats.unpack(repeats.boundaries(data, 50)[0]))}
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    places, _, _ = repeats.boundaries(data, 50)
    covered = lambda found: {p - t for p, low, high in found for t in range(low, high + 1)}
    parts = {tuple(x) for x in zip(*repeats.unpack(places))}
    assert covered(parts) == covered(whole) == set(range(len(data) - 49))
    assert {p for p, _, _ in parts} == {p for p, _, _ in whole}


def test_large_groups_are_split_by_ranges_of_starts(workers, monkeypatch):
    """A passage in many texts, with other words close around it, so that its groups stay large through all levels."""
    rnd = random.Random(11)
    passage = sentence(rnd, 25)
    rows = [(k, sentence(rnd, rnd.randrange(3)) + " " + passage[rnd.randrange(9):len(passage) - rnd.randrange(9)] + sentence(rnd, 3))
            for k in range(60)]
    want = plain(rows, 48)
    widths = []
    split = repeats.split_boundaries
    monkeypatch.setattr(repeats, "split_boundaries", lambda t, c, width, n: widths.append(width) or split(t, c, width, n))
    assert result(frame(workers, rows), length=48, most_group=2) == want
    assert widths and widths == [3, 1][:len(widths)]
    monkeypatch.setattr(repeats, "RANGES", 2)
    widths.clear()
    assert result(frame(workers, rows), length=48, most_group=1) == want
    assert widths == [12, 6, 3, 2, 1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=32, max_size=90), min_size=1, max_size=6), st.sampled_from([1, 3, 8, 16]))
def test_ranges_keep_equal_strings_together(texts, width):
    """Every string start lies in one range, and equal strings (which start equally far before it) have equal keys."""
    length, keys, starts = 32, {}, []
    for n, text in enumerate(texts):
        data = text.encode()
        for place, key, _ in zip(*repeats.parted(data, repeats.boundaries(data, length)[0].tolist(), width, length)):
            at, least, most = repeats.unpack(place)
            for t in range(least, most + 1):
                keys.setdefault(data[at - t:at - t + length], set()).add(key)
                starts.append((n, at - t))
    assert sorted(starts) == [(n, k) for n, text in enumerate(texts) for k in range(len(text) - length + 1)]
    assert all(len(k) == 1 for k in keys.values())


def test_empty_table(no_rows):
    assert result(no_rows) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=0, max_size=90), min_size=1, max_size=6))
def test_boundaries_and_suffix_arrays_find_equal_strings(texts):
    """Without Spark: group boundaries by what follows them and solve each group."""
    length, groups = 32, {}
    for n, text in enumerate(texts):
        data = text.encode()
        places, keys, _ = repeats.boundaries(data, length)
        for p, key in zip(places, keys):
            at, _, most = repeats.unpack(p)
            groups.setdefault(int(key), []).append((n, p, data[at - most:at], data[at:at + length]))
    got = set()
    for members in groups.values():
        at, least, most = repeats.unpack(np.array([m[1] for m in members]))
        marked = repeats.repeated_starts([m[2] for m in members], [m[3] for m in members], least, most, length)
        for t, k in zip(*np.nonzero(marked)):
            got.add((members[k][0], int(at[k]) - int(t)))
    strings = {(n, k): text[k:k + length] for n, text in enumerate(texts) for k in range(len(text) - length + 1)}
    count = Counter(strings.values())
    assert got == {where for where, s in strings.items() if count[s] > 1}


def test_registered_query_over_whole_texts(workers):
    from tests.conftest import SF001
    from tidemark.llm import queries

    docs = [(r.doc_id, r.text) for r in workers.read.parquet(f"{SF001}/documents.parquet").collect()]
    found = queries.queries()["op8_repeats"](workers, SF001).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == plain(docs, 400)
    whole = [r for r in found if sha256(r.text.encode()).hexdigest() == r.kept_sha256]
    assert len(whole) > 0.9 * len(found) and all(len(r.text.encode()) <= r.n_bytes + 12 * r.n_spans for r in found)
