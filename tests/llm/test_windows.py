"""Removal of repeated token windows against a plain statement over all windows."""

import random
import re
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF001
from tests.llm.conftest import frame, sentence
from tidemark.llm import windows


def plain(rows, window):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    order = [-(1 << 63) if i is None else i for i, _ in texts]
    least = defaultdict(lambda: 1 << 63)
    for at, (_, words) in zip(order, texts):
        for k in range(len(words) - window + 1):
            key = tuple(words[k:k + window])
            least[key] = min(least[key], at)
    out = []
    for at, (i, words) in zip(order, texts):
        cut = [False] * (len(words) + 1)
        for k in range(len(words) - window + 1):
            if least[tuple(words[k:k + window])] < at:
                cut[k:k + window] = [True] * window
        kept = " ".join(w for w, c in zip(words, cut) if not c)
        runs = sum(1 for a, b in zip([False] + cut, cut) if b and not a)
        out.append((i, len(words), sum(cut), runs, sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def result(df, **options):
    rows = windows.remove_repeated_windows(df, **options).collect()
    for r in rows:
        assert sha256(r.text.encode()).hexdigest() == r.kept_sha256
        assert sum(s.end - s.start for s in r.spans or ()) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, len(r.spans or ()), r.kept_sha256) for r in rows),
                  key=lambda r: (r[0] is None, r))


@pytest.fixture(scope="module")
def rows(messy_rows):
    rnd = random.Random(9)
    passage, line = sentence(rnd, 30), sentence(rnd, 9)
    out = list(messy_rows)
    out += [(1000 + k, sentence(rnd, 20) + " " + passage + "\t" + sentence(rnd, 20)) for k in range(12)]
    out += [(1100 + k, "\n".join([line, sentence(rnd, 8)] * 2 + [line])) for k in range(6)]
    out += [(1200, "ab " * 150), (1201, "ab " * 40), (1202, passage + " " + passage), (1203, passage[3:]),
            (-5, passage + " é"), (1204, passage), (1204, "x " + passage), (1204, passage), (None, passage + " end")]
    return out


@pytest.mark.parametrize("window, chunk_words, bucket_windows", [(13, 1_000_000, 250_000), (5, 200, 10), (1, 900, 100)])
def test_every_repeated_window(workers, rows, window, chunk_words, bucket_windows):
    found = result(frame(workers, rows), window=window, chunk_words=chunk_words, bucket_windows=bucket_windows)
    assert found == plain(rows, window)


def test_a_third_of_all_rows_shares_a_passage(workers):
    rnd = random.Random(2)
    passage = sentence(rnd, 60)
    rows = [(k, (passage if k % 3 == 0 else "") + " " + sentence(rnd, 15)) for k in range(900)]
    assert result(frame(workers, rows).repartition(5), chunk_words=2000) == plain(rows, windows.WINDOW)


def test_very_long_text_in_segments(workers, monkeypatch):
    rnd = random.Random(5)
    a = sentence(rnd, 4000)
    rows = [(1, a + " tail"), (2, sentence(rnd, 500) + " " + a[5000:9000]), (3, a[-100:]), (4, "x" * 9000 + " " + a)]
    monkeypatch.setattr(windows, "SEGMENT", 700)
    codes, counts = windows.word_codes([t.encode() for _, t in rows])
    monkeypatch.setattr(windows, "SEGMENT", 1 << 20)
    whole, also = windows.word_codes([t.encode() for _, t in rows])
    assert (codes == whole).all() and (counts == also).all() and list(counts) == [len(t.split()) for _, t in rows]
    assert result(frame(workers, rows)) == plain(rows, windows.WINDOW)


def test_empty_table(no_rows):
    assert result(no_rows) == []


def test_needs_a_window(messy):
    with pytest.raises(ValueError):
        windows.remove_repeated_windows(messy, window=0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), min_size=1, max_size=6), st.integers(1, 4))
def test_chunk_and_bucket(texts, window):
    ids = np.arange(len(texts))[::-1] * 3
    batch = windows.chunk_rows(ids, np.zeros(len(texts), int), [" ".join(t).encode() for t in texts], window, 4)
    found = set()
    for bucket, hashes, places in zip(*[c.to_pylist() for c in batch.columns]):
        id_, start = windows.unpacked(places)
        if hashes is None:
            found |= set(zip(id_.tolist(), start.tolist()))
        else:
            value = np.frombuffer(hashes, np.uint64)
            assert (np.lexsort((id_, value)) is not None) and not windows.later(value, id_, np.lexsort((id_, value))).any()
    least = {}
    for i, words in zip(ids, texts):
        for k in range(len(words) - window + 1):
            key = tuple(words[k:k + window])
            least[key] = min(least.get(key, i), i)
    assert found == {(int(i), k) for i, words in zip(ids, texts) for k in range(len(words) - window + 1)
                     if least[tuple(words[k:k + window])] < i}


@given(st.lists(st.integers(0, 60), max_size=20), st.integers(1, 9))
def test_united_intervals(starts, window):
    first, end = windows.united(np.array(sorted(starts), dtype=np.int64), window)
    covered = {x for s in starts for x in range(s, s + window)}
    assert {x for a, b in zip(first, end) for x in range(a, b)} == covered
    assert all(b < a for a, b in zip(first[1:], end[:-1]))


def test_registered_query_over_whole_texts(workers):
    from tidemark.llm import queries

    docs = workers.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    found = queries.queries()["op12_windows"](workers, SF001).collect()
    expected = [(i, n, removed, digest) for i, n, removed, _, digest in plain(docs, 13)]
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == expected
    assert any(r.n_removed for r in found)
