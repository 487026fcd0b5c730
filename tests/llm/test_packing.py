"""Packing against the tokenizer itself, piece by piece."""

import collections
import zlib

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import vocabulary
from tests.conftest import SF001
from tidemark.llm import queries


def expected_ids(text):
    tokenizer = expected_ids.tokenizer = getattr(expected_ids, "tokenizer", None) or Tokenizer.from_file(vocabulary())
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check_pieces(rows, texts, max_tokens):
    """Every document's ids lie in its pieces, in order, each id once, and every piece is a power of two."""
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    want = collections.Counter((i, tuple(expected_ids(t))) for i, t in texts)
    got = collections.Counter()
    for doc_id, pieces in by_doc.items():
        copies = [p for p in pieces if p.start == 0]
        pools = collections.defaultdict(list)
        for p in pieces:
            assert p.length & (p.length - 1) == 0 and p.length <= max_tokens and p.offset == 0
            pools[p.doc_tokens].append(p)
        for n, own in pools.items():
            own.sort(key=lambda p: p.start)
            times = sum(p.start == 0 for p in own)
            if times == 1:
                ids = np.frombuffer(b"".join(bytes(p.ids) for p in own), "<u4").tolist()
                assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist() and len(ids) == n
                got[doc_id, tuple(ids)] += 1
            else:  # repeated rows: as many equal pieces each
                count = collections.Counter((p.start, bytes(p.ids)) for p in own)
                if set(count.values()) == {times}:
                    ids = np.frombuffer(b"".join(x for _, x in sorted(count)), "<u4").tolist()
                    got[doc_id, tuple(ids)] += times
        assert copies
    assert got == want


def test_pieces_hold_the_tokenizers_ids(messy, messy_rows):
    rows = packing.pack(messy, vocabulary(), max_tokens=256).collect()
    check_pieces(rows, messy_rows, 256)
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_awkward_characters_are_tokenized_as_by_the_library():
    texts = ["It's a TEST's l'eau ÇA Ünï ß İstanbul ΑΣ ﬁ é x", "a\u0085b c\x1cd", "12½ foo_bar a--b's 'Twas don't. ###a$$$", "",
             " ", "á è́", "<|endoftext|> <|x|>", "Ω≈ç√ 日本語 テスト", "x" * 5000]
    words = packing.WordTokens(vocabulary(), most_words=3)
    for _ in range(2):  # the second round finds some words and learns others again
        ids, first = words.ids([t.encode() for t in texts])
        for t, a, b in zip(texts, first, first[1:]):
            assert ids[a:b].tolist() == expected_ids(t)[:-1], t


def test_lengths():
    assert packing.piece_lengths(1) == [1]
    assert packing.piece_lengths(4096 * 2 + 13) == [4096, 4096, 8, 4, 1]
    assert packing.piece_lengths(7, 4) == [4, 2, 1]


def test_empty_table(no_rows):
    assert packing.pack(no_rows, vocabulary()).collect() == []


def test_query(workers):
    out = queries.queries()["op1_packing"](workers, SF001).toPandas()
    docs = workers.read.parquet(f"{SF001}/documents.parquet").toPandas()
    assert set(out.doc_id) == set(docs.doc_id) and out.sequence_id.is_unique
    for doc_id, text in list(zip(docs.doc_id, docs.text))[:40]:
        ids = np.array(expected_ids(text), dtype="<u4")
        for p in out[out.doc_id == doc_id].itertuples():
            assert zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids)


def test_sequence_ids_do_not_depend_on_the_files_of_a_session(workers):
    from tests.conftest import SF001
    from tidemark.llm import queries

    workers.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        pieces = packing.pack(workers.read.parquet(f"{SF001}/documents.parquet").repartition(3), queries.vocabulary())
        assert pieces.count() == pieces.select("sequence_id").distinct().count()
    finally:
        workers.conf.unset("spark.sql.files.maxRecordsPerFile")
