"""WARC archives: round trip, revisits and the merged index."""

import random
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF01
from tidemark.llm import queries, warc
from tidemark.llm.common import Stages

SCHEMA = "page_id long, url string, html string, payload string, block string, value string, captured string, offset long"
LONG = "<p>" + "x" * 200 + "</p>"
PAGES = [(5, "http://b.example.com/x?y=1", LONG), (2, "https://www.B.example.com:8080/x", LONG), (9, "http://a.example.com", LONG),
         (1, "http://a.example.com/", "short"), (3, "http://a.example.com/", "short"), (4, None, None), (6, "", ""),
         (7, "http://[bad/url", "é" * 60), (8, "http://x.example/ü\r\nX-Page-ID: 99", "WARC/1.1\r\n\r\n\r\n\r\n" + LONG),
         (10, "http://c.example", "\r\n\r\n" * 40), (11, "http://c.example", "\r\n\r\n" * 40), (12, "u", "z" * 300_000),
         (20, "r", LONG + "r"), (20, "r", LONG + "r"), (21, "r", LONG + "r"), (None, "n", LONG), (None, "n", None)]


def plain(pages):
    first = {}
    for i, _, html in pages:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        revisit = i is not None and len(data) >= 100 and first[html] < i
        out.append((i, len(data), sha256(data).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None))
    return sorted(out, key=str)


def frame(spark, pages):
    return spark.createDataFrame([(*p, "p", "b", "v", "c", 3) for p in pages], SCHEMA)


@pytest.mark.parametrize("per_file", [1, 3, 4096])
def test_round_trip(workers, per_file):
    out = warc.archive_pages(frame(workers, PAGES), records_per_file=per_file).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str) == plain(PAGES)
    assert {r.url for r in out if r.page_id == 8} == {"http://x.example/ü%0D%0AX-Page-ID: 99"}


def test_captures_are_in_global_order(workers):
    captures = warc.archive_pages(frame(workers, PAGES * 3), records_per_file=4)
    keys = [(r.url_key, r.captured, r.archive, r.offset) for r in captures.collect()]
    assert keys == sorted(keys) and len(keys) == 3 * len(PAGES)


def test_records_stand_at_their_offsets(workers):
    stages = Stages(workers, "t")
    path = warc.write_archives(frame(workers, PAGES), stages, records_per_file=5)
    files = {r.path.rsplit("/", 1)[-1]: bytes(r.content) for r in
             workers.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()}
    rows = warc.read_archives(workers, path).collect()
    for r in rows:
        record = files[r.archive][r.offset:r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    assert sum(r.length for r in rows) == sum(map(len, files.values()))


def test_a_changed_payload_is_noticed(workers):
    record = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 6\r\n\r\n\r\n\r\nab\r\n\r\n")
    (offset, length, headers, block), = warc.records(record)
    with pytest.raises(ValueError, match="digest"):
        warc.capture("a", offset, length, headers, block)
    with pytest.raises(ValueError, match="length"):
        list(warc.records(record.replace(b": 6", b": 5")))


def test_empty_table(workers):
    assert warc.archive_pages(workers.createDataFrame([], SCHEMA)).collect() == []


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.COM:80/A?b=C") == "com,example)/a?b=c"
    assert warc.url_key("example.com:81") == "com,example:81)/" and warc.url_key(None) == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50).map(lambda x: (x,))), max_size=9))
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    assert list(warc.LoserTree(runs, lambda r: r)) == sorted(x for r in runs for x in r)


def test_query(workers):
    out = queries.queries()["op7_warc"](workers, SF01).collect()
    pages = [(r.page_id, None, r.html) for r in workers.read.parquet(f"{SF01}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in out), key=str) == plain(pages) and random is not None


def test_files_are_bounded_by_bytes(workers):
    pages = [(k, f"http://h.example/{k}", f"{k} " + "x" * (10 if k % 10 else 60_000)) for k in range(60)]
    stages = Stages(workers, "t")
    path = warc.write_archives(frame(workers, pages).coalesce(1), stages, file_bytes=200_000)
    sizes = [r.length for r in workers.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(path).collect()]
    assert max(sizes) < 200_000 and len(sizes) > 2
    out = warc.archive_pages(frame(workers, pages), file_bytes=200_000, keep_archives=False).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str) == plain(pages)
    one = warc.archive_pages(frame(workers, pages), file_bytes=1000).collect()         # a record above the bound stands alone
    assert len(one) == len(pages)
