"""Substring deduplication over token windows: Rabin-Karp hashes of every window, counted in Spark.

A word is removed when a window of ``window`` consecutive words that covers it also starts in a document with a
smaller id. Windows are judged on the input, not on what is left.

1. Every word gets a 64-bit hash of its bytes; every window gets two rolling hashes of its words. The top bits of one are its
   bucket, the other is its value there. The number of buckets follows the size of the texts, so a bucket holds about
   ``BUCKET_WINDOWS`` windows at every size, and the number of compared bits grows along.
2. A task handles ``CHUNK_WORDS`` words of whole documents at a time. Of equal windows in a chunk only those of the
   smallest id are sent on; the others are repeats already. So a passage that a third of all documents share reaches a
   bucket once per chunk. The windows travel packed: per chunk and bucket one row with their hashes, and their
   documents and positions as compressed differences.
3. A bucket finds the smallest id of each window; later documents' windows are repeats. Their starts are gathered per
   document and united into maximal intervals of words, which the last pass cuts from the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    BLANK, broadcast_if_small, by_bytes, mix64, out_batch, powers, BASE, prefix_hash, small, span_hashes, Stages, utf8)

WINDOW = 13
CHUNK_WORDS = 1_000_000
BUCKET_WINDOWS = 250_000
# Mean bytes of a word and the blank after it, for the number of buckets alone.
WORD_BYTES = 7
SEGMENT = 1 << 20
# A start that is sent carries the number of the text among those of its id above this bit.
TEXT_BIT = 32

_BLANK = re.compile(rb"[ \t-\r]")
_SECOND = np.uint64(0xD1B54A32D192ED03)  # tells the hashes of the bucket from those of the value


# ---- 1. words and windows -----------------------------------------------------------------

def _segments(text: bytes) -> Iterator[bytes]:
    """The text in parts of about ``SEGMENT`` bytes that end before a blank."""
    start = 0
    while start < len(text):
        cut = _BLANK.search(text, start + SEGMENT) if start + SEGMENT < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def _codes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word."""
    blank = BLANK[np.frombuffer(data, dtype=np.uint8)]
    edge = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return span_hashes(prefix_hash(data), first, end), first


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, and the number of words of each text."""
    codes, counts = [], np.zeros(len(texts), dtype=np.int64)
    for part in by_bytes(texts, SEGMENT):
        group = texts[part]
        if len(group) == 1:
            for segment in _segments(group[0]):
                found, _ = _codes(segment)
                codes.append(found)
                counts[part.start] += len(found)
            continue
        found, first = _codes(b" ".join(group))
        starts = np.cumsum([0] + [len(x) + 1 for x in group[:-1]])
        counts[part] = np.bincount(np.searchsorted(starts, first, side="right") - 1, minlength=len(group))
        codes.append(found)
    return np.concatenate(codes) if codes else np.empty(0, np.uint64), counts


def window_hashes(codes: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Text, start, value and bucket hash of every window; none spans two texts."""
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.flatnonzero(start + window <= counts[text])
    hashes = []
    for words in (codes, mix64(codes ^ _SECOND)):
        prefix = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * powers(BASE, len(words)), out=prefix[1:])
        hashes.append(span_hashes(prefix, at, at + window))
    return text[at], start[at], *hashes


# ---- 2. rows of a chunk -------------------------------------------------------------------

def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def packed(ids: np.ndarray, starts: np.ndarray) -> bytes:
    import zstandard

    return zstandard.compress(_planes(np.diff(ids, prepend=np.int64(0))) + _planes(starts), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    both = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(2, 8, -1)
    change, starts = (np.ascontiguousarray(x.T).view("<i8").ravel() for x in both)
    return np.cumsum(change), starts


def later(values: np.ndarray, ids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of the windows in ``order`` (by value, then id): those with a smaller id among the equal ones, as a mask in place."""
    out = np.zeros(len(values), dtype=bool)
    if len(values):
        value, id_ = values[order], ids[order]
        head = np.concatenate(([True], value[1:] != value[:-1]))
        out[order] = id_ > id_[np.flatnonzero(head)[np.cumsum(head) - 1]]
    return out


_CHUNK = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("places", pa.binary())])


def chunk_rows(ids: np.ndarray, tags: np.ndarray, texts: list[bytes], window: int, bits: int) -> pa.RecordBatch:
    """The rows of one chunk: windows by bucket, and repeats that are known already (rows without hashes)."""
    order = np.argsort(ids, kind="stable")
    ids, tags = ids[order], tags[order]
    codes, counts = word_codes([texts[k] for k in order])
    text, start, value, second = window_hashes(codes, counts, window)
    id_, start = ids[text], start + (tags[text] << TEXT_BIT)
    # the texts stand in the order of their ids, and a stable sort keeps it among equal windows
    repeat = later(value, id_, np.argsort(value, kind="stable"))
    bucket = (second >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
    sent = np.flatnonzero(~repeat)
    sent = sent[np.argsort(bucket[sent], kind="stable")]
    edges = np.flatnonzero(np.diff(bucket[sent].astype(np.int64), prepend=-1))
    out: list[list] = [[], [], []]
    for a, b in zip(edges, np.append(edges[1:], len(sent))):
        rows = sent[a:b]
        for column, item in zip(out, (int(bucket[rows[0]]), value[rows].tobytes(), packed(id_[rows], start[rows]))):
            column.append(item)
    known = np.flatnonzero(repeat)
    for a in range(0, len(known), 65_536):  # dealt out over the buckets, as any task may pass them on
        rows = known[a:a + 65_536]
        for column, item in zip(out, (int(bucket[rows[0]]), None, packed(id_[rows], start[rows]))):
            column.append(item)
    return out_batch(_CHUNK, out)


def windows_by_bucket(texts: DataFrame, window: int, bits: int, chunk_words: int) -> DataFrame:
    """``bucket, hashes, places`` over ``id, tag, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in small(batches):
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch, "text")):
                held.append(row)
                size += len(row[2])
                if size >= chunk_words * WORD_BYTES:
                    yield chunk_rows(*_columns(held), window, bits)
                    held, size = [], 0
        if held:
            yield chunk_rows(*_columns(held), window, bits)

    return texts.select("id", "tag", "text").mapInArrow(run, "bucket int, hashes binary, places binary")


def _columns(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    ids, tags, texts = zip(*rows)
    return np.array(ids, dtype=np.int64), np.array(tags, dtype=np.int64), list(texts)


# ---- 3. repeats of a bucket ---------------------------------------------------------------

_STARTS = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("start", pa.int32())])


def _starts(ids: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    return out_batch(_STARTS, [ids, starts >> TEXT_BIT, (starts & ((1 << TEXT_BIT) - 1)).astype(np.int32)])


def repeated_starts(buckets: DataFrame) -> DataFrame:
    """``id, tag, start`` of windows that a smaller id has too."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        value = np.concatenate([np.frombuffer(h, np.uint64) for h, _ in rows])
        ids, starts = (np.concatenate(x) for x in zip(*[unpacked(p) for _, p in rows]))
        repeat = later(value, ids, np.lexsort((ids, value)))
        return _starts(ids[repeat], starts[repeat])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None
        for batch in small(batches, 64):
            for bucket, hashes, places in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != at and held:
                    yield solve(held)
                    held = []
                at = bucket
                if hashes is None:
                    yield _starts(*unpacked(places))
                else:
                    held.append((hashes, places))
        if held:
            yield solve(held)

    return buckets.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "id long, tag long, start int")


def united(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals covered by windows at these starts (sorted, first to end)."""
    if not len(starts):
        return starts, starts
    starts = np.unique(starts)
    head = np.concatenate(([True], starts[1:] > starts[:-1] + window))
    return starts[head], starts[np.append(np.flatnonzero(head)[1:] - 1, len(starts) - 1)] + window


def repeated_spans(starts: DataFrame, window: int) -> DataFrame:
    """``id, tag, spans``: one row per text with repeats."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("spans", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            spans = []
            for row in batch.column(2):
                first, end = united(row.values.to_numpy(zero_copy_only=False), window)
                spans.append([{"start": a, "end": b} for a, b in zip(first.tolist(), end.tolist())])
            yield out_batch(schema, [batch.column(0), batch.column(1), spans])

    gathered = starts.groupBy("id", "tag").agg(F.collect_list("start").alias("starts"))
    return gathered.mapInArrow(run, "id long, tag long, spans array<struct<start:long,end:long>>")


def with_tags(rows: DataFrame, stages: Stages) -> DataFrame:
    """Add ``tag``: 0, or the number of the text among the different texts of an id that occurs repeatedly."""
    again = stages.put(rows.groupBy("id").agg(F.count("*").alias("c")).where("c > 1").select("id"), "again")
    if again.isEmpty():
        return rows.withColumn("tag", F.lit(0).cast("long"))
    texts = rows.withColumns({"x1": F.xxhash64("text"), "x2": F.xxhash64(F.lit(1), F.col("text"))})
    keys = texts.join(broadcast_if_small(again, 8), "id", "left_semi").select("id", "x1", "x2").distinct()
    place = F.row_number().over(Window.partitionBy("id").orderBy("x1", "x2")) - 1
    tags = stages.put(keys.withColumn("tag", place.cast("long")), "tags")
    return texts.join(broadcast_if_small(tags, 32), ["id", "x1", "x2"], "left").select(
        *rows.columns, F.coalesce("tag", F.lit(0).cast("long")).alias("tag"))


SPANS = "array<struct<start:long,end:long>>"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("text", pa.binary()), ("kept_sha256", pa.string())])


def remove_repeated_windows(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                            chunk_words: int = CHUNK_WORDS, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, text, kept_sha256`` of every row; ``text`` is the kept words, joined by a space.

    ``spans`` are the removed intervals of words (null without any). Words are the runs between ASCII white space.
    Null texts count as empty; a text of fewer words than a window stays whole; rows that repeat an id are documents
    of their own and never repeat each other; a null id is smaller than every other; an empty table gives no rows;
    other columns are not read.
    """
    if window < 1:
        raise ValueError("a window has at least one word")
    stages = Stages(docs.sparkSession, "windows")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(4, (size // WORD_BYTES // bucket_windows).bit_length())
    rows = with_tags(rows, stages)
    starts = repeated_starts(windows_by_bucket(rows, window, bits, chunk_words))
    spans = stages.put(repeated_spans(starts, window), "spans")
    marked = rows.join(broadcast_if_small(spans, F.lit(32) + 16 * F.size("spans")), ["id", "tag"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, data, spans in zip(batch.column(0).to_pylist(), utf8(batch, "text"), batch.column(2).to_pylist()):
                words = data.split()
                kept, at = [], 0
                for s in spans or ():
                    kept += words[at:s["start"]]
                    at = s["end"]
                kept += words[at:]
                rest = b" ".join(kept)
                for column, value in zip(out, (doc_id, len(words), len(words) - len(kept), spans, rest,
                                               sha256(rest).hexdigest())):
                    column.append(value)
            yield out_batch(_RESULT, out)

    done = marked.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id long, n_words long, n_removed long, spans {SPANS}, text binary, kept_sha256 string")
    return done.withColumn("text", F.col("text").cast("string"))
