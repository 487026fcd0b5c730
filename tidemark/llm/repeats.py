"""Suffix-array deduplication of repeated byte strings by prefix-free parsing.

A byte is removed when a string of ``length`` bytes that covers it starts anywhere else too, in the same document or
another one. Texts are cut into phrases at triggers, as in prefix-free parsing, and only phrase boundaries are sorted:

1. Triggers. Every string of ``length`` bytes has one trigger: the position of the smallest rolling hash (of
   ``GRAM`` bytes) among its first half. It depends on the string's bytes alone, so equal strings have it at the same
   place; a boundary serves a run of string starts before it. About 1 position in 100 is a boundary.
2. Equal strings agree on what follows their boundary for more than half the length. Boundaries are counted by the hash
   of those bytes; those that occur once cannot lie in a repeat and leave, nearly all of them.
3. The dictionary. The context of a boundary is all that its strings cover: the phrase before (up to the trigger) and the
   bytes after. Equal contexts are one entry, found by partial aggregation of their hashes. An entry that occurs more than
   once is repeated throughout at every occurrence; only one occurrence of each entry goes on.
4. Entries that agree on the bytes of step 2 are a group. Two suffix arrays are built of its entries: of the phrase ends,
   read backwards, and of the parse (what follows the boundary), each with common-prefix lengths. The string that starts t
   bytes before a boundary is the last t bytes of the phrase and ``length - t`` bytes of the parse; it is repeated if
   another entry is in the same interval of both arrays. This is the corpus order of all strings of the group, without
   sorting them one by one.
5. A group of more than ``most_group`` entries does not go to one task. Equal strings have the same t, so its boundaries are
   split by ranges of t; the strings of a range agree on more bytes on both sides, which part the group, and steps 2 to 4
   follow for the parts, with ever narrower ranges. At one t the entries of a part are one string, so this ends.
6. Intervals of repeated strings are united per document.

Equal texts are one class first: a class of several texts of ``length`` bytes or more is repeated throughout, and only
its first text is parsed. Entries are equal by 128 bits of hashes; strings of different entries are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, out_batch, prefix_hash, small, span_hashes, Stages, utf8

LENGTH = 400
GRAM = 16
MOST_GROUP = 20_000
# A group beyond that is split into so many ranges of string starts at a time.
RANGES = 8
# Rows of boundaries that a task sorts at a time, besides the last group.
CHUNK_ROWS = 20_000
SEGMENT = 1 << 20

# a boundary packed in a long: position, then the least and the most bytes that string starts lie before it
_SHIFT = 1 << 24
_HASH_BITS = np.uint64(~((1 << 28) - 1) & (2**64 - 1))


# ---- 1. triggers --------------------------------------------------------------------------

def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every ``width`` consecutive ones."""
    count = len(values) - width + 1
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def boundaries(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed boundaries of a whole text, the hash of the bytes that follow each, and that of all its strings cover."""
    half = length // 2
    packed, keys, contexts = [], [], []
    for first in range(0, max(0, len(text) - length + 1), SEGMENT):
        part = text[first:first + SEGMENT + length - 1]
        prefix = prefix_hash(part)
        gram = min(GRAM, length - half + 1)
        at = np.arange(len(part) - gram + 1)
        hashes = (span_hashes(prefix, at, at + gram) & _HASH_BITS) | at.astype(np.uint64)
        starts = len(part) - length + 1  # strings that start in this segment
        trigger = (sliding_least(hashes[:starts + half - 1], half)[:starts] & ~_HASH_BITS).astype(np.int64)
        run = np.flatnonzero(np.concatenate(([True], trigger[1:] != trigger[:-1])))
        last = np.concatenate((run[1:], [starts])) - 1
        place = trigger[run]
        packed.append(((first + place) * _SHIFT + (place - last) * 4096 + (place - run)))
        keys.append(span_hashes(prefix, place, place + length - half + 1))
        contexts.append(span_hashes(prefix, run, last + length))
    if not packed:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(packed), np.concatenate(keys), np.concatenate(contexts)


def parted(text: bytes, packed: list[int], width: int, length: int) -> tuple[list[int], list[int], list[int]]:
    """Boundaries by ranges of ``width`` string starts: places, hashes of what a range agrees on, and of its context."""
    import xxhash

    places, keys, contexts = [], [], []
    for place in packed:
        at, least, most = place // _SHIFT, place % _SHIFT // 4096, place % 4096
        for low in range(least - least % width, most + 1, width):
            high = min(low + width, length // 2) - 1  # the range is low to high in every text
            first, last = max(low, least), min(high, most)
            places.append(at * _SHIFT + first * 4096 + last)
            keys.append(xxhash.xxh3_64_intdigest(text[at - low:at + length - high], low))
            contexts.append(xxhash.xxh3_64_intdigest(text[at - last:at + length - first], length))
    return places, keys, contexts


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed // _SHIFT, packed % _SHIFT // 4096, packed % 4096


# ---- 3. suffix arrays ---------------------------------------------------------------------

def suffix_order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the strings, and the common prefix length of each with the one before it."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    width = max(map(len, strings), default=0)
    lengths = np.array([len(strings[k]) for k in order])
    if not width:
        return np.array(order, dtype=np.int64), np.zeros(len(order), dtype=np.int64)
    rows = np.frombuffer(b"".join(strings[k].ljust(width, b"\0") for k in order), np.uint8).reshape(-1, width)
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(lengths[1:], lengths[:-1]))
    return np.array(order, dtype=np.int64), np.concatenate(([0], common))


def repeated_starts(before: list[bytes], after: list[bytes], least: np.ndarray, most: np.ndarray,
                    length: int) -> np.ndarray:
    """``out[t, k]``: the string that starts t bytes before boundary k occurs at another boundary too."""
    count = len(before)
    left, left_common = suffix_order([x[::-1] for x in before])
    right, right_common = suffix_order(after)
    out = np.zeros((int(most.max(initial=0)) + 1, count), dtype=bool)
    left_class, right_class = np.empty(count, np.int64), np.empty(count, np.int64)
    for t in range(int(least.min(initial=0)), len(out)):
        own = np.flatnonzero((least <= t) & (t <= most))
        if len(own) < 2:
            continue
        left_class[left] = np.cumsum(left_common < t)
        right_class[right] = np.cumsum(right_common < length - t)
        _, back, times = np.unique(left_class[own] * (count + 1) + right_class[own], return_inverse=True,
                                   return_counts=True)
        out[t, own[times[back] > 1]] = True
    return out


def spans_of(place: np.ndarray, repeated: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(boundary, start, end) of the bytes covered by runs of repeated strings."""
    edge = np.diff(np.pad(repeated, ((1, 1), (0, 0))).astype(np.int8), axis=0)
    which, low = np.nonzero(edge.T == 1)
    _, high = np.nonzero(edge.T == -1)  # runs of t from low to high - 1
    return which, place[which] - high + 1, place[which] - low + length


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


# ---- Spark --------------------------------------------------------------------------------

ROW = "id long, x1 long"
SPANS = "id long, x1 long, start long, end long"
_SPANS = pa.schema([("id", pa.int64()), ("x1", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


_PLACES = pa.schema([("id", pa.int64()), ("x1", pa.int64()), ("key", pa.list_(pa.int64())), ("context", pa.list_(pa.int64())),
                     ("place", pa.list_(pa.int64()))])
PLACES = f"{ROW}, key array<long>, context array<long>, place array<long>"


def one_per_row(found: DataFrame) -> DataFrame:
    return found.select("id", "x1", F.explode(F.arrays_zip("key", "context", "place")).alias("b")).select("id", "x1", "b.*")


def find_boundaries(texts: DataFrame, length: int) -> DataFrame:
    """``id, x1, key, context, place`` of every boundary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out: list[list] = [[], [], [], [], []]
            for id_, x1, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch, "text")):
                place, key, context = boundaries(text, length)
                if len(place):
                    for column, value in zip(out, (id_, x1, key.view(np.int64), context.view(np.int64), place)):
                        column.append(value)
            yield out_batch(_PLACES, out)

    return one_per_row(texts.where(F.octet_length("text") >= length).mapInArrow(run, PLACES))


def split_boundaries(texts: DataFrame, chosen: DataFrame, width: int, length: int) -> DataFrame:
    """The boundaries ``places`` of each chosen row by ranges of ``width`` string starts, as ``find_boundaries`` gives them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 64):
            out: list[list] = [[], [], [], [], []]
            for id_, x1, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                             utf8(batch, "text"), batch.column(3).to_pylist()):
                place, key, context = parted(text, [p["place"] for p in places], width, length)
                as_long = [np.array(x, dtype=np.uint64).view(np.int64) for x in (key, context)]
                for column, value in zip(out, (id_, x1, *as_long, place)):
                    column.append(value)
            yield out_batch(_PLACES, out)

    return one_per_row(texts.join(chosen, ["id", "x1"]).select("id", "x1", "text", "places").mapInArrow(run, PLACES))


def with_context(texts: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """``key, id, x1, place, before, after`` for the boundaries ``places`` of each chosen row."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("x1", pa.int64()), ("place", pa.int64()),
                        ("before", pa.binary()), ("after", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out: list[list] = [[], [], [], [], [], []]
            for id_, x1, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                             utf8(batch, "text"), batch.column(3).to_pylist()):
                for p in places:
                    at, least, most = unpack(p["place"])
                    for column, value in zip(out, (p["key"], id_, x1, p["place"], text[at - most:at],
                                                   text[at:at + length - least])):
                        column.append(value)
                if len(out[0]) >= 4096:
                    yield out_batch(schema, out)
                    out = [[], [], [], [], [], []]
            yield out_batch(schema, out)

    rows = texts.join(chosen, ["id", "x1"]).select("id", "x1", "text", "places")
    return rows.mapInArrow(run, f"key long, {ROW}, place long, before binary, after binary")


def spans_by_order(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated spans from the two suffix arrays, some groups of keys at a time."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        _, ids, x1, places, before, after = zip(*rows)
        at, least, most = unpack(np.array(places, dtype=np.int64))
        which, start, end = spans_of(at, repeated_starts(list(before), list(after), least, most, length), length)
        return out_batch(_SPANS, [np.array(ids)[which], np.array(x1)[which], start, end])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in small(batches):
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if len(held) >= CHUNK_ROWS and row[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(run, SPANS)


def united_spans(gathered: DataFrame) -> DataFrame:
    """``id, x1, spans`` with the spans of each row united."""
    schema = pa.schema([("id", pa.int64()), ("x1", pa.int64()), ("spans", pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            spans = [[{"start": a, "end": b} for a, b in united([(s["start"], s["end"]) for s in x])]
                     for x in batch.column(2).to_pylist()]
            yield out_batch(schema, [batch.column(0), batch.column(1), spans])

    return gathered.mapInArrow(run, f"{ROW}, spans array<struct<start:long,end:long>>")


def repeated_spans(texts: DataFrame, stages: Stages, length: int, most_group: int) -> DataFrame:
    """``id, x1, spans`` of the rows of ``texts`` (``id, x1, text``) that hold repeated strings."""
    def rows_of(places: DataFrame, name: str) -> DataFrame:
        of_row = F.collect_list(F.struct("key", "place"))
        return stages.put(places.groupBy("id", "x1").agg(of_row.alias("places")), name)

    at, least, most = F.expr(f"place div {_SHIFT}"), F.expr(f"place % {_SHIFT} div 4096"), F.expr("place % 4096")
    found = stages.put(find_boundaries(texts, length), "boundaries-0")
    parts, width, level = [], length // 2, 0
    while True:
        counts = stages.put(found.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), f"counts-{level}")
        kept = stages.put(found.join(broadcast_if_small(counts, 8), "key").withColumn("shape", F.expr(f"place % {_SHIFT}")),
                          f"kept-{level}")
        stages.drop(f"boundaries-{level}", f"counts-{level}")
        entry = ["key", "context", "shape"]
        entries = stages.put(kept.groupBy(entry).agg(F.count("*").alias("c"), F.min(F.struct("id", "x1", "place")).alias("one")),
                             f"entries-{level}")
        often = broadcast_if_small(entries.where("c > 1").select(entry), 24)
        parts.append(kept.join(often, entry, "left_semi").select(
            "id", "x1", (at - most).alias("start"), (at - least + length).alias("end")))
        sizes = stages.put(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), f"sizes-{level}")
        ones = entries.select("key", "one.*").join(broadcast_if_small(sizes, 16), "key")
        # the places grow with the corpus, so their join with the texts is a shuffle at every size
        parts.append(spans_by_order(with_context(
            texts, rows_of(ones.where(F.col("n") <= most_group), f"chosen-{level}"), length), length))
        if width == 1 or sizes.where(F.col("n") > most_group).isEmpty():
            break
        width = -(-width // RANGES)
        split = rows_of(ones.where(F.col("n") > most_group), f"split-{level}")
        found = stages.put(split_boundaries(texts, split, width, length), f"boundaries-{level + 1}")
        level += 1
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.unionByName(part)
    gathered = spans.groupBy("id", "x1").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return stages.put(united_spans(gathered), "spans")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept string, kept_sha256 string"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())])


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   most_group: int = MOST_GROUP, with_kept: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256`` of every row.

    ``kept`` holds the remaining bytes one after another (binary, as a cut may fall within a character; null when
    ``with_kept`` is false). Null texts count as empty; texts shorter than ``length`` stay whole; repeated rows are
    copies of each other, also when they repeat an id; null ids are allowed; an empty table gives no rows; other columns
    are not read.
    """
    if not 32 <= length <= 4000:
        raise ValueError("length must be between 32 and 4000")
    stages = Stages(docs.sparkSession, "repeats")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn(
        "x1", F.xxhash64("text")).withColumn("x2", F.xxhash64(F.lit(1), F.col("text")))
    # classes of equal texts: the first (by id) is parsed, the others are not
    long = rows.where(F.octet_length("text") >= length)
    classes = stages.put(long.groupBy("x1", "x2").agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1")
                         .select("x1", "x2", "first"), "classes")
    copied = broadcast_if_small(classes, 24)
    single = rows.join(copied, ["x1", "x2"], "left").where("first IS NULL OR first = id").select("id", "x1", "text")
    spans = repeated_spans(single, stages, length, most_group)
    stages.keep("classes", "spans")
    marked = rows.join(copied.withColumn("copied", F.lit(True)).drop("first"), ["x1", "x2"], "left").join(
        broadcast_if_small(spans, F.lit(32) + 32 * F.size("spans")), ["id", "x1"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, data, is_copied, spans in zip(batch.column(0).to_pylist(), utf8(batch, "text"),
                                                      batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                cut = [(0, len(data))] if is_copied else [(s["start"], s["end"]) for s in spans or ()]
                kept, at = [], 0
                for start, end in cut:
                    kept.append(data[at:start])
                    at = end
                rest = b"".join([*kept, data[at:]])
                for column, value in zip(out, (doc_id, len(data), len(data) - len(rest), len(cut),
                                               rest if with_kept else None, sha256(rest).hexdigest())):
                    column.append(value)
            yield out_batch(_RESULT, out)

    return marked.select("doc_id", "text", "copied", "spans").mapInArrow(run, RESULT.replace("kept string", "kept binary"))
