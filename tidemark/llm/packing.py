"""Packing by power-of-two decomposition.

Each document is cut into pieces whose lengths are powers of two: as many of ``max_tokens`` as fit, then the
binary digits of the rest, longest first. A piece is a training sequence of its own, so no sequence holds two
documents and none needs padding. Pieces are stored by length, so a trainer draws batches of equal lengths.

The work is one pass without a shuffle. ``sequence_id`` is built from the place of the piece in the stored
table (writer task, row in its file, bucket), which is unique and stays the same once the table is written.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANK, by_bytes, out_batch, prefix_hash, small, span_hashes, Stages, utf8

MAX_TOKENS = 4096
END_ID = 2
# Distinct chunks that a task keeps the ids of (about 40 bytes each), and the text it tokenizes at a time.
MOST_WORDS = 1_200_000
BATCH_BYTES = 1024 * 1024

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("doc_tokens", pa.int64())])

# ASCII punctuation without the apostrophe. The tokenizer splits between letters and a run of these, and neither side
# can change the other.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level tokenizers write for each byte: itself where printable, else 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordTokens:
    """Token ids of whole texts through a table of the white-space separated chunks seen so far.

    Valid for tokenizers that drop white space and never merge across it, as the word-end BPE does: the ids of a
    text are then the ids of its chunks one after another. Each distinct chunk of a batch is looked up once, by a
    64-bit hash of its bytes, and new ones are tokenized; the table is emptied when it holds ``most_words``.
    """

    def __init__(self, path: str, most_words: int = MOST_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        if getattr(self.model, "end_of_word_suffix", None) is None:
            raise ValueError("a tokenizer whose words end at white space is needed")
        self.letters = byte_letters()
        self.most_words = most_words
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.first = np.empty(0, np.int64)  # where the ids of a chunk start in the pool
        self.count = np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)
        self.parts: dict[str, list[int]] = {}

    def _part(self, part: str) -> list[int]:
        """One pre-token that normalisation leaves as it is: straight to the merges."""
        if (found := self.parts.get(part)) is None:
            written = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            if len(self.parts) >= self.most_words // 8:
                self.parts.clear()
            self.parts[part] = found = [t.id for t in self.model.tokenize(written)]
        return found

    def _chunk(self, chunk: bytes) -> list[int]:
        text = chunk.decode()
        lower = text.lower()
        letters = lower.rstrip(PUNCTUATION)
        # Latin-1 letters are composed already and have one lower case each
        if not letters.isalpha() or not (text.isascii() or max(text) <= "\xff"):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        rest = lower[len(letters):]
        return self._part(letters) + self._part(rest) if rest else self._part(letters)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        ids = [self._chunk(w) for w in words]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.first = np.insert(self.first, at, len(self.pool) + np.cumsum(count) - count)
        self.count = np.insert(self.count, at, count)
        self.pool = np.concatenate([self.pool, new])

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's ids start (one entry more than texts)."""
        data = b" ".join([*texts, b""])
        blank = np.empty(len(data) + 1, dtype=bool)
        blank[0], blank[1:] = True, BLANK[np.frombuffer(data, np.uint8)]
        starts = np.flatnonzero(blank[:-1] & ~blank[1:])
        ends = np.flatnonzero(~blank[:-1] & blank[1:])
        found, first, word = np.unique(span_hashes(prefix_hash(data), starts, ends), return_index=True,
                                       return_inverse=True)
        if len(self.hashes) >= self.most_words:
            self._clear()
        at = np.searchsorted(self.hashes, found)
        new = np.ones(len(found), dtype=bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != found[inside]
        if new.any():
            self._learn(found[new], [data[starts[i]:ends[i]] for i in first[new]])
            at = np.searchsorted(self.hashes, found)
        count = self.count[at][word]
        before = np.concatenate(([0], np.cumsum(count)))
        ids = self.pool[np.repeat(self.first[at][word] - before[:-1], count) + np.arange(before[-1])]
        text_starts = np.cumsum([0, *(len(x) + 1 for x in texts)])
        return ids, before[np.searchsorted(starts, text_starts)]


def piece_lengths(n: int, max_tokens: int = MAX_TOKENS) -> list[int]:
    """``max_tokens`` as often as it fits, then the binary digits of the rest, largest first."""
    rest = n % max_tokens
    return [max_tokens] * (n // max_tokens) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def decompose(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
              max_tokens: int = MAX_TOKENS, end_id: int = END_ID, most_words: int = MOST_WORDS,
              batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Pieces (``doc_id, start, length, ids, doc_tokens``) of every document, in one pass.

    Null and empty texts hold the end token alone. Repeated rows are packed once per row; an empty table gives
    no pieces; other columns are not read. ``most_words`` and ``batch_bytes`` bound a task's memory, not its result.
    ``ids`` are little-endian unsigned 32-bit integers.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens(vocabulary, most_words)
        for batch in small(batches):
            doc_ids, texts = batch.column(0).to_pylist(), utf8(batch, "text")
            for part in by_bytes(texts, batch_bytes):
                ids, first = words.ids(texts[part])
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                out: list[list] = [[], [], [], [], []]
                for doc_id, a, b in zip(doc_ids[part], first[:-1].tolist(), first[1:].tolist()):
                    n, at = b - a + 1, 0
                    own = bytes(data[4 * a:4 * b]) + end
                    for length in piece_lengths(n, max_tokens):
                        for column, value in zip(out, (doc_id, at, length, own[4 * at:4 * (at + length)], n)):
                            column.append(value)
                        at += length
                yield out_batch(_PIECES, out)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, PIECES)


def pack(docs: DataFrame, vocabulary: str, *, max_tokens: int = MAX_TOKENS, **columns) -> DataFrame:
    """Pack into sequences: the pieces with ``sequence_id`` and ``offset`` (0, as a piece is its sequence).

    The pieces are written once to the shared folder in one directory per length, and read back.
    """
    stages = Stages(docs.sparkSession, "packing")
    pieces = stages.put(decompose(docs, vocabulary, max_tokens=max_tokens, **columns), "pieces", ["length"])
    task = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    place = F.shiftleft(task, 32) + F.col("_metadata.row_index")
    bucket = F.log2(F.col("length").cast("double")).cast("long")
    return pieces.select("doc_id", "start", "length", "ids", "doc_tokens",
                         (place * 32 + bucket).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
