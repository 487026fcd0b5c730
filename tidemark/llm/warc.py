"""WARC archives with an externally merged capture index.

``write_archives`` writes one WARC/1.1 record per page: payloads that another page holds already become revisit
records. Spark's own text writer lays the records into files in the shared folder, so commits, retries and remote
stores work as for any table. ``read_archives`` walks the records of each file by their lengths, checks payload digests
and gives one run of captures per file, sorted by URL key and time. ``merge_runs`` cuts the key range into
partitions and merges the run pieces of each with a loser tree (k-way, log k comparisons a row) into globally
ordered capture histories.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Stages, broadcast_if_small, out_batch

LEAST_BYTES = 100
RECORDS_PER_FILE = 4096
# Bytes of an archive, but for one longer record alone: a file is read as one value, which may have 2 GB.
FILE_BYTES = 128 * 1024 * 1024
# Bytes of a record besides its payload, at most: headers and URL.
HEAD_BYTES = 8192
# Captures without a time of their own: this moment (UTC) and the page id in seconds.
FIRST_CAPTURE = 1_577_836_800

CRLF = "\r\n"
CAPTURES = ("url_key string, captured string, archive string, offset long, length long, url string, page_id long, "
            "record_type string, payload_bytes long, payload_digest string, refers_to long")
_CAPTURES = pa.schema([("url_key", pa.string()), ("captured", pa.string()), ("archive", pa.string()),
                       ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("page_id", pa.int64()),
                       ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("refers_to", pa.int64())])


# ---- writing ------------------------------------------------------------------------------

def _record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), page_id.cast("string")).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or null (left out) for a null value; line ends in a value are escaped."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(f"{name}: "), clean)


def with_revisits(pages: DataFrame, stages: Stages, least_bytes: int) -> DataFrame:
    """``payload, payload_bytes, payload_digest, refers_to``: the smallest page id with an equal payload.

    The first holders come from one partial aggregation over digests; only digests that occur more than once are
    joined back, so the payloads themselves are not shuffled while that list is small.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.withColumn("payload", payload).withColumn("payload_bytes", F.octet_length("payload").cast("long")
                                                           ).withColumn("payload_digest", F.sha2("payload", 256))
    held = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = broadcast_if_small(stages.put(held, "firsts"), 120)
    return rows.join(firsts, "payload_digest", "left").withColumn(
        "refers_to", F.when(F.col("page_id") > F.col("first_id"), F.col("first_id")))


def write_archives(pages: DataFrame, stages: Stages, *, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", captured_col: str | None = None, least_bytes: int = LEAST_BYTES,
                   records_per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES) -> str:
    """Write the archives and return their folder.

    Files are bounded by ``records_per_file`` and by ``file_bytes``: records are written by size class (powers of two),
    each class with as many records to a file as fit at its largest size. Usually all records are in the first class, and
    there is one write; there are at most as many as classes.
    """
    seconds = (F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(10**9)) if captured_col is None
               else F.unix_seconds(F.col("captured_at")))
    source = [F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
              F.col(f"`{html_col}`").cast("string").alias("html")]
    if captured_col is not None:
        source.append(F.col(f"`{captured_col}`").cast("timestamp").alias("captured_at"))
    rows = with_revisits(pages.select(*source), stages, least_bytes)
    utc = F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone())
    date = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat_ws(CRLF, F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
                       _header("Content-Length", F.col("payload_bytes").cast("string")), F.lit(CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"))),
        _header("WARC-Date", date),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _header("X-Page-ID", F.col("page_id").cast("string")),
        _header("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        _header("Content-Length", F.octet_length("block").cast("string")), F.lit(CRLF))
    path = stages.path("archives")
    # class k: records of at most 2**k bytes; the first one is what fits records_per_file times
    first = max(1, (max(1, file_bytes // records_per_file)).bit_length() - 1)
    size = F.col("payload_bytes") + HEAD_BYTES + F.coalesce(F.octet_length("url"), F.lit(0))
    power = F.greatest(F.lit(first), F.ceil(F.log2(size.cast("double"))).cast("int"))
    given = pages.select(F.octet_length(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))).cast("long").alias(
        "payload_bytes"), F.col(f"`{url_col}`").cast("string").alias("url"))
    classes = sorted(r[0] for r in given.select(power.alias("k")).distinct().collect()) or [first]
    for k in classes:
        own = rows.where(power == k) if len(classes) > 1 else rows
        records = own.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))
        records.write.mode("overwrite").option("lineSep", CRLF + CRLF).option(
            "maxRecordsPerFile", min(records_per_file, max(1, file_bytes >> k))).text(f"{path}/size={k}")
    return path


# ---- reading ------------------------------------------------------------------------------

def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the top domain down, then path and query, in small letters."""
    if not url:
        return ""
    text = url.strip().lower()
    try:
        parts = urlsplit(text if "://" in text else "http://" + text)
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return text
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record of an archive; raises on a broken one."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        lines = data[at:head].decode().split(CRLF)
        if head < 0 or lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        end = head + 4 + int(headers["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, end + 4 - at, headers, data[head + 4:end]
        at = end + 4


def capture(archive: str, offset: int, length: int, headers: dict[str, str], block: bytes) -> tuple:
    """The index row of a record; the digest of a stored payload is computed again and compared."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if headers["WARC-Type"] == "response":
        size = len(payload)
        if sha256(payload).hexdigest() != digest:
            raise ValueError(f"{archive}: the payload at byte {offset} does not have its digest")
    else:
        size = int(dict(x.split(": ", 1) for x in http.decode().split(CRLF)[1:])["Content-Length"])
    ids = [int(headers[x]) if x in headers else None for x in ("X-Page-ID", "X-Refers-To-Page-ID")]
    url = headers.get("WARC-Target-URI")
    return (url_key(url), headers.get("WARC-Date", ""), archive, offset, length, url, ids[0], headers["WARC-Type"], size,
            digest, ids[1])


ORDER = ("url_key", "captured", "archive", "offset")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One sorted run of captures per archive file (a file is bounded by its records and bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                name = archive.rsplit("/", 1)[-1]
                rows = sorted((capture(name, *r) for r in records(data.as_py())), key=lambda r: r[:4])
                if rows:
                    yield out_batch(_CAPTURES, list(zip(*rows)))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, CAPTURES)


# ---- merging ------------------------------------------------------------------------------

class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, so the next winner replays one path to the root."""

    def __init__(self, runs: list[list[tuple]], key: Callable[[tuple], tuple]):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = len(runs)
        self.heads: list[tuple | None] = [None] * self.k
        self.keys: list[tuple | None] = [None] * self.k
        for i in range(self.k):
            self._advance(i)
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._replay(i)

    def _advance(self, i: int) -> None:
        self.heads[i] = next(self.runs[i], None)
        self.keys[i] = None if self.heads[i] is None else self.key(self.heads[i])

    def _beats(self, a: int, b: int) -> bool:
        """Run a goes before run b; a finished run loses, an unset one (-1) wins, ties go to the lower run."""
        if a < 0 or b < 0:
            return a < 0
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _replay(self, i: int) -> None:
        node = (i + self.k) // 2
        while node > 0:
            if self._beats(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while self.k and (row := self.heads[w := self.losers[0]]) is not None:
            yield row
            self._advance(w)
            self._replay(w)


def merge_runs(runs: DataFrame) -> DataFrame:
    """Captures in global order of (URL key, time): partitions are ranges, rows within are merged from the runs.

    The range covers archive and offset too, so that a URL captured very often is split like any other keys.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                pieces.setdefault(row[2], []).append(row)
        for rows in pieces.values():
            rows.sort(key=lambda r: r[:4])  # a shuffle may deliver the pieces of a run in another order
        out: list[tuple] = []
        for row in LoserTree(list(pieces.values()), lambda r: r[:4]):
            out.append(row)
            if len(out) == 8192:
                yield out_batch(_CAPTURES, list(zip(*out)))
                out = []
        if out:
            yield out_batch(_CAPTURES, list(zip(*out)))

    return runs.repartitionByRange(*ORDER).mapInArrow(run, CAPTURES)


def archive_pages(pages: DataFrame, keep_archives: bool = True, **options) -> DataFrame:
    """Write ``pages`` to WARC files, read them back and return the merged capture index.

    The archives stay in the shared folder, as the index names their records, unless ``keep_archives`` is false.

    Of payloads of at least ``least_bytes`` bytes that are equal, the row with the smallest page id is the response
    and larger ids revisit it; rows that repeat that very id are responses too, as are null ids. Null html is an
    empty payload; a null URL has an empty key; an empty table gives no captures; other columns are not read.
    """
    stages = Stages(pages.sparkSession, "warc")
    path = write_archives(pages, stages, **options)
    runs = stages.put(read_archives(pages.sparkSession, path), "runs")
    captures = stages.put(merge_runs(runs), "captures")
    stages.keep("captures")
    stages.names.add("archives")
    if not keep_archives:
        stages.drop("archives")
    return captures
