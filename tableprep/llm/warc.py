"""WARC archives with an external index merge.

Writing: every row becomes one WARC/1.1 record.  Its payload is the page in
UTF-8 behind a short HTTP response head.  Of rows with equal payloads of at
least ``least_bytes`` bytes, the one with the smallest id is a ``response``
and the others are ``revisit`` records, which keep the HTTP head alone and
refer to it.  The files are written by Spark's text writer with the blank line
that ends a record as line separator and compressed as a whole by gzip, so a
file is one stream of records.

Reading: a task streams its files, cuts records by their ``Content-Length``
(never by a pattern that a payload may hold too), checks the digest of every
payload it meets and makes index entries.  It sorts them by URL key, timestamp
and id in runs of bounded length.  The merge: entries are dealt by ranges of
(URL key, timestamp, id) and each range merges its parts of all runs with a
loser tree, so the ranges in a row are the capture history of every URL.  A
URL with very many captures spans several ranges.

Equal payloads are found by SHA-1, XXH64 and length.  Only ids and digests of
payloads that occur twice or more are joined with the rows, as a table whose
size Spark knows when it chooses the join.

Defined results: a NULL page is an empty payload; a NULL URL is an empty one;
control characters and blanks of a URL are percent-encoded.  Rows are kept one
for one: repeated ids are records of their own, and where they share the
smallest id of equal payloads all of them are responses.  Rows with a NULL id
refer to the smallest id, and are responses where no equal row has one.  A NULL
timestamp is the epoch.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir
from .common import cut_table

#: fixed values of the format
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ENTRY = ("url_key string, timestamp string, page_id long, record_type string, refers_to long, payload_bytes long, "
         "payload_digest string, url string, file string, offset long, length long")
ENTRY_COLUMNS = [x.split()[0] for x in ENTRY.split(", ")]
RUN = ENTRY + ", run long, place long"


def base32_sha1(c: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 20 bits, five hex digits, are four base32 digits."""
    h = F.sha1(c)
    digits = [F.lpad(F.conv(F.substring(h, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*digits), BASE32_HEX, BASE32)


def safe_url(c: Column) -> Column:
    escaped = F.concat_ws("", F.transform(F.split(c, ""), lambda x: F.when(
        x.rlike(r"^[\x00-\x20\x7f]$"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(x)), 2, "0"))).otherwise(x)))
    return F.when(c.isNull(), "").when(c.rlike(r"[\x00-\x20\x7f]"), escaped).otherwise(c)


def records(pages: DataFrame, id_col: str, url_col: str, page_col: str, date: Column, least_bytes: int) -> DataFrame:
    """``record``: the text of every row's WARC record without the blank line that ends it."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), safe_url(F.col(url_col).cast("string")).alias("url"),
        F.coalesce(F.col(page_col).cast("string"), F.lit("")).alias("page"),
        F.date_format(F.coalesce(date, F.timestamp_seconds(F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"))
    rows = rows.withColumns({"bytes": F.octet_length("page").cast("long"), "digest": base32_sha1(F.col("page").cast("binary")),
                             "hash": F.xxhash64("page")})
    key = ["digest", "hash", "bytes"]
    firsts = cut_table(rows.where(F.col("bytes") >= least_bytes).groupBy(*key)
                       .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    rows = rows.join(firsts, key, "left").withColumn("revisit", F.coalesce(~F.col("id").eqNullSafe(F.col("first")), F.lit(False))
                                                     & F.col("first").isNotNull())
    line = lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in c], F.lit("\r\n"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(line("HTTP/1.1 200 OK"), line("Content-Type: text/html; charset=utf-8"),
                    line("Content-Length: ", F.col("bytes").cast("string")), F.lit("\r\n"))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, "page"))
    refers = F.when(F.col("revisit"), F.concat(line("WARC-Refers-To: ", name("first")),
                                               line("WARC-Profile: " + REVISIT_PROFILE))).otherwise("")
    head = F.concat(line("WARC/1.1"), line("WARC-Type: ", F.when(F.col("revisit"), "revisit").otherwise("response")),
                    line("WARC-Record-ID: ", name("id")), line("WARC-Target-URI: ", F.col("url")),
                    line("WARC-Date: ", F.col("date")), line("WARC-Payload-Digest: sha1:", F.col("digest")), refers,
                    line("Content-Type: application/http; msgtype=response"))
    return rows.select(F.concat(head, line("Content-Length: ", F.octet_length(block).cast("string")), F.lit("\r\n"), block)
                       .alias("record"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", page_col: str = "html",
                   date: Column | None = None, least_bytes: int = 0, records_per_file: int = 50_000) -> None:
    """WARC files of all rows in the folder ``path``; a file holds ``records_per_file`` records at most."""
    rows = records(pages, id_col, url_col, page_col, F.lit(None).cast("timestamp") if date is None else date, least_bytes)
    rows.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


# --- reading

class Records:
    """Cuts a stream of bytes into WARC records by their ``Content-Length``."""

    def __init__(self):
        self.held, self.size, self.at = [], 0, 0
        self.wanted = 0                     # bytes without which no record can end

    def feed(self, data: bytes):
        """Yields ``(offset, length, head, block)`` of the records that end in ``data``."""
        self.held.append(data)
        self.size += len(data)
        while self.size and self.size >= self.wanted:
            raw = self.held[0] if len(self.held) == 1 else b"".join(self.held)
            self.held = [raw]
            end = raw.find(b"\r\n\r\n")
            if end < 0:
                self.wanted = self.size + 1
                return
            head = raw[:end].decode()
            block = int(re.search(r"(?im)^content-length:\s*(\d+)", head)[1])
            total = end + 4 + block + 4
            if self.size < total:
                self.wanted = total
                return
            yield self.at, total, head, raw[end + 4:total - 4]
            if raw[total - 4:total] != b"\r\n\r\n":
                raise ValueError(f"no blank line after the record at {self.at}")
            self.at += total
            self.held, self.size, self.wanted = [raw[total:]], self.size - total, 0


def url_key(url: str) -> str:
    """Sortable key: host labels in reverse order, lower case and without ``www``, then path and query."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url, re.IGNORECASE)
    if not m:
        return url.partition("#")[0].lower()
    host = m[1].rpartition("@")[2].lower()
    host = re.sub(r"^www\d*\.", "", re.sub(r":(80|443)?$", "", host))
    return ",".join(reversed(host.split("."))) + ")" + (m[2] or "/").lower()


def entry(file: str, offset: int, length: int, head: str, block: bytes) -> tuple:
    """Index entry of one record; a payload that does not have its digest raises."""
    said = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.split("\r\n")[1:])}
    page = lambda x: int(x[len("<urn:page:"):-1]) if x and x != "<urn:page:>" else None       # noqa: E731
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = said["warc-payload-digest"].removeprefix("sha1:")
    if said["warc-type"] == "response" and (
            len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of the record at {offset} of {file} does not have its digest")
    url = said["warc-target-uri"]
    return (url_key(url), re.sub(r"\D", "", said["warc-date"]), page(said["warc-record-id"]), said["warc-type"],
            page(said.get("warc-refers-to")), size, digest, url, file, offset, length)


def order(e: tuple) -> tuple:
    """URL key, timestamp, id with NULL first, then the record's place."""
    return e[0], e[1], e[2] is not None, e[2] or 0, e[8], e[9]


def read_runs(spark: SparkSession, path: str, run_entries: int = 50_000) -> DataFrame:
    """Index entries of all archives in ``path`` in locally sorted runs: the entry, its ``run`` and ``place`` in it."""
    lines = spark.read.option("lineSep", END).text(path).select("value", F.col("_metadata.file_name").alias("file"))
    arrow = to_arrow_schema(StructType.fromDDL(RUN))

    def run(batches):
        name, stream, held, number = None, Records(), [], TaskContext.get().partitionId() << 32

        def sorted_run():
            nonlocal held, number
            held.sort(key=order)
            yield from _batches([(*e, number, at) for at, e in enumerate(held)], arrow)
            held, number = [], number + 1

        def ended():
            if stream.size:                 # the reader takes the last line's separator off
                held.extend(entry(name, *found) for found in stream.feed(END.encode()))
            if stream.size:
                raise ValueError(f"{name} ends within a record")

        for b in batches:
            for file, text in zip(b.column(1).to_pylist(), b.column(0).cast(pa.large_binary())):
                data = text.as_py()
                if file == name:
                    data = END.encode() + data
                else:
                    ended()
                    name, stream = file, Records()
                held.extend(entry(name, *found) for found in stream.feed(data))
                if len(held) >= run_entries:
                    yield from sorted_run()
        ended()
        if held:
            yield from sorted_run()

    return lines.mapInArrow(run, RUN)


class LoserTree:
    """Merges sorted lists: an inner node keeps the loser of its match, the winner plays on."""

    def __init__(self, lists: list[list], key):
        self.lists, self.key, self.n = lists, key, len(lists)
        self.at = [0] * self.n
        self.head = [key(x[0]) if x else None for x in lists]
        self.loser = [0] * self.n
        self.winner = self._build(1) if self.n else None

    def _beats(self, i: int, j: int) -> bool:
        a, b = self.head[i], self.head[j]
        return b is None or (a is not None and (a, i) <= (b, j))

    def _build(self, node: int) -> int:
        """Winner of the matches below ``node``; leaves are nodes n to 2 n - 1."""
        if node >= self.n:
            return node - self.n
        left, right = self._build(2 * node), self._build(2 * node + 1)
        won, self.loser[node] = (left, right) if self._beats(left, right) else (right, left)
        return won

    def __iter__(self):
        if not self.n:
            return
        while self.head[self.winner] is not None:
            i = self.winner
            yield self.lists[i][self.at[i]]
            self.at[i] += 1
            self.head[i] = self.key(self.lists[i][self.at[i]]) if self.at[i] < len(self.lists[i]) else None
            node = (i + self.n) // 2
            while node:
                if self._beats(self.loser[node], i):
                    i, self.loser[node] = self.loser[node], i
                node //= 2
            self.winner = i


def merge_runs(runs: DataFrame, range_entries: int = 100_000) -> DataFrame:
    """All entries in global order: ``range`` and ``position`` in it follow URL key, timestamp and id."""
    written = cut_table(runs)
    ranges = max(1, -(-written.count() // range_entries))
    # the id and the place divide a URL whose captures share a timestamp
    dealt = written.repartitionByRange(ranges, "url_key", "timestamp", "page_id", "file", "offset") \
        .sortWithinPartitions("run", "place")
    schema = StructType.fromDDL(ENTRY + ", `range` int, position long")
    arrow = to_arrow_schema(schema)
    n = len(ENTRY_COLUMNS)

    def merge(batches):
        parts: dict[int, list] = {}
        for b in batches:
            for e in zip(*[c.to_pylist() for c in b.columns]):
                parts.setdefault(e[n], []).append(e[:n])
        number = TaskContext.get().partitionId()
        yield from _batches([(*e, number, at) for at, e in enumerate(LoserTree(list(parts.values()), order))], arrow)

    return dealt.mapInArrow(merge, schema)


def _batches(rows: list[tuple], arrow: pa.Schema):
    for at in range(0, len(rows), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + 10_000]), arrow.types)],
                                         schema=arrow)


def capture_histories(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", page_col: str = "html",
                      date: Column | None = None, least_bytes: int = 0, records_per_file: int = 50_000,
                      run_entries: int = 50_000, range_entries: int = 100_000) -> DataFrame:
    """Archives of all rows, written to the shared folder, read back and indexed: the merged index."""
    spark = pages.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"warc-{uuid.uuid4().hex}")
    write_archives(pages, path, id_col, url_col, page_col, date, least_bytes, records_per_file)
    return merge_runs(read_runs(spark, path, run_entries), range_entries)
