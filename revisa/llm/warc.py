"""WARC archives of captures and an external merge of their indexes.

Pages are written as WARC 1.1 records: a payload is stored once, in the response record of
its largest page_id, and other captures of it are revisit records that refer to it.
Archives are gzip files of bounded size in the shared folder, written by Spark's text
writer (a record is a row, the blank lines that end it are the line separator).

Reading back parses each archive into a locally sorted run of captures.  The runs are cut
into ranges of (URL key, timestamp, page_id) by Spark's range partitioner, so captures of
one hot URL spread over ranges, and within a range the pieces of all runs are merged by a
loser tree; partitions in order are the globally ordered capture histories.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisa.llm.common import shared_folder, written

CRLF = b"\r\n"
#: Payload bytes of an archive file, and captures merged in one range.
FILE_BYTES, RANGE_ROWS = 16 << 20, 100_000
#: Captures carry no time of their own: page n was captured n seconds after this.
EPOCH = datetime(2000, 1, 1, tzinfo=UTC)


def date_of(page_id: int | None) -> str:
    return (EPOCH + timedelta(seconds=abs(page_id or 0) % 10**9)).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels in reverse, then path and query; no scheme, port or fragment."""
    if not url:
        return "-"
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("#", 1)[0]
    host, slash, path = rest.partition("/")
    host = host.rsplit("@", 1)[-1].split(":", 1)[0].lower()
    return ",".join(reversed(host.split("."))) + ")" + slash + path


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, response_id: int | None, is_response: bool) -> bytes:
    """One WARC record without the two line ends that close it."""
    safe = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "").encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if is_response else http
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if is_response else b"revisit"),
        b"WARC-Record-ID: <urn:page:%s>" % str(page_id).encode(),
        b"WARC-Date: " + date_of(page_id).encode(),
        b"WARC-Target-URI: " + safe,
        b"WARC-Payload-Digest: sha1:" + base32(digest).encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if not is_response:
        head.insert(2, b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(3, b"WARC-Refers-To: <urn:page:%s>" % str(response_id).encode())
    return CRLF.join(head) + CRLF + CRLF + block


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write every row of pages (page_id, url, html) as a record below ``path``."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    size = F.octet_length("payload")
    stored = written(rows.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.sum(size).alias("b"), F.count(F.lit(1)).alias("n")), "warc-payloads")
    sums = stored.agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    per_file = max(1, int(FILE_BYTES * max(sums[1], 1) // max(sums[0], 1)))
    both = rows.join(stored.select(F.col("digest").alias("_d"), "response_id"), F.col("digest") == F.col("_d"))
    both = both.withColumn("own", (size < min_bytes) | F.col("page_id").eqNullSafe(F.col("response_id")))
    both = both.select("page_id", "url", "payload", F.unhex("digest").alias("digest"), "response_id", "own")

    def run(batches):
        for batch in batches:
            out = [record(*row) for row in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], names=["record"])

    both.mapInArrow(run, "record string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


class _Stream:
    """Bytes of a gzip file in order, unpacked a little at a time."""

    def __init__(self, packed: bytes):
        self.packed, self.at, self.ready = memoryview(packed), 0, b""
        self.unpack = zlib.decompressobj(31)

    def more(self) -> bool:
        if self.at >= len(self.packed):
            return False
        chunk = self.packed[self.at : self.at + (1 << 16)]
        self.at += len(chunk)
        self.ready += self.unpack.decompress(chunk)
        return True

    def until(self, mark: bytes) -> bytes | None:
        looked = 0
        while (found := self.ready.find(mark, looked)) < 0:
            looked = max(0, len(self.ready) - len(mark))
            if not self.more():
                return None
        out, self.ready = self.ready[:found], self.ready[found + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.ready], len(self.ready)
        self.ready = b""
        while have < n and self.more():
            parts.append(self.ready)
            have += len(self.ready)
            self.ready = b""
        whole = b"".join(parts)
        self.ready = whole[n:]
        return whole[:n]


def _urn(value: str) -> int | None:
    text = value.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "None" else int(text)


def read_records(packed: bytes):
    """(page_id, url, date, type, refers_to, digest header, payload or None) of every record of an archive."""
    stream = _Stream(packed)
    while (head := stream.until(CRLF + CRLF)) is not None:
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
        block = stream.take(int(fields["Content-Length"]))
        if stream.take(4) != CRLF + CRLF:
            raise ValueError("a record does not end where its length says")
        kind = fields["WARC-Type"]
        payload = block.split(CRLF + CRLF, 1)[1] if kind == "response" else None
        refers = _urn(fields["WARC-Refers-To"]) if kind == "revisit" else None
        yield _urn(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Date"], kind, refers, fields["WARC-Payload-Digest"].removeprefix("sha1:"), payload


RUN = "run string, url_key string, ts string, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"
_KINDS = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_NAMES = [c.split()[0] for c in RUN.split(", ")]


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """One locally sorted run of captures per archive file below ``path``, read through Spark's binary reader."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for page, url, date, kind, refers, said, payload in read_records(packed.as_py()):
                    digest = said if payload is None else base32(hashlib.sha1(payload).digest())
                    if digest != said:
                        raise ValueError(f"payload of page {page} does not have its digest")
                    rows.append((name, url_key(url), date, page, url, kind, refers, digest, None if payload is None else len(payload)))
                rows.sort(key=order_key)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES) if rows else pa.RecordBatch.from_pylist([], schema=pa.schema(zip(_NAMES, _KINDS)))

    return files.mapInArrow(run, RUN)


def order_key(row: tuple) -> tuple:
    """URL key, timestamp, page (null first): the order of capture histories."""
    return row[1].encode(), row[2], row[3] is not None, row[3] or 0


class LoserTree:
    """Merge of k sorted lists: a tree of losers, one comparison per level for each row taken."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key = runs, key
        self.k = max(1, len(runs))
        self.at = [0] * self.k
        self.heads = [key(r[0]) if r else None for r in runs] or [None]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._enter(leaf)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head goes before run b's: empty runs last, ties by run number."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _enter(self, leaf: int) -> None:
        """First filling: climb until a free place, leaving the loser of every match."""
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = winner
                return
            if self._before(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.heads[self.losers[0]] is not None:
            leaf = winner = self.losers[0]
            run = self.runs[leaf]
            yield run[self.at[leaf]]
            self.at[leaf] += 1
            self.heads[leaf] = self.key(run[self.at[leaf]]) if self.at[leaf] < len(run) else None
            node = (leaf + self.k) // 2
            while node > 0:
                if self._before(self.losers[node], winner):
                    self.losers[node], winner = winner, self.losers[node]
                node //= 2
            self.losers[0] = winner


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of all runs with range_no and range_pos, their place in the global order."""
    total = runs.count()
    ranges = int(max(1, -(-total // range_rows), int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    cut = runs.repartitionByRange(ranges, "url_key", "ts", "page_id")
    # each run's piece of the range, in the run's own order
    cut = cut.sortWithinPartitions("run", "url_key", "ts", "page_id")

    def run(batches):
        parts: dict[str, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                parts.setdefault(row[0], []).append(row)
        merged = list(LoserTree(list(parts.values()), order_key))
        if not merged:
            return
        number = TaskContext.get().partitionId()
        for at in range(0, len(merged), 10_000):
            some = merged[at : at + 10_000]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*some), _KINDS)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([number] * len(some), pa.int32()), pa.array(range(at, at + len(some)), pa.int64())], names=[*_NAMES, "range_no", "range_pos"])

    return cut.mapInArrow(run, f"{RUN}, range_no int, range_pos long")


def captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages as archives, read them back and merge their indexes.

    Per page row: page_id, url_key, ts, url, record_type, refers_to, payload_digest and
    payload_bytes (of the full payload, a revisit's from the response it refers to),
    range_no, range_pos.  A null html is an empty payload, a null url an empty target with
    key ``-``.  Of equal payloads every row with the largest page_id is a response; a null
    page_id counts as smaller than any other.  An empty table gives no rows.
    """
    path = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes)
    runs = written(capture_runs(pages.sparkSession, path), "warc-runs")
    full = written(runs.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("_d")).agg(F.max("payload_bytes").alias("full_bytes")), "warc-sizes")
    merged = merge_runs(runs)
    out = merged.join(full, F.col("payload_digest") == F.col("_d"), "left")
    return out.select("page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "url", "url_key", "ts", "range_no", "range_pos")
