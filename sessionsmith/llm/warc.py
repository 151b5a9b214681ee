"""Web archive records, and a globally ordered capture index by external merge.

Archives are written and read by Spark's own text and binary-file sources, so they can lie in any store that Spark reaches.
A record ends in two line ends, as the format asks; reading goes by each record's Content-Length, never by separators.

Each archive file gives one run: its captures, sorted by URL key, time and page. Runs are cut at common range bounds, so
that each range is a task's share however many captures one URL has, and the pieces of all runs in a range are merged by a
loser tree. Ranges follow each other in order, so the result is sorted globally.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from typing import Any
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_batches, shared_path, stored

#: Payloads shorter than this are always written in full.
LEAST_REVISIT = 100
#: Uncompressed bytes of one archive file, about: a task holds one file at a time.
FILE_BYTES = 16 << 20
#: Captures in one range of the merge.
RANGE_ROWS = 20_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
CAPTURE = "url_key string, captured_at string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, offset bigint, length bigint, run string"


def revisits(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, digest, refers_to) of the records that revisit another: the same payload of at least ``LEAST_REVISIT`` bytes has a smaller key.

    Digests are counted with partial sums in each task; a payload that a third of all pages share is one row per task.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    digests = stored(pages.select(F.col(key).alias("key"), F.sha2(body, 256).alias("digest")).where(F.octet_length(body) >= LEAST_REVISIT))
    groups = stored(digests.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n"))
    return digests.join(groups, "digest").where("key is null or key > first").select("key", "digest", F.col("first").alias("refers_to")).distinct()


def record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", captured_at: Column | None = None) -> None:
    """Write one record per row below ``path``, compressed, in files of about ``FILE_BYTES``.

    A null payload is empty, a null url has no target line, line ends in a url are percent-encoded. ``captured_at`` is a
    timestamp; by default it is a second per key from a fixed start, for tables without capture times.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    known = revisits(pages, key, payload).withColumnsRenamed({"key": "_key", "digest": "_digest"})
    when = F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce(F.col(key), F.lit(0))) if captured_at is None else captured_at
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("body"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"), F.sha2(body, 256).alias("digest"))
    rows = rows.join(known, rows["key"].eqNullSafe(known["_key"]) & (rows["digest"] == known["_digest"]), "left")
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.octet_length("body").cast("string"), F.lit(END * 2))
    block = F.concat(http, F.when(again, "").otherwise(F.col("body")))
    target = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(END)), F.lit(""))
    refers = F.when(again, F.concat(F.lit(f"WARC-Profile: {PROFILE}{END}WARC-Refers-To: "), record_id(F.col("refers_to")), F.lit(END))).otherwise("")
    head = F.concat(F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit(f"{END}WARC-Record-ID: "), record_id(F.col("key")), F.lit(END), target, F.lit("WARC-Date: "), F.col("at"), F.lit(f"{END}WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit(END), refers, F.lit(f"Content-Type: application/http; msgtype=response{END}Content-Length: "), F.octet_length(block).cast("string"), F.lit(END * 2))
    mean = pages.agg(F.avg(F.octet_length(body))).first()[0] or 0
    records = rows.select(F.concat(head, block).alias("value"))
    records.write.option("lineSep", END * 2).option("compression", "gzip").option("maxRecordsPerFile", max(1, int(FILE_BYTES / (mean + 500)))).text(path)


def url_key(url: str | None) -> str:
    """The host's labels from the right, then path and query; without scheme, www, user, default port and fragment. The same address in another spelling has the same key."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    port = f":{port}" if port and port not in (80, 443) else ""
    query = "&".join(sorted(filter(None, parts.query.split("&"))))
    return f"{','.join(reversed(host.split('.')))}{port}){(parts.path.rstrip('/') or '/').lower()}{'?' + query.lower() if query else ''}"


def page_of(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def records(stream: io.BufferedIOBase) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header, block) of each record, by the lengths that headers give."""
    at = 0
    while line := stream.readline():
        if line.rstrip() != b"WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        size, header = len(line), {}
        while (line := stream.readline()).rstrip(b"\r\n"):
            size += len(line)
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            header[name.lower()] = value
        block = stream.read(int(header["content-length"]))
        size += len(line) + len(block)
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut off")
        yield at, size, header, block
        at += size + 4


def captures(stream: io.BufferedIOBase, run: str) -> list[tuple]:
    """The captures of one archive, sorted: a run."""
    found = []
    for offset, length, header, block in records(stream):
        head, _, payload = block.partition(b"\r\n\r\n")
        again = header["warc-type"] == "revisit"
        digest = header["warc-payload-digest"].removeprefix("sha256:") if again else hashlib.sha256(payload).hexdigest()
        size = int(re.search(rb"Content-Length: (\d+)", head)[1]) if again else len(payload)
        found.append((url_key(header.get("warc-target-uri")), header["warc-date"], page_of(header["warc-record-id"]), size, digest, header["warc-type"], page_of(header["warc-refers-to"]) if again else None, offset, length, run))
    return sorted(found, key=order_of)


def order_of(capture: tuple) -> tuple:
    """URL key, time, page (none last), and the rest so that ties have one order."""
    return capture[0], capture[1], capture[2] is None, capture[2] or 0, capture[4], capture[9], capture[7]


def rows_of(captures: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*captures, strict=True)) or [()] * len(kinds)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in CAPTURE.split(", ")])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Every archive file below ``path`` as a sorted run of captures. Digests and sizes of full records come from their payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, content = batch.column(0)[k].as_py(), batch.column(1)[k].as_buffer()
                if content is not None and content.size:
                    with gzip.GzipFile(fileobj=pa.BufferReader(content)) as zipped:
                        yield rows_of(captures(io.BufferedReader(zipped, 1 << 20), name.rpartition("/")[2]))

    return in_batches(files, run, CAPTURE)


class LoserTree:
    """Merges sorted sequences: inner nodes hold the loser of their match, so the next smallest item takes one match per level."""

    def __init__(self, runs: list[list[tuple[Any, Any]]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.losers = [-1] * max(1, len(runs))
        self.winner = -1
        for k in range(len(runs)):
            self._enter(k)

    def _key(self, k: int):
        return self.runs[k][self.at[k]][0] if self.at[k] < len(self.runs[k]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._key(a), self._key(b)
        return y is None or x is not None and (x, a) < (y, b)

    def _enter(self, k: int) -> None:
        """Run k plays its way up from its leaf; while the tree is built, it waits at the first empty node."""
        node = (k + len(self.runs)) // 2
        while node:
            if self.losers[node] < 0:
                self.losers[node] = k
                return
            if self._beats(self.losers[node], k):
                self.losers[node], k = k, self.losers[node]
            node //= 2
        self.winner = k

    def __iter__(self) -> Iterator[Any]:
        while self.winner >= 0 and self._key(self.winner) is not None:
            k = self.winner
            yield self.runs[k][self.at[k]][1]
            self.at[k] += 1
            node = (k + len(self.runs)) // 2
            while node:
                if self._beats(self.losers[node], k):
                    self.losers[node], k = k, self.losers[node]
                node //= 2
            self.winner = k


def merged(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures of ``runs`` (a stored table) in one global order: partition by partition, and inside each."""
    ranges = max(1, -(-runs.count() // range_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[list]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, own = order_of(row), pieces.setdefault(row[9], [])
                if not own or own[-1][-1][0] > key:  # a run that reached this task in parts
                    own.append([])
                own[-1].append((key, row))
        out = []
        for row in LoserTree([p for own in pieces.values() for p in own]):
            out.append(row)
            if len(out) == 5_000:
                yield rows_of(out)
                out = []
        if out:
            yield rows_of(out)

    return in_batches(runs.repartitionByRange(int(ranges), "url_key", "captured_at", F.col("page_id").asc_nulls_last(), "payload_digest", "run", "offset"), run, CAPTURE)


def archived(pages: DataFrame, path: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html", captured_at: Column | None = None) -> DataFrame:
    """Write ``pages`` to archives, read them back and merge their captures: the capture index, globally ordered.

    Payloads are UTF-8; a null one is empty. Rows that repeat a key and its payload are all responses if the key is the
    smallest with that payload, else all revisits. A null key never is the one that others refer to. Empty texts and an
    empty table work; other columns are not read.
    """
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path, key, url, payload, captured_at)
    return merged(stored(read_runs(spark, path)))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest,
  CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id > first THEN first END AS refers_to
FROM d JOIN f ON d.payload_digest = f.payload_digest
"""
