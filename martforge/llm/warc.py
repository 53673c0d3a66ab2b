"""Web archives: writing, reading and merging their indexes.

Method
------
* ``write_archives``: captures with equal payloads (SHA-1 and length) of at least
  ``REVISIT_BYTES`` are folded by a grouped maximum joined back; the greatest id
  is the response, the others are written as revisits that refer to it.
  Records are rendered in SQL and written by Spark's text writer, whose line
  separator is the record separator of the format, as gzipped archives.
* ``read_archives``: an archive is parsed record by record by its lengths, from
  a decompressing stream; payload digests are computed anew.
* ``merged_index``: each archive's captures, sorted by URL key, time and id, are
  a *run*.  Runs are dealt into ranges of that order (a host or URL with very many
  captures spans several ranges), and in each range the k runs are merged by a
  *loser tree*: the result is globally ordered by range, then by place.

Defined results: a null page body is an empty payload; records whose id repeats
with equal payloads are all of the kind their id has; a null URL has the empty
key; line ends in a URL are percent-encoded; without a time column a capture's
time is derived from its id.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martforge.llm.scratch import save
from martforge.session import shared_dir

REVISIT_BYTES = 1000          # smaller payloads are always written in full
RECORDS_PER_FILE = 4000
FILE_BYTES = 128 << 20        # payloads of an archive at most (a larger one goes alone)
RANGE_ROWS = 50_000           # captures merged in one place
EPOCH = 1_704_067_200         # time of id 0 where captures have no time
CRLF = "\r\n"


def _header(*pairs: tuple[str, Column | str]) -> Column:
    parts: list[Column] = [F.lit("WARC/1.1" + CRLF)]
    for name, value in pairs:
        value = F.lit(value) if isinstance(value, str) else value
        # a header without a value is left out
        parts.append(F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit("")))
    return F.concat(*parts)


def write_archives(spark: SparkSession, pages: DataFrame, path: str, id_col: str = "page_id",
                   url_col: str = "url", body_col: str = "html", time_col: str | None = None,
                   least: int = REVISIT_BYTES, per_file: int = RECORDS_PER_FILE) -> None:
    """Write one record per row below ``path``."""
    body = F.coalesce(F.col(body_col), F.lit(""))
    when = (F.col(time_col).cast("timestamp") if time_col
            else F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.col(id_col), F.lit(0)).cast("long")))
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), body.alias("body"),
                       when.alias("time")).withColumn("bytes", F.octet_length("body").cast("long")) \
        .withColumn("digest", F.sha1("body"))
    light = pages.select(F.col(id_col).cast("long").alias("id"), body.alias("body"))
    groups = (light.select("id", F.octet_length("body").cast("long").alias("b"), F.sha1("body").alias("d"))
              .where(F.col("b") >= least).groupBy("d", "b")
              .agg(F.max("id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    src = (src.join(groups, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")), "left")
           .withColumn("revisit", F.coalesce(F.col("original") != F.col("id"), F.col("original").isNotNull())))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("body")))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = _header(
        ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID", name(F.col("id"))),
        ("WARC-Date", F.date_format(F.col("time"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(F.col("revisit"), name(F.col("original")))),
        ("WARC-Profile", F.when(F.col("revisit"), F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", F.octet_length("block").cast("string")))
    record = F.concat(head, F.lit(CRLF), F.col("block"))
    written = src.withColumn("block", block).select("bytes", record.alias("value"))
    # an archive is read as a whole, so it is bounded in bytes: larger payloads, fewer to a file
    most = pages.agg(F.max(F.octet_length(body)).alias("m")).first()["m"] or 0
    low, high = -1, FILE_BYTES // per_file
    while True:
        part = written if low < 0 and most <= high else written.where((F.col("bytes") > low) & (F.col("bytes") <= high))
        (part.select("value").write.mode("append").option("lineSep", CRLF + CRLF).option("compression", "gzip")
         .option("maxRecordsPerFile", max(1, min(per_file, FILE_BYTES // high))).text(path))
        if most <= high:
            break
        low, high = high, max(high * 16, 1 << 20)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then path and query."""
    try:
        u = urlsplit(url.strip())
        host = ",".join(reversed((u.hostname or "").split(".")))
    except ValueError:
        return url
    return f"{host}){u.path or '/'}" + (f"?{u.query}" if u.query else "")


def parse_records(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers in lower case, block) of each record of an open archive."""
    offset = 0
    while True:
        line = stream.readline()
        if not line:
            return
        at, offset = offset, offset + len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at offset {at}")
        head: dict[str, str] = {}
        while True:
            line = stream.readline()
            offset += len(line)
            if line in (b"\r\n", b""):
                break
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            head[name.lower()] = value
        n = int(head["content-length"])
        block = stream.read(n)
        if len(block) != n or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at offset {at} is cut short")
        offset += n + 4
        yield at, head, block


INDEX = ("url_key string, time string, id long, run string, offset long, record_type string, url string, "
         "refers_to long, payload_digest string, payload_bytes long, seq long")


def _number(name: str | None) -> int | None:
    inner = (name or "")[len("<urn:x-page:"):-1]
    return int(inner) if inner else None


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content")):
            stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())))
            rows = []
            for at, head, block in parse_records(stream):
                kind = head["warc-type"]
                payload = block.partition(b"\r\n\r\n")[2]
                uri = head.get("warc-target-uri")
                full = kind != "revisit"
                rows.append((url_key(uri) if uri else "", head["warc-date"], _number(head["warc-record-id"]),
                             path, at, kind, uri, _number(head.get("warc-refers-to")),
                             hashlib.sha1(payload).hexdigest() if full else head["warc-payload-digest"][5:],
                             len(payload) if full else None))
            rows.sort(key=_order)        # the run
            rows = [(*r, seq) for seq, r in enumerate(rows)]
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r)) for r in rows], schema=_SCHEMA)


_NAMES = [c.split()[0] for c in INDEX.split(", ")]
_SCHEMA = pa.schema([(c.split()[0], pa.int64() if c.split()[1] == "long" else pa.string())
                     for c in INDEX.split(", ")])


def _order(row) -> tuple:
    """URL key, time, id (null first), then the place of the record."""
    return (row[0], row[1], row[2] is not None, row[2] or 0, row[3], row[4])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below ``path``, each archive a sorted run."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_index_rows, INDEX)


class LoserTree:
    """k-way merge of sorted lists: each inner node keeps the loser of its match,
    so the next least row costs one match per level."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.k = max(1, len(runs))
        self.heads = [key(r[0]) if r else None for r in runs]
        self.tree = [-1] * self.k          # losers; tree[0] is the winner
        for i in range(len(runs)):
            self._play(i, build=True)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and x is not None
        return x < y or (x == y and a < b)

    def _play(self, i: int, build: bool = False) -> None:
        node = (i + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0 and build:        # first to arrive waits for its match
                self.tree[node] = i
                return
            if self._less(other, i):
                self.tree[node], i = i, other
            node //= 2
        self.tree[0] = i

    def __iter__(self):
        if not self.runs:
            return
        while True:
            i = self.tree[0]
            if self.heads[i] is None:
                return
            run = self.runs[i]
            yield run[self.at[i]]
            self.at[i] += 1
            self.heads[i] = self.key(run[self.at[i]]) if self.at[i] < len(run) else None
            self._play(i)


def in_order(blocks: list[list]) -> list:
    """A run from the blocks it came in: stretches of its rows in order, that follow each
    other by the number of their first row."""
    return [row for block in sorted(blocks, key=lambda b: b[0][-1]) for row in block]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[list]] = {}
    for b in batches:
        for row in zip(*[b.column(n).to_pylist() for n in _NAMES]):
            blocks = runs.setdefault(row[3], [])
            if blocks and blocks[-1][-1][-1] < row[-1]:
                blocks[-1].append(row)
            else:
                blocks.append([row])
    out = []
    for row in LoserTree([in_order(runs[r]) for r in sorted(runs)], _order):
        out.append(row)
        if len(out) == 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r)) for r in out], schema=_SCHEMA)
            out = []
    yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r)) for r in out], schema=_SCHEMA)


def merged_index(spark: SparkSession, captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Capture histories in global order: partitions are ascending ranges, rows
    ascend inside; ``place`` ascends over all."""
    runs = save(spark, captures, "runs")
    ranges = max(1, -(-runs.count() // range_rows))
    ranged = runs.repartitionByRange(ranges, "url_key", "time", "id", "run", "offset")
    return save(spark, ranged.mapInArrow(_merge, INDEX)
                .withColumn("place", F.monotonically_increasing_id()), "histories")


def archive_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back and merge their indexes: one row
    per page, with the full payload's length (of the response, for a revisit)."""
    path = shared_dir(spark, "llm-archives")
    write_archives(spark, pages, path)
    merged = merged_index(spark, read_archives(spark, path))
    # repeated ids may stand for several payloads: a revisit's is that of its digest
    full = (merged.where("record_type = 'response'").groupBy(F.col("id").alias("_o"), F.col("payload_digest").alias("_d"))
            .agg(F.max("payload_bytes").alias("_n")))
    return (merged.join(full, (F.col("refers_to") == F.col("_o")) & (F.col("payload_digest") == F.col("_d")), "left")
            .select(F.col("id").alias("page_id"), F.coalesce("payload_bytes", "_n").alias("payload_bytes"),
                    "payload_digest", "record_type", "refers_to"))
