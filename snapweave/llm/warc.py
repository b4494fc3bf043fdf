"""WARC archives written and read as tables of chunks.

A payload is never held or copied whole by this module: it leaves as rows of (record,
chunk number) with at most ``CHUNK_BYTES`` each, cut between characters, and it comes
back the same way, each row carrying the SHA-1 and the byte count of the payload up
to and with that chunk. The digests of the last chunks are the payload digests.

In the archive the chunks are those of HTTP's chunked transfer coding, inside WARC/1.1
``response`` records. All of its lines end in CR LF, so an archive is written with
Spark's text writer (line separator LF) and read with its text reader; files are
gzip-compressed, hence read by one task each, in order, whatever their records hold.

Of records with the same payload of at least ``REVISIT_BYTES`` bytes, the one with the
largest id is the response; the others are ``revisit`` records without payload that
name it. Hot payloads are spread over ``SALTS`` keys in the join that tells.

Defined results: a null payload is empty; a null url leaves the target URI out;
smaller payloads are always responses; rows that share the largest id are all
responses; a null id counts as smaller than any other, and where all ids of a
payload are null, all its rows are responses. Control characters in urls are
percent-encoded.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 16
REVISIT_BYTES = 1000
SALTS = 16
BATCH_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"  # of a table without capture times
HTTP = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n", "Transfer-Encoding: chunked\r\n", "\r\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunk_ends(data: memoryview, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """(start, end) of chunks of at most ``size`` bytes that end between UTF-8 characters."""
    a = 0
    while a < len(data):
        b = min(a + size, len(data))
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        yield a, b
        a = b


def record_id(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page}/{digest}')}>"


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _head(page: str | None, url: str | None, digest: str, size: int, refers: str | None, length: int) -> str:
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers is not None else 'response'}",
             f"WARC-Record-ID: {record_id(page, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if page is not None:
        lines.append(f"X-Record-Key: {page}")
    lines.append(f"X-Payload-Length: {size}")
    if refers is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers, digest)}",
                  f"X-Refers-To-Key: {refers}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines) + "\r\n\r\n"


def record_lines(page: str | None, url: str | None, payload: memoryview, digest: str,
                 refers: str | None) -> Iterator[str]:
    """A record as pieces that each end in CR; the writer puts LF after each."""
    if refers is not None:
        http = HTTP[0] + HTTP[2]
        yield _head(page, url, digest, len(payload), refers, len(http)) + http + "\r\n\r"
        return
    http = "".join(HTTP)
    ends = list(chunk_ends(payload))
    length = len(http) + sum(len(f"{b - a:x}") + 4 + b - a for a, b in ends) + 5
    yield (_head(page, url, digest, len(payload), None, length) + http)[:-1]
    for a, b in ends:
        yield f"{b - a:x}\r\n{str(payload[a:b], 'utf-8')}\r"
    yield "0\r\n\r\n\r\n\r"


def planned(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
            revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Records to write: key, url, payload, digest, refers (key of the response, or null)."""
    p = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
                     F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    p = p.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("bigint"))
    same = (p.filter(F.col("size") >= revisit_bytes).groupBy("digest")
            .agg(F.max("key").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
            .select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = p.withColumn("salt", F.pmod(F.xxhash64("key", "url"), F.lit(SALTS)).cast("int"))
    return salted.join(same, ["digest", "salt"], "left").select(
        "key", "url", "payload", "digest",
        F.when(F.col("key").isNull() | (F.col("key") != F.col("first")), F.col("first")).alias("refers"))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
          revisit_bytes: int = REVISIT_BYTES) -> None:
    """Archives under ``path``, one file per task."""
    rows = planned(pages, key, url, payload, revisit_bytes).select(
        F.col("key").cast("string"), "url", F.col("payload").cast("binary"), "digest", F.col("refers").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            keys, urls, digests, refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for k, u, value, d, r in zip(keys, urls, batch.column(2), digests, refers):
                for line in record_lines(k, u, memoryview(value.as_buffer()), d, r):
                    out.append(line)
                    size += len(line)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                        out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    (rows.mapInArrow(run, "value string").write.option("lineSep", "\n").option("compression", "gzip").text(path))


class _Parser:
    """Feeds on the lines of one archive file; gives chunk rows."""

    def __init__(self) -> None:
        self.state, self.fields = "between", {}
        self.sha, self.size, self.number, self.left, self.data = hashlib.sha1(), 0, 0, 0, []

    def row(self, data: bytes | None, last: bool) -> tuple:
        f = self.fields
        sha = self.sha.hexdigest() if f.get("warc-type") != "revisit" else \
            f["warc-payload-digest"].removeprefix("sha1:")
        size = self.size if f.get("warc-type") != "revisit" else int(f["x-payload-length"])
        return (f["warc-record-id"], self.number, data, size, sha, last, f["warc-type"], f.get("x-record-key"),
                f.get("warc-target-uri"), f.get("x-refers-to-key"))

    def line(self, line: bytes) -> Iterator[tuple]:
        """``line`` is without its LF."""
        if self.state == "chunk":
            self.left -= len(line) + 1
            if self.left > 0:
                self.data.append(line + b"\n")
            elif self.left == 0:
                self.data.append(line[:-1])
                data = b"".join(self.data)
                self.sha.update(data)
                self.size += len(data)
                yield self.row(data, False)
                self.number += 1
                self.state, self.data = "size", []
            else:
                raise ValueError(f"chunk {self.number} of {self.fields.get('warc-record-id')} has no end")
            return
        text = line.rstrip(b"\r")
        if self.state == "between":
            if text.startswith(b"WARC/"):
                self.state, self.fields = "warc", {}
                self.sha, self.size, self.number = hashlib.sha1(), 0, 0
        elif self.state == "warc":
            if text:
                name, _, value = text.decode().partition(":")
                self.fields[name.strip().lower()] = value.strip()
            else:
                self.state = "http"
        elif self.state == "http":
            if not text and self.fields.get("warc-type") == "revisit":
                yield self.row(None, True)
                self.state = "between"
            elif not text:
                self.state = "size"
        elif self.state == "size":
            n = int(text, 16)
            if n:
                self.state, self.left = "chunk", n + 2  # the data and CR LF
            else:
                yield self.row(None, True)
                self.state = "between"


CHUNK_ROW = ("record_id string, chunk_no bigint, data binary, bytes_so_far bigint, sha1_so_far string, last boolean, "
             "record_type string, record_key string, url string, refers_to string")


def read_chunks(spark: SparkSession, path: str, data: bool = True) -> DataFrame:
    """Chunk rows of all archives under ``path``; each record ends in a row with ``last`` and no data."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file")))
    names = [x.split()[0] for x in CHUNK_ROW.split(", ")]
    types = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), *[pa.string()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, parser, out, size = None, None, [], 0

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for batch in batches:
            for line, name in zip(batch.column(0), batch.column(1).to_pylist()):
                if name != file:
                    file, parser = name, _Parser()
                for row in parser.line(line.as_py()):
                    if data or row[5]:
                        out.append(row)
                        size += 200 + len(row[2] or b"")
                if size >= BATCH_BYTES:
                    yield flush()
                    out, size = [], 0
        yield flush()

    return lines.mapInArrow(run, CHUNK_ROW)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record_key, url, record_type, refers_to, payload_bytes, payload_digest."""
    return read_chunks(spark, path, data=False).select(
        "record_key", "url", "record_type", "refers_to", F.col("bytes_so_far").alias("payload_bytes"),
        F.col("sha1_so_far").alias("payload_digest"))
