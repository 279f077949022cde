"""WARC archives with a two-level capture index.

Every page becomes a record, compressed on its own.  Of pages with equal payloads
of at least 100 bytes the one with the smallest id is a response and the others
revisit it.  The index is sorted by reversed-host key: shards of compressed blocks
of lines, each shard with a sparse directory of its blocks at its end.  A look-up
finds the shard and then the block by binary search, and then reads byte ranges.

A null payload is empty, a null url has the key ``-``.  Rows that share the smallest
id of a payload are all responses; a null id is never the smallest.  All rows are
kept, repeated ones too.  Shard and archive files are named by the stored tables.  A
record is held in memory one at a time, so a long payload needs its own size.  An empty
table gives no files and no rows.  Columns other than id, url and html are not read.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinionlake.llm.files import Output, Ranges, new_name

LEAST_REVISIT = 100
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1000
SHARD_LINES = 200_000
# Every record carries this date: the tables have none.
DATE = "2024-01-01T00:00:00Z"
_STAMP = "20240101000000"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_TRAILER = "<QQ8s"
_MAGIC = b"CDXBLK1\n"


def url_key(url: Column) -> Column:
    """com,example,www)/path?query; the lower-cased url where no host can be read."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    query = F.coalesce(F.concat(F.lit("?"), F.try_parse_url(url, F.lit("QUERY"))), F.lit(""))
    key = F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path, query), F.lower(url), F.lit("-"))
    for plain, code in ((" ", "%20"), ("\t", "%09"), ("\n", "%0A"), ("\r", "%0D")):
        key = F.replace(key, F.lit(plain), F.lit(code))
    return key


def capture_key(url: Column, page: Column) -> Column:
    """The key of one capture: url key, time and id, as index lines begin."""
    return F.concat_ws(" ", url_key(url), F.lit(_STAMP), F.coalesce(page.cast("string"), F.lit("-")))


def _record_id(page: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page} {digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """A WARC/1.1 record."""
    body = _HTTP if refers is not None else _HTTP + payload
    head = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", _record_id(page, digest)),
            ("WARC-Date", DATE), ("WARC-Target-URI", " ".join((url or "").split())), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("X-Payload-Length", len(payload)), ("X-Page-Id", "-" if page is None else page),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(body))]
    if refers is not None:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers, digest)), ("X-Refers-To-Page-Id", refers)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8") + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of a record; raises if a response's payload is not the one named in its headers."""
    head, _, body = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = body[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    number = lambda name: None if fields.get(name, "-") == "-" else int(fields[name])
    return {"page_id": number("X-Page-Id"), "payload_bytes": number("X-Payload-Length"), "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"), "url": fields["WARC-Target-URI"],
            "payload": payload}


def write_archives(spark: SparkSession, pages: DataFrame, root: str, page: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """Write a record per page; returns the stored captures (key, page_id, digest, kind, path, offset, length).

    Who revisits whom is decided on digests alone.  Payloads that can be revisits are
    shuffled once, by digest, where Spark's skewed join splits a digest of very many
    pages; shorter ones, however many are equal, stay where they are.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long, short = (rows.filter((F.octet_length("payload") >= LEAST_REVISIT) == known) for known in (True, False))
    first = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    placed = long.join(first, "digest", "left").unionByName(short.withColumn("first", F.lit(None).cast("long")))
    decided = placed.select(
        capture_key(F.col("url"), F.col("page_id")).alias("key"), "page_id", "url", "payload", "digest", refers.alias("refers"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: Output | None = None
        for batch in batches:
            made = []
            for key, page_id, link, payload, digest, to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or out.size >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    out = Output(new_name(f"{root}/archives", "pages", ".warc.gz"))
                data = gzip.compress(record(page_id, link, payload, digest, to), 1, mtime=0)
                made.append((key, page_id, digest, "response" if to is None else "revisit", out.uri, out.write(data), len(data)))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _CAPTURE.types)], schema=_CAPTURE)
        if out is not None:
            out.close()

    captures = decided.mapInArrow(run, "key string, page_id long, digest string, kind string, path string, offset long, length long")
    captures.write.mode("overwrite").parquet(f"{root}/captures")
    return spark.read.schema(captures.schema).parquet(f"{root}/captures")


_CAPTURE = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()), ("kind", pa.string()),
                      ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def write_index(spark: SparkSession, captures: DataFrame, root: str, shard_lines: int = SHARD_LINES,
                block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort the captures into shards of compressed blocks; returns the stored list of shards (first_key, path, n)."""
    shards = max(1, -(-captures.count() // shard_lines))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: Output | None = None
        directory: list[tuple[str, str, int, int]] = []
        held: list[str] = []
        keys: list[str] = []
        n = 0

        def flush() -> None:
            nonlocal out
            if out is None:
                out = Output(new_name(f"{root}/index", "shard", ".cdx"))
            block = zlib.compress("".join(held).encode("utf-8"))
            directory.append((keys[0], keys[-1], out.write(block), len(block)))
            held.clear()
            keys.clear()

        for batch in batches:
            for key, page_id, digest, kind, path, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(f"{key} {json.dumps([page_id, digest, kind, path, offset, length])}\n")
                keys.append(key)
                n += 1
                if len(held) == block_lines:
                    flush()
        if held:
            flush()
        if out is not None:
            listing = zlib.compress(json.dumps(directory).encode("utf-8"))
            out.write(listing + struct.pack(_TRAILER, out.size, len(listing), _MAGIC))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([out.uri]), pa.array([out.size], pa.int64()),
                                              pa.array([n], pa.int64())], names=["first_key", "path", "size", "n"])

    dealt = captures.repartitionByRange(shards, "key", "path", "offset").sortWithinPartitions("key", "path", "offset")
    made = dealt.select(*_CAPTURE.names).mapInArrow(run, "first_key string, path string, size long, n long")
    made.write.mode("overwrite").parquet(f"{root}/shards")
    return spark.read.schema(made.schema).parquet(f"{root}/shards")


class Shard:
    """An open shard: its directory, and the block read last."""

    def __init__(self, ranges: Ranges, path: str, size: int):
        self.ranges, self.path = ranges, path
        at, length, magic = struct.unpack(_TRAILER, ranges.read(path, size - struct.calcsize(_TRAILER), struct.calcsize(_TRAILER)))
        if magic != _MAGIC:
            raise IOError(f"{path} is no index shard")
        self.directory = json.loads(zlib.decompress(ranges.read(path, at, length)))
        self.lasts = [block[1] for block in self.directory]
        self._block, self._keys, self._lines = -1, [], []

    def find(self, prefix: str) -> Iterator[list]:
        """Captures whose key is ``prefix`` or goes on after it with a blank."""
        number = bisect.bisect_left(self.lasts, prefix)
        while number < len(self.directory) and self.directory[number][0] < prefix + "!":
            if number != self._block:
                data = self.ranges.read(self.path, self.directory[number][2], self.directory[number][3])
                self._lines = zlib.decompress(data).decode("utf-8").split("\n")[:-1]
                self._block = number
            begin = bisect.bisect_left(self._lines, prefix + " ")
            for line in self._lines[begin:bisect.bisect_left(self._lines, prefix + "!", begin)]:
                yield json.loads(line[line.index(" ["):])
            number += 1


def _tasks(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def look_up(shards: DataFrame, wanted: DataFrame, key: str = "key") -> DataFrame:
    """Captures of the wanted keys: a url key finds all its captures, a capture key that one.

    The list of shards, one row for ``SHARD_LINES`` captures, goes to every task; the
    directories stay in the shards and are read by the tasks that search them.
    """
    listed = [tuple(row) for row in shards.select("first_key", "path", "size").orderBy("first_key", "path").collect()]
    firsts = [x[0] for x in listed]

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for prefix in batch.column(0).to_pylist():
                begin = max(0, bisect.bisect_left(firsts, prefix) - 1)
                out += [(prefix, s) for s in range(begin, bisect.bisect_left(firsts, prefix + "!"))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int32())],
                                             names=["prefix", "shard"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, number, shard = Ranges(), -1, None
        for batch in batches:
            found = []
            for prefix, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s != number:
                    number, shard = s, Shard(ranges, *listed[s][1:])
                found += shard.find(prefix)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _CAPTURE.types[1:])],
                                                 schema=pa.schema(list(_CAPTURE)[1:]))
        ranges.close()

    keys = wanted.select(F.col(key).alias("prefix")).filter(F.col("prefix").isNotNull()).distinct()
    routed = keys.mapInArrow(route, "prefix string, shard int")
    # a hash of the key spreads one shard's searches over tasks; rows are few and work is much, so tasks are not merged
    dealt = routed.repartition(_tasks(wanted.sparkSession), "shard", F.pmod(F.xxhash64("prefix"), F.lit(16))).sortWithinPartitions("shard", "prefix")
    return dealt.mapInArrow(search, "page_id long, digest string, kind string, path string, offset long, length long")


def read_records(captures: DataFrame, payload: bool = True) -> DataFrame:
    """The records of captures, by byte ranges in the order of the archives."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"] + ["payload"] * payload
    types = dict(page_id=pa.int64(), payload_bytes=pa.int64(), refers_to=pa.int64(), payload=pa.binary())
    schema = pa.schema([(name, types.get(name, pa.string())) for name in columns])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges()
        for batch in batches:
            rows = [parse_record(gzip.decompress(ranges.read(*at))) for at in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_pylist([{name: row[name] for name in columns} for row in rows], schema=schema)
        ranges.close()

    # a narrow row stands for a record to read and unpack, so tasks are not merged
    dealt = captures.select("path", "offset", "length").repartition(_tasks(captures.sparkSession), "path", F.floor(F.col("offset") / (1 << 20)))
    text = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    return dealt.sortWithinPartitions("path", "offset").mapInArrow(run, text + ", payload binary" * payload)
