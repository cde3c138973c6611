"""A deterministic sharded WARC writer, and its reader.

Records are sorted by page_id, url and digest. Shards are cut where the running sum of payload bytes
passes a multiple of ``shard_bytes``, also among null and repeated page_ids, so they depend on the rows
alone and not on how Spark dealt them. Only rows equal in all three stay in one shard.
Within a shard files roll at a compressed size. Headers, record ids and digests are made anew from
the rows; dates are a parameter. A task writes each file under a temporary name and renames it when
it is whole; the manifest, a Parquet table written last, lists the files that count. A lost task
runs again and makes the same bytes.

Of pages with equal payloads of at least ``least`` bytes the one with the smallest page_id is a
response, the others revisit it. Null html is an empty payload, null url an empty target; null
page_ids come first and rank above all others when the response is chosen; rows that repeat a
page_id and payload are written as often as they occur, one response and revisits of it. An empty
table gives an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import keep, settled, stamped

DATE = "2026-01-01T00:00:00Z"
#: Payload bytes a shard, compressed bytes a file.
SHARD_BYTES, FILE_BYTES = 16 << 20, 2 << 20
LEVEL = 6
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record")


def _base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, url: str | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {url} {digest} {nth}')}>"


def _target(url: str | None) -> str:
    """The address on one line: white space, control and other characters outside ASCII are percent-encoded."""
    return quote(url or "", safe="!#$%&'()*+,/:;=?@[]~<>\"\\^`{|}")


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int,
           first: tuple | None = None, nth: int = 0, date: str = DATE) -> bytes:
    """One uncompressed record; ``first``: (page_id, url) of the response that it revisits.

    ``digest`` and ``size`` are those of the full payload. ``nth`` counts rows that repeat one another.
    """
    block = _HTTP % size + (payload or b"" if first is None else b"")
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, url, digest, nth)),
        ("WARC-Date", date), ("WARC-Target-URI", _target(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{_base32(block)}"), ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(size))]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if first is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(*first, digest, 0)),
                   ("WARC-Refers-To-Target-URI", _target(first[1])), ("WARC-Refers-To-Date", date)]
        if first[0] is not None:
            fields.append(("X-Refers-To-Page-ID", str(first[0])))
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address that every executor can reach, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///") if uri.startswith("file:/") and
                                  not uri.startswith("file://") else uri)


def _rank(page_id: int | None, url: str | None, digest: str) -> tuple:
    """Sorts as Spark sorts the three, nulls first."""
    return page_id is not None, page_id or 0, url is not None, url or "", digest


class _Shard:
    """Writes one shard's files; finished files are listed in ``done``."""

    def __init__(self, store: fs.FileSystem, folder: str, shard: int, file_bytes: int, attempt: str):
        self.store, self.folder, self.shard, self.most, self.attempt = store, folder, shard, file_bytes, attempt
        self.done: list[tuple] = []
        self.open = None

    def _begin(self) -> None:
        self.name = f"pages-{self.shard:06d}-{len(self.done):04d}.warc.gz"
        self.temporary = f"{self.folder}/.{self.name}.{self.attempt}"
        self.open, self.bytes, self.records, self.hash = self.store.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha1()

    def add(self, data: bytes) -> None:
        if self.open is None:
            self._begin()
        packed = gzip.compress(data, LEVEL, mtime=0)
        self.open.write(packed)
        self.hash.update(packed)
        self.bytes += len(packed)
        self.records += 1
        if self.bytes >= self.most:
            self.close()

    def close(self) -> None:
        if self.open is not None:
            self.open.close()
            self.store.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.shard, self.name, self.records, self.bytes, self.hash.hexdigest()))
            self.open = None


def write_warc(pages: DataFrame, folder: str, least: int = 0, shard_bytes: int = SHARD_BYTES,
               file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Writes the pages under ``folder`` and returns the manifest: shard, file, records, bytes, sha1."""
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    read = pages.select("page_id", "url", "html", F.sha1(html).alias("digest"),
                        F.octet_length(html).cast("long").alias("size"))
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")
    first = read.where(F.col("size") >= least).groupBy("digest").agg(F.min(order).alias("f"), F.count("*").alias("n"))
    first = keep(first.where("n > 1").select(
        "digest", F.col("f.page_id").alias("first_id"), F.col("f.url").alias("first_url")), "first")
    by = ["page_id", "url", "digest"]
    keys = keep(stamped(read.select(*by, "size"), by, "size", "before"), "keys")
    shards = (settled(keys, "size", "before").groupBy(F.floor(F.col("before") / shard_bytes).alias("shard"))
              .agg(F.min(F.struct(*by)).alias("begin")).where("shard > 0"))
    begins = sorted({_rank(*r["begin"]) for r in shards.collect()})  # one row per shard

    @F.pandas_udf("long")
    def shard_of(page_id: pd.Series, url: pd.Series, digest: pd.Series) -> pd.Series:
        # ids come as text: a column of numbers with nulls would be one of floats
        return pd.Series([bisect_right(begins, _rank(None if p is None else int(p), u, d))
                          for p, u, d in zip(page_id, url, digest, strict=True)], dtype="int64")

    shared = F.col("n").isNotNull()
    same = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    rows = read.join(first.withColumn("n", F.lit(True)), "digest", "left").select(
        shard_of(F.col("page_id").cast("string"), "url", "digest").alias("shard"), "page_id", "url", "digest", "size",
        F.when(~(shared & ~same), F.col("html")).alias("html"), shared.alias("shared"), "first_id", "first_url")
    # A task a shard: hashed shards would meet in some tasks and leave others empty.
    dealt = rows.repartitionById(len(begins) + 1, F.col("shard").cast("int")).sortWithinPartitions(
        "shard", "page_id", "url", "digest")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _place(f"{folder}/files")
        store.create_dir(path, recursive=True)
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        shard, done, before, nth = None, [], None, 0
        for batch in batches:
            for number, page_id, url, digest, size, html, shared, first_id, first_url in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if shard is None or shard.shard != number:
                    if shard is not None:
                        shard.close()
                        done += shard.done
                    shard = _Shard(store, path, number, file_bytes, attempt)
                nth = nth + 1 if before == (page_id, url, digest) else 0
                before = (page_id, url, digest)
                leads = not shared or ((page_id, url) == (first_id, first_url) and nth == 0)
                base32 = base64.b32encode(bytes.fromhex(digest)).decode()
                shard.add(record(page_id, url, (html or "").encode() if leads else None, base32, size,
                                 None if leads else (first_id, first_url), nth, date))
        if shard is not None:
            shard.close()
            done += shard.done
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(
                zip(*done, strict=True) if done else [()] * 5,
                (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
            names=["shard", "file", "records", "bytes", "sha1"])

    dealt.mapInArrow(written, "shard long, file string, records long, bytes long, sha1 string").write.parquet(
        f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


#: Compressed bytes that the reader decodes at a time.
FED = 1 << 14


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file; each record is a gzip member of its own."""
    at = 0
    while at < len(data):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            fed = data[at: at + FED]
            if not fed:
                raise ValueError("a file ends within a record")
            parts.append(member.decompress(fed))
            at += len(fed) - len(member.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the manifest's files: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload.

    Digests of files and payloads are checked against what was read.
    """
    listed = spark.read.parquet(f"{folder}/manifest").select("file", "sha1")
    schema = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
              "refers_to long, payload binary")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _place(f"{folder}/files")
        for batch in batches:
            for name, sha1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_stream(f"{path}/{name}", compression=None) as file:
                    data = file.read()
                if hashlib.sha1(data).hexdigest() != sha1:
                    raise ValueError(f"{name} is not the file of the manifest")
                rows = []
                for fields, block in _records(data):
                    whole = fields["WARC-Type"] == "response"
                    payload = block.partition(b"\r\n\r\n")[2] if whole else None
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if whole and _base32(payload) != digest:
                        raise ValueError(f"{name}: a payload differs from its digest")
                    page_id, first = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                    rows.append((
                        page_id and int(page_id), fields["WARC-Target-URI"], fields["WARC-Type"],
                        len(payload) if whole else int(fields["X-Payload-Length"]), digest, first and int(first), payload))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=[f.split()[0] for f in schema.split(", ")])

    # As many tasks as files; the names alone are so few bytes that adaptive execution would read all files in one task.
    return listed.repartition(max(1, listed.count())).mapInArrow(parsed, schema)
