"""WARC archives: a deterministic sharded writer and a reader.

Writing: records are range-sorted by id, and by a hash within an id, into shards of about
``shard_bytes`` of payload. Where a shard begins follows from exact running sums of bytes over narrow
rows (id, hash, size), so ids may lie as they like: one far from all others moves no cut. Cut points
are broadcast; there are at most ``MAX_SHARDS`` (beyond that shards get larger). Rows that agree in id,
URL and payload share a shard. A shard is one task's sorted run, and neighbouring shards share a
task. Its file is rolled when the compressed size passes ``roll_bytes``. Headers, block digests and payload digests are made anew from the payload; record
ids, dates and gzip members are functions of the data, so a file written twice is the same file.
Every file is written under a temporary name and renamed when complete; the manifest (one row per
file) is a Parquet table that Spark commits last, and readers read only files that it lists.

Of records with equal payloads of at least ``revisit_bytes`` bytes, that with the largest id is
the response and the others are revisits that refer to it; copies are counted by an aggregate with
partial aggregation, and the join back to the ids can be split where a payload is hot. Payloads
themselves are shuffled once, and the decisions on them travel in the same sort.

Files go through the file system of the target's URI (local or shared folders, HDFS or object
stores known to pyarrow.fs) and are read back through Spark's binaryFile source.

Defined results: a null payload counts as empty. Null ids sort first; among equal payloads a null
id is never the largest unless all are null, when all are responses. Rows that repeat the largest
id are each a response. A null URL leaves out the header; control characters in it are escaped.
An empty table writes an empty manifest and reads back no rows. Columns beside id, URL and payload
are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import as_uri, quoted, shared_folder, ship, shuffle_partitions, stored, table
from quayside.plans import running_sum

MAX_SHARDS = 1 << 20
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
_SPACE = uuid.UUID("6f1c6c1e-5d0a-4b53-9c7e-3c9b1f0a7d11")


def cut_points(narrow: DataFrame, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, tie) at which each shard begins, from exact running sums of bytes in the order of (key, tie); at
    most ``MAX_SHARDS``."""
    total = narrow.agg(F.sum("bytes")).first()[0] or 0
    width = F.lit(max(shard_bytes, -(-total // MAX_SHARDS))).cast("long")
    # equal rows are one row of the running sum
    upto = running_sum(narrow.groupBy("place", "tie").agg(F.sum("bytes").alias("bytes")), [], ["place", "tie"], "bytes", "upto")
    shard = F.call_function("div", F.col("upto") - F.col("bytes"), width)
    rows = upto.groupBy(shard.alias("shard")).agg(F.min(F.struct("place", "tie")).alias("first")).orderBy("shard").select("first.*").toArrow()
    return rows["place"].to_numpy(), rows["tie"].to_numpy()


def shard_of(cuts: tuple[np.ndarray, np.ndarray], place: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The last shard that begins at or before each (place, tie)."""
    places, ties = cuts
    low, high = np.searchsorted(places, place, side="left"), np.searchsorted(places, place, side="right")
    out = high - 1
    cut = np.flatnonzero(low < high)  # ids at which shards begin: the tie decides
    for p in np.unique(low[cut]):
        rows = cut[low[cut] == p]
        out[rows] = p - 1 + np.searchsorted(ties[p:high[rows[0]]], tie[rows], side="right")
    return np.maximum(out, 0)


def _revisits(narrow: DataFrame, revisit_bytes: int) -> DataFrame:
    """The records that repeat a payload and the response they refer to, without payloads."""
    narrow = narrow.where(F.col("size") >= revisit_bytes).select("key", "digest", "place", "tie")
    copies = narrow.groupBy("digest").agg(F.max("key").alias("refers_to"), F.count("*").alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    # written first: a join of two exchanges can split a hot payload, a join of an aggregate cannot
    copies = stored(copies.select("digest", "refers_to"), "warc-copies")
    return narrow.join(copies, "digest").where(~F.col("refers_to").eqNullSafe(F.col("key")))


def _header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{key}/{digest}')}>"


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(key, digest)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    if key is not None:
        fields.append(("X-Row-Id", str(key)))
    fields.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Row-Id", str(refers_to))]
    fields += [("WARC-Block-Digest", _sha1(block)), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields) + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Roll:
    """The files of one shard: a temporary name until complete, then the final one."""

    def __init__(self, fs: pafs.FileSystem, folder: str, shard: str, roll_bytes: int):
        self.fs, self.folder, self.shard, self.roll_bytes, self.part, self.out = fs, folder, shard, roll_bytes, 0, None

    def add(self, member: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"{self.shard}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.folder}/.{self.name}.{uuid.uuid4().hex}.open"
            self.out, self.size, self.records, self.digest = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        self.out.write(member)
        self.digest.update(member)
        self.size, self.records = self.size + len(member), self.records + 1
        if self.size >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            final = f"{self.folder}/{self.name}"
            if self.fs.get_file_info(final).type == pafs.FileType.NotFound:
                self.fs.move(self.temporary, final)
            else:  # an earlier attempt at this task has written the same bytes
                self.fs.delete_file(self.temporary)
            self.out, self.part = None, self.part + 1
            yield self.name, self.records, self.size, self.digest.hexdigest()


def _writer(target: str, roll_bytes: int):
    """Rows arrive sorted by shard and id; a revisit's decision comes right before its record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(target)
        roll, decision = None, (None, None, None)
        for rb in batches:
            rows: list[tuple] = []
            # row by row: a batch's payloads are turned into Python values one at a time
            for i in range(rb.num_rows):
                number, key, digest, refers, kind, url, payload = (rb.column(c)[i].as_py() for c in ("shard", "key", "digest", "refers_to", "kind", "url", "payload"))
                if kind == 0:
                    decision = key, digest, refers
                    continue
                shard = f"part-{number:08d}"
                if roll is None or roll.shard != shard:
                    if roll is not None:
                        rows += roll.close()
                    roll = _Roll(fs, folder, shard, roll_bytes)
                rows += roll.add(_gzip(record(key, url, payload, digest, decision[2] if decision[:2] == (key, digest) else None)))
            if rows:
                yield _manifest(rows)
        if roll is not None and (rows := list(roll.close())):
            yield _manifest(rows)

    return run


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["file", "records", "bytes", "sha256"])


def write_warc(records: DataFrame, target: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_bytes: int = 1000, shard_bytes: int = 16 << 20, roll_bytes: int = 8 << 20) -> str:
    """Write ``records`` as gzipped WARC files below ``target`` (a URI); returns the manifest's path."""
    spark = ship(records.sparkSession)
    fs, folder = pafs.FileSystem.from_uri(target)
    fs.create_dir(folder, recursive=True)
    plain = records.select(quoted(id_col).cast("long").alias("key"), quoted(url_col).alias("url"), quoted(payload_col).alias("html"))
    full = plain.withColumn("payload", F.coalesce(F.col("html").cast("binary"), F.lit(b""))).withColumn("digest", F.sha1("payload")).drop("html")
    # ids, and a hash for the rows of one id; payloads are read twice, and shuffled once below
    full = full.withColumn("place", F.coalesce("key", F.lit(-2**63))).withColumn("tie", F.pmod(F.xxhash64("digest", "url"), F.lit(1 << 30)))
    size = F.octet_length("payload").cast("long")
    narrow = stored(full.select("key", "place", "tie", "digest", size.alias("size"), (size + 600).alias("bytes")), "warc-places")
    cuts = cut_points(narrow, shard_bytes)
    held, shards, width = spark.sparkContext.broadcast(cuts), max(1, len(cuts[0])), shuffle_partitions(spark)
    find = F.pandas_udf(lambda place, tie: pd.Series(shard_of(held.value, place.to_numpy(), tie.to_numpy())), "long")
    told = _revisits(narrow, revisit_bytes).withColumn("kind", F.lit(0)).withColumn("url", F.lit(None).cast("string")).withColumn("payload", F.lit(None).cast("binary"))
    wide = full.withColumn("kind", F.lit(1)).withColumn("refers_to", F.lit(None).cast("long"))
    rows = wide.unionByName(told).withColumn("shard", find("place", "tie")).select("shard", "key", "tie", "digest", "kind", "url", "payload", "refers_to")
    # neighbouring shards share a task
    rows = rows.repartitionById(width, F.call_function("div", F.col("shard") * width, F.lit(shards)).cast("int")).sortWithinPartitions("shard", "key", "tie", "digest", "kind", "url")
    manifest = f"{target}/manifest"
    rows.mapInArrow(_writer(target, roll_bytes), "file string, records long, bytes long, sha256 string").write.parquet(manifest)
    return manifest


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzipped WARC file, one gzip member at a time."""
    at, view = 0, memoryview(data)
    while at < len(data):
        z, parts = zlib.decompressobj(31), []
        while not z.eof and at < len(data):
            chunk = view[at:at + 65_536]
            parts.append(z.decompress(chunk))
            at += len(chunk)
        if not z.eof:
            raise ValueError("truncated archive")
        at, raw = at - len(z.unused_data), b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        yield fields, rest[:int(fields["Content-Length"])]


def _hex(digest: str) -> str:
    return base64.b32decode(digest.removeprefix("sha1:")).hex()


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        for i in range(rb.num_rows):
            rows: list[tuple] = []
            for fields, block in parse_records(rb.column("content")[i].as_buffer().to_pybytes()):
                if _sha1(block) != fields["WARC-Block-Digest"]:
                    raise ValueError(f"block digest differs in {fields['WARC-Record-ID']}")
                head, _, payload = block.partition(b"\r\n\r\n")
                digest, kind = _hex(fields["WARC-Payload-Digest"]), fields["WARC-Type"]
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload digest differs in {fields['WARC-Record-ID']}")
                size = next(int(x.split(b": ")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length: "))
                key, refers = fields.get("X-Row-Id"), fields.get("X-Refers-To-Row-Id")
                rows.append((None if key is None else int(key), fields.get("WARC-Target-URI"), size, digest, kind, None if refers is None else int(refers), payload if kind == "response" else None))
                if len(rows) == 500:
                    yield _records(rows)
                    rows = []
            if rows:
                yield _records(rows)


_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
_NAMES = ["key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def _records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)], names=_NAMES)


def read_warc(spark, target: str) -> DataFrame:
    """The records of the files that the manifest lists: key, url, payload_bytes, payload_digest
    (hex SHA-1), record_type, refers_to, payload (null for revisits). Digests are checked."""
    ship(spark)
    schema = "key long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    files = [r["file"] for r in spark.read.schema("file string").parquet(f"{target}/manifest").toLocalIterator()]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.format("binaryFile").load([f"{target}/{f}" for f in files]).select("content").mapInArrow(_reader, schema)


def op4(spark, sf_dir: str) -> DataFrame:
    """Registered query: write every page to archives in the shared folder and read them back."""
    target = as_uri(shared_folder(spark, "warc"))
    write_warc(table(spark, sf_dir, "pages"), target)
    return read_warc(spark, target).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
