"""Operator 11: a deterministic sharded writer (and reader) of WARC archives.

``write`` sorts the pages by range of (id, digest, url) into shards of about
``shard_bytes`` of payload.  A shard's task writes its records one after the other,
each a gzip member of its own, and begins a new file, with a ``warcinfo`` record at
its head, once the file has ``roll_bytes`` compressed bytes.  Headers are made anew
from the page: record ids from shard, file and place, block and payload digests from
the bytes, dates from the parameter, so equal input gives equal files.

Payloads of at least ``min_bytes`` bytes that stand on several pages are written once,
with the largest id; the other pages become ``revisit`` records, which hold the HTTP
header, the payload's digest and the id, url and date they refer to.  The groups are
found by an aggregate over (digest, size); the digests that repeat are broadcast if
their counted number allows and joined by shuffle beyond that.  Revisits leave their
payload before the sort, so a payload that a third of all pages share is shuffled once.

Commit: a task writes under ``_temporary``, to names that no other attempt has, and
reports its finished files; Spark keeps the reports of one attempt per task in a
table.  A second job moves the reported files to their names (a move done before is
taken for done), and the manifest is written last, by Spark's own committer.  Readers
go by the manifest alone, so a lost executor or a second attempt leaves nothing that
counts.  What attempts left under ``_temporary`` is deleted after that.

``read`` streams the files of a manifest, record by record, checks lengths, block and
payload digests, and gives one row per page.  A task holds one record at a time.

Files are opened by ``pyarrow.fs`` in the workers, by the URI of the folder: local
and shared mounts, S3, GCS, Azure and (with its native library) HDFS.  A folder that
only Spark's own readers reach cannot hold the archives; inputs may lie there.

Defined cases: a null html is an empty payload; a null url has no target header, and
white space and control characters in one are percent-encoded; a null page_id is kept
and is never referred to while another id has the payload (all null: all are responses);
rows that repeat an id and payload each have a record (responses alike if the id is the
group's largest); very long pages are one record of any size; an empty table gives a
manifest without files; other input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm.common import BROADCAST_ROWS, cut, few, scratch, ship

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PAGE_HEADER = "WARC-Page-Id"
REFERS_HEADER = "WARC-Refers-To-Page-Id"
FILES = "shard int, file int, temporary string, name string, records long, bytes long, sha256 string"
PAGES = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_SPACE = {c: f"%{c:02X}" for c in [*range(0x21), 0x7F]}


def _b32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _fields(pairs: list[tuple[str, object]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in pairs if v is not None)


def record(kind: str, record_id: str, date: str, fields: list[tuple[str, object]], block: bytes, content: str) -> bytes:
    """One WARC record, header and block."""
    head = _fields([("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", date), *fields,
                    ("WARC-Block-Digest", _b32(hashlib.sha1(block).digest())), ("Content-Type", content),
                    ("Content-Length", len(block))])
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def page_record(row: dict, record_id: str, date: str) -> bytes:
    """The response or revisit record of a page (columns of ``marked``)."""
    revisit, payload = row["refers_to"] is not None, row["html"] or ""
    body = payload.encode("utf-8")
    http = b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"),
                                             ("Content-Length", row["size"])]) + b"\r\n"
    fields: list[tuple[str, object]] = [
        (PAGE_HEADER, row["page_id"]), ("WARC-Target-URI", row["url"] and row["url"].translate(_SPACE)),
        ("WARC-Payload-Digest", _b32(bytes.fromhex(row["digest"])))]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), (REFERS_HEADER, row["refers_to"]),
                   ("WARC-Refers-To-Target-URI", row["refers_url"] and row["refers_url"].translate(_SPACE)),
                   ("WARC-Refers-To-Date", date)]
    return record("revisit" if revisit else "response", record_id, date, fields, http if revisit else http + body,
                  "application/http; msgtype=response")


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class _Roll:
    """The files of one shard: gzip members, a new file once one is large enough."""

    def __init__(self, root: str, shard: int, roll_bytes: int, level: int, date: str):
        self.fs, self.root = _opened(root)
        self.shard, self.roll_bytes, self.level, self.date = shard, roll_bytes, level, date
        self.attempt = uuid.uuid4().hex                    # a name of this attempt only; never in the bytes
        self.file, self.out = -1, None

    def _member(self, data: bytes) -> None:
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        packed = packer.compress(data) + packer.flush()
        self.out.write(packed)
        self.bytes += len(packed)
        self.sum.update(packed)

    def _id(self) -> str:
        return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{self.shard}/{self.file}/{self.records}"))

    def add(self, row: dict) -> Iterator[dict]:
        if self.out is None:
            self.file, self.records, self.bytes, self.sum = self.file + 1, 0, 0, hashlib.sha256()
            self.at = f"_temporary/{self.attempt}-{self.file:05d}.warc.gz"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.root}/{self.at}", compression=None)
            about = _fields([("software", "tidewatch"), ("format", "WARC File Format 1.1")])
            self._member(record("warcinfo", self._id(), self.date, [("WARC-Filename", self.name())], about,
                                "application/warc-fields"))
        self.records += 1
        self._member(page_record(row, self._id(), self.date))
        if self.bytes >= self.roll_bytes:
            yield self.close()

    def name(self) -> str:
        return f"pages-{self.shard:06d}-{self.file:05d}.warc.gz"

    def close(self) -> dict:
        self.out.close()
        self.out = None
        return {"shard": self.shard, "file": self.file, "temporary": self.at, "name": self.name(),
                "records": self.records, "bytes": self.bytes, "sha256": self.sum.hexdigest()}


def marked(pages: DataFrame, *, min_bytes: int = 1000, broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """(``page_id, url, html, size, digest, refers_to, refers_url`` of every page, bytes of all
    payloads).  The html of pages that refer to another is left out."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.octet_length(html).cast("long").alias("size"), F.sha1(html).alias("digest"),
                        F.spark_partition_id().alias("split"))
    groups = cut(rows.groupBy("digest", "size").agg(
        F.count("*").alias("n"), F.min("page_id").alias("least"), F.max(F.when(F.col("page_id").isNotNull(),
                                                                               F.struct("page_id", "url"))).alias("top")))
    total = groups.agg(F.sum(F.col("n") * F.col("size"))).first()[0] or 0
    repeated = cut(groups.where((F.col("n") > 1) & (F.col("size") >= min_bytes) & F.col("top").isNotNull())
                   .select("digest", "size", F.col("top.page_id").alias("top_id"), F.col("top.url").alias("top_url")))
    other = F.col("top_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top_id"))
    return (rows.join(few(repeated, broadcast_rows), ["digest", "size"], "left")
            .select("page_id", "url", F.when(~other, F.col("html")).alias("html"), "size", "digest",
                    F.when(other, F.col("top_id")).alias("refers_to"), F.when(other, F.col("top_url")).alias("refers_url"),
                    "split"), total)


def write(pages: DataFrame, root: str, *, min_bytes: int = 1000, shard_bytes: int = 64 << 20, roll_bytes: int = 32 << 20,
          most_shards: int = 20_000, level: int = 6, date: str = "2000-01-01T00:00:00Z",
          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives under ``root``; the manifest, one row per file.

    Beyond ``most_shards`` shards (tasks) grow and hold more files."""
    spark = pages.sparkSession
    ship(spark)
    rows, total = marked(pages, min_bytes=min_bytes, broadcast_rows=broadcast_rows)
    order = ["page_id", "digest", F.xxhash64("url"), "split"]   # the last deals repeated rows over shards
    shards = max(1, min(most_shards, -(-total // shard_bytes)))
    sorted_rows = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, done = _Roll(root, TaskContext.get().partitionId(), roll_bytes, level, date), []
        for batch in batches:
            for k in range(batch.num_rows):
                done += roll.add(batch.slice(k, 1).to_pylist()[0])
        if roll.out is not None:
            done.append(roll.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_FILES)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        place, base = _opened(root)
        for batch in batches:
            for f in batch.to_pylist():
                source, target = (place.get_file_info(f"{base}/{x}") for x in (f["temporary"], f["name"]))
                if source.type == fs.FileType.File:
                    place.move(source.path, target.path)
                elif target.type != fs.FileType.File or target.size != f["bytes"]:
                    raise FileNotFoundError(f"{f['temporary']} of {f['name']} is gone")
            yield batch

    files = cut(sorted_rows.select("page_id", "url", "html", "size", "digest", "refers_to", "refers_url")
                .mapInArrow(store, FILES))
    moved = files.repartition(max(1, min(200, files.count()))).mapInArrow(move, FILES)
    moved.drop("temporary").write.json(f"{root}/_manifest")
    _forget(spark, f"{root}/_temporary")
    return manifest(spark, root)


_FILES = pa.schema([("shard", pa.int32()), ("file", pa.int32()), ("temporary", pa.string()), ("name", pa.string()),
                    ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def _forget(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """``shard, file, name, records, bytes, sha256`` of the archives committed under ``root``."""
    return spark.read.schema(FILES).json(f"{root}/_manifest").drop("temporary")


_LINE = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)\r\n")


class Members:
    """Reads the gzip members of a stream as one stream of bytes, in bounded pieces."""

    def __init__(self, stream, piece: int = 1 << 20):
        self.stream, self.piece = stream, piece
        self.unpack, self.raw, self.data = zlib.decompressobj(31), b"", bytearray()

    def more(self) -> bool:
        raw = self.raw or self.stream.read(self.piece)
        if not raw:
            return False
        if self.unpack.eof:
            self.unpack = zlib.decompressobj(31)
        self.data += self.unpack.decompress(raw, self.piece)
        self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        """The bytes up to and with ``mark``; empty at the end."""
        seen = 0
        while (at := self.data.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.data)
            if not self.more():
                if self.data:
                    raise ValueError("archive ends within a header")
                return b""
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.data) < n:
            if not self.more():
                raise ValueError("archive ends within a record")
        out = bytes(self.data[:n])
        del self.data[:n]
        return out


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record, block digests checked."""
    source = Members(stream)
    while head := source.until(b"\r\n\r\n"):
        version, _, rest = head.partition(b"\r\n")
        if version != VERSION:
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = {k.decode(): v.decode() for k, v in _LINE.findall(rest)}
        block = source.take(int(fields["Content-Length"]))
        if source.take(4) != b"\r\n\r\n" or fields.get("WARC-Block-Digest") != _b32(hashlib.sha1(block).digest()):
            raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
        yield fields, block


def page_of(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    """A row of ``read`` from a response or revisit record."""
    http, _, body = block.partition(b"\r\n\r\n")
    own = {k.lower(): v for k, v in _LINE.findall(http.partition(b"\r\n")[2] + b"\r\n")}
    size, kind = int(own[b"content-length"]), fields["WARC-Type"]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if kind == "response" and (len(body) != size or hashlib.sha1(body).digest() != digest):
        raise ValueError(f"damaged payload {fields.get('WARC-Record-ID')}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number(PAGE_HEADER), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest.hex(), "record_type": kind, "refers_to": number(REFERS_HEADER),
            "payload": body if payloads and kind == "response" else None}


def read(spark: SparkSession, root: str, *, payloads: bool = True) -> DataFrame:
    """One row per page of the archives under ``root``; ``payload`` is null for revisits."""
    ship(spark)
    files = manifest(spark, root).select("name", "records")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, base = _opened(root)
        for batch in batches:
            for f in batch.to_pylist():
                rows, held, n = [], 0, 0
                with place.open_input_stream(f"{base}/{f['name']}", compression=None) as stream:
                    for fields, block in records(stream):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(page_of(fields, block, payloads))
                        held, n = held + len(rows[-1]["payload"] or b""), n + 1
                        if len(rows) >= 1000 or held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if n != f["records"]:
                    raise ValueError(f"{f['name']} has {n} records, its manifest says {f['records']}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.repartition(max(1, files.count())).mapInArrow(load, PAGES)


def archive(pages: DataFrame, **settings) -> DataFrame:
    """Write the archives to the shared folder and read them back: a row per page."""
    spark = pages.sparkSession
    root = scratch(spark)
    write(pages, root, **settings)
    return read(spark, root, payloads=False)
