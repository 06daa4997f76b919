"""WARC: a deterministic sharded writer, and a reader of its archives.

Payload digests are grouped first, to choose the response of equal payloads
(the smallest page id); pages that revisit it get a small row naming it. Pages
and these rows are dealt into shards by page id and sorted, so each page meets
its row without a second shuffle of the payloads. A shard is written by one
task in page order, one gzip member a record, and rolls on to a new file when
the compressed size reaches its bound. Shard borders, record ids, headers and
digests depend on the rows alone, so every run and every retry writes the same
bytes. Files get their final names when complete; the archive is what the
manifest table lists, and that is committed last.

Defined cases: a null html is an empty payload; a null url becomes
``about:blank``; a null page id sorts first and stands in no header, and is a
response's id only if all equal payloads lack one; of rows that repeat both id
and payload one is the response and the others revisit it; an empty table
gives an archive without files; columns other than page_id, url and html are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm import files
from tierloom.sources.storage import materialize, scratch_path

VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tierloom:warc")
#: Compressed bytes at which a file is closed and the next one begins.
FILE_BYTES = 1 << 30
#: Payloads smaller than this are all responses.
LEAST_BYTES = 0
#: The pages carry no time of their own; records bear this one.
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "shard int, part int, file string, records long, bytes long, sha256 string"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)

Batches = Iterator[pa.RecordBatch]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str, repeat: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}/{repeat}')}>"


def _uri(url: str | None) -> str:
    return (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")


def _member(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in headers if value is not None)]
    record = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


def page_record(page_id, url, payload: bytes, digest: str, repeat: int, first: tuple | None) -> bytes:
    """One gzip member: a response, or a revisit of ``first`` (page id and url of the response)."""
    http = "\r\n".join(
        ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    ).encode()
    block = http + (b"" if first else payload)
    headers = [
        ("WARC-Type", "revisit" if first else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, repeat)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _uri(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Page-Id", page_id),
        ("X-Payload-Length", len(payload)),
    ]
    if first:
        headers += [
            ("WARC-Profile", REVISIT),
            ("WARC-Refers-To", record_id(first[0], digest, 0)),
            ("WARC-Refers-To-Target-URI", _uri(first[1])),
            ("WARC-Refers-To-Date", DATE),
            ("X-Refers-To-Page-Id", first[0]),
        ]
    return _member(headers, block)


def _info(shard: int, part: int) -> bytes:
    block = b"software: tierloom\r\nformat: WARC File Format 1.1\r\n"
    name = f"shard {shard} part {part}"
    own = f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>"
    kind = "application/warc-fields"
    return _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("Content-Type", kind)], block)


def _with_responses(pages: DataFrame) -> DataFrame:
    """Pages and, before each page that shares its payload, a row naming the response."""
    html = F.coalesce("html", F.lit(""))
    sized = F.octet_length(html)
    seen = materialize(
        pages.select("page_id", "url", F.sha1(html).alias("digest"), sized.alias("n")).where(F.col("n") >= LEAST_BYTES)
    )
    first = F.min(F.struct(F.col("page_id").isNull().alias("missing"), "page_id", "url"))
    repeated = materialize(
        seen.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).where("n > 1").drop("n")
    )
    named = seen.select("page_id", "digest").join(repeated, "digest")
    nothing = F.lit(None).cast("string")
    rows = pages.select("page_id", "url", "html", nothing.alias("digest"), F.lit(None).cast("long").alias("first_id"))
    return rows.unionByName(
        named.select(
            "page_id", F.col("first.url").alias("url"), nothing.alias("html"), "digest",
            F.col("first.page_id").alias("first_id"),
        )
    )


def write(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all pages below ``folder`` and return the committed manifest."""
    rows = _with_responses(pages.select(F.col("page_id").cast("long"), "url", "html"))
    sized = F.coalesce(F.octet_length("html"), F.lit(0)) + F.lit(256)
    # Borders are cut from the pages alone; the naming rows follow their page's id.
    dealt, shards = files.with_shard(rows, "page_id", sized, "shard")

    def save(batches: Batches) -> Batches:
        writer = _Writer(folder, file_bytes)
        names: dict[str, tuple] = {}
        repeats: dict[str, int] = {}
        current: tuple | None = None
        for batch in batches:
            for row in batch.to_pylist():
                at = (row["shard"], row["page_id"])
                if at != current:
                    names, repeats, current = {}, {}, at
                if row["digest"]:
                    names[row["digest"]] = (row["first_id"], row["url"])
                    continue
                payload = (row["html"] or "").encode()
                first = names.get(hashlib.sha1(payload).hexdigest())
                digest = payload_digest(payload)
                repeat = repeats.get(digest, 0)
                repeats[digest] = repeat + 1
                if first and first[0] == row["page_id"] and not repeat:
                    first = None
                writer.add(row["shard"], page_record(row["page_id"], row["url"], payload, digest, repeat, first))
        writer.close()
        yield pa.RecordBatch.from_pylist(writer.done, MANIFEST_ARROW)

    ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "page_id", F.col("digest").isNull(), "url", "html")
    listed = f"{folder}/_manifest"
    ordered.mapInArrow(save, MANIFEST).write.parquet(listed)
    files.clear_temporary(folder)
    return pages.sparkSession.read.parquet(listed)


MANIFEST_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("part", pa.int32()), ("file", pa.string()), ("records", pa.int64()),
        ("bytes", pa.int64()), ("sha256", pa.string()),
    ]
)


class _Writer:
    """Files of the shards that come, one after the other; ``done`` lists the complete ones."""

    def __init__(self, folder: str, file_bytes: int) -> None:
        self.folder, self.file_bytes = folder, file_bytes
        self.done: list[dict] = []
        self.out = None
        self.shard = self.part = -1

    def add(self, shard: int, member: bytes) -> None:
        if self.out and (shard != self.shard or self.size >= self.file_bytes):
            self.close()
        if not self.out:
            self.part = self.part + 1 if shard == self.shard else 0
            self.shard, self.size, self.records, self.sum = shard, 0, 0, hashlib.sha256()
            self.name = f"shard-{shard:06d}-{self.part:04d}.warc.gz"
            self.file = files.committed(self.folder, self.name)
            self.out = self.file.__enter__()
            self._put(_info(shard, self.part))
        self._put(member)
        self.records += 1

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sum.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out:
            self.file.__exit__(None, None, None)
            self.done.append(
                {"shard": self.shard, "part": self.part, "file": self.name, "records": self.records,
                 "bytes": self.size, "sha256": self.sum.hexdigest()}
            )
            self.out = None


def _members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Records of a gzip file with one member each."""
    open_, pieces = zlib.decompressobj(31), []
    rest = stream.read(chunk)
    while rest:
        pieces.append(open_.decompress(rest))
        if open_.eof:
            yield b"".join(pieces)
            rest, open_, pieces = open_.unused_data or stream.read(chunk), zlib.decompressobj(31), []
        else:
            rest = stream.read(chunk)
    if pieces:
        raise ValueError("the file ends within a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0]!r}")
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def _page_row(headers: dict[str, str], block: bytes) -> dict:
    """What a page's record says; digests of its block and its payload are checked."""
    if headers["warc-block-digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError(f"{headers['warc-record-id']}: the block does not have its digest")
    payload = block.partition(b"\r\n\r\n")[2] if headers["warc-type"] == "response" else None
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if payload is not None and payload_digest(payload) != digest:
        raise ValueError(f"{headers['warc-record-id']}: the payload does not have its digest")
    number = {name: int(headers[name]) if name in headers else None for name in ("x-page-id", "x-refers-to-page-id")}
    return {
        "page_id": number["x-page-id"],
        "url": headers["warc-target-uri"],
        "payload_bytes": int(headers["x-payload-length"]),
        "payload_digest": digest,
        "record_type": headers["warc-type"],
        "refers_to": number["x-refers-to-page-id"],
        "payload": payload,
    }


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per page record of the files the manifest lists, a file per task."""
    listed = spark.read.parquet(f"{folder}/_manifest").select("file", "sha256")
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def load(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                store, root = files.open_place(folder)
                with store.open_input_stream(f"{root}/{row['file']}", compression=None) as stream:
                    rows, size = [], 0
                    for headers, block in map(parse, _members(stream)):
                        if headers["warc-type"] == "warcinfo":
                            continue
                        found = _page_row(headers, block)
                        if not payloads:
                            found["payload"] = None
                        rows.append(found)
                        size += len(found["payload"] or b"") + 500
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return listed.repartition(max(1, listed.count()), "file").mapInArrow(load, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to a new folder of the shared store and read them back, without payloads."""
    folder = scratch_path(pages.sparkSession)
    write(pages, folder)
    return read(pages.sparkSession, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
