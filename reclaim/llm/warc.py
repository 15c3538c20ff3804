"""Operator 10: WARC writer, monolithic gzip normaliser and indexed reader.

``write`` turns records into archives that are one gzip stream each (the
"monolithic" form that some crawlers leave behind).  ``normalise`` inflates
such a stream once, rewrites every record as a gzip member of its own and
writes a sidecar index (one JSON line per record with offset and length).
``read`` seeks by that index and inflates single members.

Archives live in a folder of a store that all executors share, reached by
``pyarrow.fs`` (file:, hdfs:, s3: ...).  A task writes under a name of its own
and reports it as a row; the reported rows are committed by Spark, so a task
that is run again after a lost executor leaves at most an unlisted file.

Payloads of at least ``LEAST`` bytes that occur more than once are stored once:
the record with the largest page_id is the response, all others revisit it.

Cases: null html is an empty payload, null url an empty target, a record with
a null page_id revisits an equal payload that has one (alone it is a response
and has no refers_to), rows repeated with the same page_id and payload are all
responses, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import MB, partitions, written

LEAST = 1000  # payload bytes from which a copy becomes a revisit
ARCHIVE_MB = 64  # payload after which a task begins another archive
CHUNK = 1 << 20
FILES = "path string, n_records long, n_bytes long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no fetch time


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and
    refers_to of every page."""
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    # One row per payload that occurs again; written, so that the join with a
    # hot payload can be split.
    copies = written(
        base.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1 and keeper is not null")
        .drop("n"),
        "warc-copies",
    )
    again = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return base.join(copies, "payload_digest", "left").select(
        "page_id",
        "url",
        F.when(~again, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("keeper")).alias("refers_to"),
    )


def urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    number = name.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record_bytes(row: dict) -> tuple[bytes, bytes]:
    """Head (WARC and HTTP header) and tail of a record; the payload, if the
    record has one, goes between."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    size = len(http) + (len(row["payload"]) if row["record_type"] == "response" else 0)
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {urn(row['page_id'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(row['url'], safe=SAFE)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {size}",
    ]
    if row["record_type"] == "revisit":
        lines[3:3] = [f"WARC-Refers-To: {urn(row['refers_to'])}", f"WARC-Profile: {PROFILE}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http, b"\r\n\r\n"


SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def headers(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}


def store(folder: str):
    """File system and path of a folder given by URI or local path."""
    from pyarrow import fs

    if folder.startswith("file:") or ":" not in folder:
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write(recs: DataFrame, folder: str, archive_mb: int = ARCHIVE_MB) -> DataFrame:
    """Write records as whole-file gzip streams; one row per archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        out, path, squeeze, n, size = None, "", None, 0, 0

        def close() -> pa.RecordBatch:
            out.write(squeeze.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [n], "n_bytes": [size]})

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if out is None:
                        path = f"{root}/{uuid.uuid4().hex}.whole.warc.gz"
                        out, squeeze, n, size = files.open_output_stream(path, compression=None), zlib.compressobj(1, wbits=31), 0, 0
                    head, tail = record_bytes(row)
                    for part in (head, row["payload"] if row["record_type"] == "response" else b"", tail):
                        out.write(squeeze.compress(part))
                    n, size = n + 1, size + len(row["payload"] or b"")
                    if size >= archive_mb * MB:
                        yield close()
                        out = None
        if out is not None:
            yield close()

    return recs.mapInArrow(run, FILES)


class Inflater:
    """Bytes of a gzip file (of any number of members), read forward once."""

    def __init__(self, source):
        self.source, self.buffer, self.member, self.ended = source, bytearray(), zlib.decompressobj(31), False

    def more(self) -> bool:
        """Inflate one more chunk into the buffer; False at the end."""
        if self.ended:
            return False
        raw = self.member.unused_data or self.source.read(CHUNK)
        if self.member.eof:
            self.member = zlib.decompressobj(31)
        if not raw:
            self.ended = True
            return False
        self.buffer += self.member.decompress(raw)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        got = bytes(self.buffer[: at + len(mark)])
        del self.buffer[: at + len(mark)]
        return got

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in chunks."""
        while n:
            if not self.buffer and not self.more():
                raise ValueError("the archive ends inside a record")
            got = bytes(self.buffer[:n])
            del self.buffer[:n]
            n -= len(got)
            if got:
                yield got


def rewrite(source, target, level: int = 6) -> list[dict]:
    """Rewrite one archive with a gzip member per record; its index rows."""
    flow, at, index = Inflater(source), 0, []

    def put(data: bytes) -> int:
        target.write(data)
        return len(data)

    while (head := flow.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        fields = headers(head[:-4])
        squeeze, start = zlib.compressobj(level, wbits=31), at
        at += put(squeeze.compress(head))
        for part in flow.take(int(fields["content-length"])):
            at += put(squeeze.compress(part))
        for _ in flow.take(4):  # the blank lines that end a record
            pass
        at += put(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
        index.append({"offset": start, "length": at - start, "type": fields["warc-type"], "id": fields["warc-record-id"]})
    return index


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives (path) member by record, each with a sidecar index
    beside it; one row per new archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        for batch in batches:
            for old in batch.column(0).to_pylist():
                path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                with files.open_input_stream(old, compression=None) as source, files.open_output_stream(path, compression=None) as target:
                    index = rewrite(source, target)
                with files.open_output_stream(path + ".idx", compression=None) as side:
                    side.write("".join(json.dumps(x) + "\n" for x in index).encode())
                yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [len(index)], "n_bytes": [sum(x["length"] for x in index)]})

    return archives.select("path").mapInArrow(run, FILES)


def member(raw: bytes) -> dict:
    """The record of one gzip member."""
    data = zlib.decompress(raw, 31)
    at = data.index(b"\r\n\r\n") + 4
    fields = headers(data[: at - 4])
    block = data[at : at + int(fields["content-length"])]
    cut = block.index(b"\r\n\r\n") + 4
    http, payload = headers(block[: cut - 4]), block[cut:]
    stated = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    kind = fields["warc-type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != stated or len(payload) != int(http["content-length"])):
        raise ValueError(f"record {fields['warc-record-id']}: payload and digest differ")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": unquote(fields["warc-target-uri"]),
        "payload": payload if kind == "response" else None,
        "payload_bytes": int(http["content-length"]),
        "payload_digest": stated,
        "record_type": kind,
        "refers_to": page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
    }


RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def read(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of normalised archives, each found by the sidecar index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = store(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with files.open_input_stream(path + ".idx", compression=None) as side:
                    index = [json.loads(x) for x in side.read().decode().splitlines()]
                with files.open_input_file(path) as archive:
                    for at in range(0, len(index), 64):
                        rows = []
                        for x in index[at : at + 64]:
                            archive.seek(x["offset"])
                            rows.append(member(archive.read(x["length"])) | ({} if payloads else {"payload": None}))
                        yield pa.RecordBatch.from_pylist(rows, RECORD)

    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.select("path").mapInArrow(run, schema)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Write pages, normalise the archives and read them back without their
    payloads (digest and length are checked while reading)."""
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    files, root = store(folder)
    files.create_dir(root, recursive=True)
    whole = written(write(records(pages, least), folder), "warc-whole")
    # One archive per task: a few rows name much work.
    spread = lambda df: df.repartition(partitions(df.count()), "path")
    members = written(normalise(spread(whole), folder), "warc-members")
    return read(spread(members), folder, payloads=False).drop("url", "payload")
