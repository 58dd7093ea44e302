"""WARC archives: pages written as captures, and captures put together again from the archives.

A capture is a request, a response (or a revisit, where an earlier capture has the same payload) and
a metadata record. Request and metadata name the response or revisit in WARC-Concurrent-To.
Reading takes the records of all archives and joins them through these identifiers into one
nested row per capture.

Archives are gzip files with one member per record, written to the shared folder by each task
attempt under a name of its own; the manifest lists those of committed attempts, so a lost
executor leaves at most an unlisted file.

Payload groups: of pages with equal payloads of at least ``least_bytes`` bytes, those with the
smallest page id are responses; the others are revisits that carry digest, length and the first
page's id and URL, but no payload. The digests combine before they are shuffled, and the join that
brings the first page back is one that adaptive execution can split where a payload is very common.

Defined results: a null payload counts as empty, a null URL as an empty one; null page ids stand
after all others; rows that repeat a page id become captures each, and are all responses where their
id is the smallest; an empty table gives no archives and no captures; payloads of any length are
written whole. Columns other than id, URL and payload are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.llm.storage import opened, shared_folder, stored

DATE = "2024-01-01T00:00:00Z"  # captures carry no time of their own
LEVEL = 3
NO_ID = 2**63 - 1
ARCHIVE_BYTES = 256 << 20  # compressed; a task starts another archive beyond
BATCH_BYTES = 16 << 20
END = b"\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, record_id: str, headers: dict[str, str], block: bytes) -> bytes:
    named = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": DATE, **headers, "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named.items()) + "\r\n"
    return head.encode() + block + END


def _header_safe(url: str | None) -> str:
    """A URL with what would end a header line escaped."""
    return (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _url(header: str) -> str:
    return header.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _capture(page_id: int, url: str | None, payload: bytes, first_id: int | None, first_url: str, place: str) -> Iterator[bytes]:
    """The three records of one capture; ``first_id`` is set for revisits."""

    def identifier(kind: str) -> str:
        return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{kind} {page_id} {place}'.encode()).digest())}>"

    target, main = {"WARC-Target-URI": _header_safe(url)}, identifier("main")
    concurrent = {"WARC-Concurrent-To": main}
    request = f"GET {_header_safe(url)} HTTP/1.1\r\n\r\n".encode()
    yield _record("request", identifier("request"), target | concurrent | {"Content-Type": "application/http; msgtype=request"}, request)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = target | {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{digest(payload)}"}
    if first_id is None:
        yield _record("response", main, headers, http + payload)
    else:
        headers |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To-Target-URI": _header_safe(first_url),
            "WARC-Refers-To-Date": DATE,
            "X-Refers-To-Page": str(first_id),
        }
        yield _record("revisit", main, headers, http)
    fields = b"" if page_id == NO_ID else f"page: {page_id}\r\n".encode()
    yield _record("metadata", identifier("metadata"), target | concurrent | {"Content-Type": "application/warc-fields"}, fields)


def _with_firsts(pages: DataFrame, least_bytes: int, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """id, url, payload and, for pages that revisit another, first (id, url)."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    source = pages.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")
    )
    keyed = source.withColumn("key", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= least_bytes
    firsts = (
        keyed.filter(long_enough)
        .groupBy("key")
        .agg(F.min(F.struct("id", F.coalesce("url", F.lit("")).alias("url"))).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", "first")
    )
    joined = keyed.join(firsts, "key", "left")
    other = long_enough & (F.col("first.id") < F.col("id"))
    return joined.select(
        "id", "url", "payload", F.when(other, F.col("first.id")).alias("first_id"), F.when(other, F.col("first.url")).alias("first_url")
    )


def write(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Archives under ``folder``; returns the stored manifest (file, n_records, n_bytes)."""
    source = _with_firsts(pages, least_bytes, id_col, url_col, payload_col)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, row = TaskContext.get().partitionId(), None, None
        system, root = opened(folder)

        def finished() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()})

        for batch in batches:
            columns = [batch.column(c) for c in ("id", "url", "payload", "first_id", "first_url")]
            for values in zip(*columns):
                if out is None:
                    system.create_dir(root, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, row = system.open_output_stream(f"{root}/{name}", compression=None), {"file": f"{folder}/{name}", "n_records": 0, "n_bytes": 0}
                for record in _capture(*(v.as_py() for v in values), place=f"{row['file']} {row['n_records']}"):
                    member = gzip.compress(record, LEVEL, mtime=0)
                    out.write(member)
                    row["n_records"] += 1
                    row["n_bytes"] += len(member)
                if row["n_bytes"] >= ARCHIVE_BYTES:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return stored(source.mapInArrow(archive, "file string, n_records long, n_bytes long"), "archives")


def _members(uri: str) -> Iterator[bytes]:
    """The records of one archive, one gzip member each."""
    system, path = opened(uri)
    with system.open_input_stream(path, compression=None) as file:
        data = file.read(1 << 20)
        while data:
            member, parts = zlib.decompressobj(wbits=31), []
            while not member.eof:
                if not data and not (data := file.read(1 << 20)):
                    raise ValueError(f"{uri} ends within a record")
                parts.append(member.decompress(data))
                data = member.unused_data
            yield b"".join(parts)
            data = data or file.read(1 << 20)


def _headers(lines: bytes) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines.decode().split("\r\n")[1:])}


def _parsed(record: bytes) -> tuple:
    """kind, record id, concurrent-to, URL, payload bytes, declared and found digest, refers-to page, page, payload."""
    head, _, rest = record.partition(END)
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    kind = warc["warc-type"]
    length = found = page = payload = None
    if kind in ("response", "revisit"):
        http, _, body = block.partition(END)
        length = int(_headers(http)["content-length"])
        if kind == "response":
            payload, found = body, digest(body)
    elif kind == "metadata":
        fields = dict(line.split(": ", 1) for line in block.decode().split("\r\n") if ": " in line)
        page = int(fields["page"]) if "page" in fields else None
    refers = warc.get("x-refers-to-page")
    return (
        kind,
        warc["warc-record-id"],
        warc.get("warc-concurrent-to"),
        _url(warc["warc-target-uri"]),
        length,
        warc.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        found,
        int(refers) if refers else None,
        page,
        payload,
    )


RECORD = """kind string, record_id string, concurrent_to string, url string, payload_bytes long, payload_digest string,
    found_digest string, refers_to long, page_id long, payload binary"""


def records(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every record of the listed archives, an archive per task."""
    files = manifest.select("file").repartition(max(1, manifest.count()))
    fields = [f.split() for f in RECORD.replace("\n", " ").split(",")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                rows, size = [], 0
                for record in _members(uri):
                    rows.append(_parsed(record))
                    size += len(record)
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return files.mapInArrow(read, RECORD)


def captures(found: DataFrame) -> DataFrame:
    """One nested row per response or revisit: url, response, request and metadata.

    Where several requests or metadata records name the same capture, the one with the smallest
    record id is shown and their number given; where none does, the field is null.
    """
    shown = [c for c in ("kind", "payload_bytes", "payload_digest", "found_digest", "refers_to", "payload") if c in found.columns]
    mains = found.filter("kind in ('response', 'revisit')")
    main = mains.select("record_id", "url", F.struct(*shown).alias("response"))

    def beside(kind: str, *columns: str) -> DataFrame:
        some = found.filter((F.col("kind") == kind) & F.col("concurrent_to").isNotNull())
        first = F.min(F.struct("record_id", *columns)).alias(kind)
        return some.groupBy(F.col("concurrent_to").alias("record_id")).agg(first, F.count("*").alias(f"n_{kind}"))

    joined = main.join(beside("request", "url"), "record_id", "left").join(beside("metadata", "page_id"), "record_id", "left")
    counts = [F.coalesce(f"n_{kind}", F.lit(0)).alias(f"n_{kind}") for kind in ("request", "metadata")]
    return joined.select("record_id", "url", "response", "request", "metadata", *counts)


def round_trip(
    pages: DataFrame,
    least_bytes: int = 0,
    with_payload: bool = True,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Writes the archives to the shared folder, reads each once and assembles the captures."""
    spark = pages.sparkSession
    manifest = write(pages, shared_folder(spark, "warc"), least_bytes, id_col, url_col, payload_col)
    found = records(spark, manifest)
    return captures(stored(found if with_payload else found.drop("payload"), "warc-records"))
