"""WARC archives: a writer for pages and a sequential reader.

Every record is one gzip member. A page's record is a ``response`` whose block is an HTTP response
header and the html in UTF-8. Of pages with equal payloads of at least ``min_revisit`` bytes the one
with the largest page_id is the response; the others become ``revisit`` records (profile
identical-payload-digest), which hold only the HTTP header, the payload digest and a reference.

Archives are written by the tasks that hold the pages, in files of about ``archive_bytes``, below a
folder that all executors share. A file's name is unique to the task attempt, and the manifest that
the tasks return is checkpointed, so files of lost or repeated attempts are never read.

The reader takes a manifest, opens each archive as a stream, and inflates it piece by piece: a
member's head is parsed as soon as it is complete, the block is framed by Content-Length, both
digests are verified, and the member must end where the record does. One record is held at a time.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut, shuffle_width

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Capture time written to every record: archives of equal pages are equal byte for byte.
CAPTURED = "2024-01-01T00:00:00Z"
PIECE = 1 << 16


class CorruptRecord(ValueError):
    """A record whose framing or digest does not hold."""


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system and the path in it, for a local path or any URI that pyarrow can open."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), urllib.parse.unquote(urllib.parse.urlparse(uri).path)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    number = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def build_record(page_id: int | None, url: str | None, payload: bytes, revisits: bool, refers_to: int | None) -> bytes:
    """One gzip member. Control characters and blanks of the url are percent-encoded; a null url is left out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisits else http + payload
    head = {"WARC-Type": "revisit" if revisits else "response", "WARC-Record-ID": _record_id(page_id), "WARC-Date": CAPTURED}
    if url is not None:
        head["WARC-Target-URI"] = "".join(urllib.parse.quote(c) if c <= " " or c == "\x7f" else c for c in url)
    if revisits:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(refers_to)}
    head |= {
        "WARC-Payload-Digest": _digest(payload), "WARC-Block-Digest": _digest(block),
        "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block)),
    }
    raw = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw.encode("utf-8", "surrogatepass")) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _finish(fields: dict[str, str], block: bytes) -> dict:
    if fields.get("warc-block-digest", _digest(block)) != _digest(block):
        raise CorruptRecord(f"block digest of {fields.get('warc-record-id')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    said = fields["warc-payload-digest"]
    if fields["warc-type"] == "response" and said != _digest(payload):
        raise CorruptRecord(f"payload digest of {fields.get('warc-record-id')}")
    return {
        "page_id": _page_id(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"], "payload_bytes": int(_fields(http)["content-length"]),
        "payload_digest": base64.b32decode(said.removeprefix("sha1:")).hex(),
        "refers_to": _page_id(fields.get("warc-refers-to")),
        "payload": payload if fields["warc-type"] == "response" else None,
    }


def read_records(stream: BinaryIO) -> Iterator[dict]:
    """The records of one archive, in order, inflating a piece at a time."""
    pending, at_end = b"", False
    while True:
        inflate, head, body = zlib.decompressobj(31), None, bytearray()
        while not inflate.eof:
            if not pending and not at_end:
                pending = stream.read(PIECE)
                at_end = not pending
            if not pending:
                if body or head:
                    raise CorruptRecord("the archive ends inside a record")
                return
            body += inflate.decompress(pending)
            pending = inflate.unused_data
            if head is None and (cut_at := body.find(b"\r\n\r\n")) >= 0:
                if not body.startswith(b"WARC/1."):
                    raise CorruptRecord("no WARC version line")
                head = _fields(bytes(body[:cut_at]))
                del body[: cut_at + 4]
                if not head.get("content-length", "").isdigit():
                    raise CorruptRecord(f"no length in {head.get('warc-record-id')}")
            if head is not None and len(body) > int(head["content-length"]) + 4:
                raise CorruptRecord(f"more than its length in {head.get('warc-record-id')}")
        if head is None or len(body) != int(head["content-length"]) + 4 or body[-4:] != b"\r\n\r\n":
            raise CorruptRecord("a member does not hold one whole record")
        yield _finish(head, bytes(body[:-4]))


def plan_records(pages: DataFrame, page_id: str, url: str, html: str, min_revisit: int) -> DataFrame:
    """(page_id, url, payload, revisits, refers_to), one row per page."""
    payload = F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("sha"), F.octet_length(payload).alias("bytes"))
    firsts = (
        rows.filter(F.col("bytes") >= min_revisit).groupBy("sha", "bytes")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(F.col("sha").alias("sha2"), F.col("bytes").alias("bytes2"), "first")
    )
    joined = rows.join(firsts, (F.col("sha") == F.col("sha2")) & (F.col("bytes") == F.col("bytes2")), "left")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", revisits.alias("revisits"),
                         F.when(revisits, F.col("first")).alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_revisit: int = 1000, archive_bytes: int = 8 << 20,
) -> DataFrame:
    """Write the archives below ``folder``; the checkpointed manifest (path, records, bytes)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        out, name, n, size = None, "", 0, 0
        for pdf in parts:
            done = []
            refers = [None if x is None or x != x else int(x) for x in pdf["refers_to"].astype(object)]
            ids = [None if x is None or x != x else int(x) for x in pdf["page_id"].astype(object)]
            for i, link, payload, again, to in zip(ids, pdf["url"], pdf["payload"], pdf["revisits"], refers, strict=True):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                member = build_record(i, link if isinstance(link, str) else None, bytes(payload), bool(again), to)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    done.append((name, n, size))
                    out = None
            if done:
                yield pd.DataFrame(done, columns=["name", "records", "bytes"])
        if out is not None:
            out.close()
            yield pd.DataFrame([(name, n, size)], columns=["name", "records", "bytes"])

    rows = plan_records(pages, page_id, url, html, min_revisit)
    rows = rows.withColumn("page_id", F.col("page_id").cast("decimal(20,0)")).withColumn(
        "refers_to", F.col("refers_to").cast("decimal(20,0)"))  # pandas would turn nullable longs into floats
    written = rows.mapInPandas(run, "name string, records long, bytes long")
    return cut(written.select(F.concat(F.lit(folder.rstrip("/") + "/"), "name").alias("path"), "records", "bytes"))


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives in ``manifest`` (path), each archive read by one task as a stream.

    Columns: page_id, url, record_type, payload_bytes and payload_digest (hex SHA-1) of the full
    payload, refers_to, and payload (null for revisits, and everywhere if not ``payloads``). A record
    whose framing or digest does not hold raises CorruptRecord.
    """
    import pyarrow as pa

    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path in part.column("path").to_pylist():
                fs, place = open_folder(path)
                with fs.open_input_stream(place, compression=None) as stream:
                    held, size = [], 0
                    for record in read_records(stream):
                        if not payloads:
                            record["payload"] = None
                        held.append(record)
                        size += len(record["payload"] or b"") + 200
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    spread = manifest.select("path").repartition(shuffle_width(manifest.sparkSession), "path")
    return spread.mapInArrow(run, RECORD)


def archive_round_trip(pages: DataFrame, **names: str | int) -> DataFrame:
    """Write ``pages`` to archives in the shared scratch folder and read them back.

    A null html is an empty payload, a null url has no target header, a null page_id counts as
    smaller than any other. Of exact repeats of the page with the largest id each is a response. An
    empty table writes no archive and gives an empty result.
    """
    folder = scratch_path(pages.sparkSession, f"weeklens-warc/{uuid.uuid4().hex}")
    return read_archives(write_archives(pages, folder, **names), payloads=False)
