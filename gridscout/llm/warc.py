"""WARC archives: one gzip member per record, repeated payloads as revisits, and a sequential reader.

A task writes its records to an archive of its own under a hidden name and moves it into place when it
is complete; the manifest names only archives of tasks that ended well. Folders are reached through
Arrow's file systems, so they may be in any store that all executors share. The reader holds one record
at a time: it inflates member by member, frames blocks by Content-Length and verifies the digests.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm.common import stage, unique_texts

LEAST_BYTES = 100
ARCHIVE_BYTES = 512 << 20
CHUNK = 1 << 16
PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, valid boolean"


class WarcError(ValueError):
    pass


# -- one record


def record(page_id: int, url: str | None, payload: bytes, first: int | None, date: str) -> bytes:
    """A response, or a revisit of the response with id `first`, as one gzip member."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if first is None else http
    kind = "response" if first is None else "revisit"
    head = [f"WARC/1.1\r\nWARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url))
    if first is not None:
        head += [f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + deflate.flush()


def members(stream) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one at a time."""
    data = stream.read(CHUNK)
    while data:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not data:
                raise WarcError("the archive ends within a record")
            try:
                parts.append(inflate.decompress(data))
            except zlib.error as e:
                raise WarcError(f"not a gzip member: {e}") from e
            data = inflate.unused_data if inflate.eof else stream.read(CHUNK)
        yield b"".join(parts)
        data = data or stream.read(CHUNK)


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode().split("\r\n")
    return {"": lines[0]} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _page(value: str | None) -> int | None:
    return int(value.removeprefix("<urn:page:").removesuffix(">")) if value else None


def parse(member: bytes) -> dict:
    """The columns of RECORD. `valid`: all digests that can be computed agree."""
    end = member.find(b"\r\n\r\n")
    head = _headers(member[:end]) if end >= 0 else {}
    if not head.get("", "").startswith("WARC/1.") or not head.get("content-length", "").isdigit():
        raise WarcError("not a WARC record")
    begin, size = end + 4, int(head["content-length"])
    block = member[begin : begin + size]
    if member[begin + size :] != b"\r\n\r\n":
        raise WarcError("Content-Length does not frame the block")
    cut = block.find(b"\r\n\r\n")
    http, payload = _headers(block[:cut]), block[cut + 4 :]
    response = head["warc-type"] == "response"
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    valid = head["warc-block-digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
    if response:
        valid = valid and digest == hashlib.sha256(payload).hexdigest() and int(http["content-length"]) == len(payload)
    return {
        "page_id": _page(head["warc-record-id"]),
        "url": head.get("warc-target-uri"),
        "record_type": head["warc-type"],
        "refers_to": _page(head.get("warc-refers-to")),
        "payload_bytes": int(http["content-length"]),
        "payload_digest": digest,
        "payload": payload if response else None,
        "valid": valid,
    }


# -- tables


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record per page to archives in `folder`; returns the manifest (archive, records, bytes).

    Of the records with equal payloads of at least `least_bytes`, the one with the smallest id is the
    response and the others revisit it. Shorter payloads are always responses. The payload is the html
    in UTF-8.

    A null html is an empty payload, a null url leaves the target out; white space and control characters
    of a url are percent-encoded. The smallest id, a whole number, decides, so there are no ties.
    Several rows of one id count as one, see `unique_texts`; rows without an id are left out. An empty
    table writes no archive. Other columns of `pages` play no part, whatever they are called.
    """
    rows = unique_texts(pages, id_col, html_col, url_col).select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload")
    )
    digests = rows.where(F.octet_length("payload") >= least_bytes).select("page_id", F.sha2("payload", 256).alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    revisits = digests.join(firsts, "digest").where("page_id <> first").select("page_id", "first")
    records = rows.join(revisits, "page_id", "left").select("page_id", "url", "payload", "first")
    return stage(records.mapInArrow(_write(_uri(folder), archive_bytes, date), "archive string, records long, bytes long"))


def read_warc(manifest: DataFrame) -> DataFrame:
    """The records of the archives that `manifest` names in its column archive. See RECORD.

    A revisit has no payload; its payload_bytes come from its HTTP header. A record whose digests do not
    agree has valid = false. An archive that is cut off or is no WARC raises WarcError. A null name is
    passed over, an archive named twice is read twice, no names give no rows.
    """
    paths = manifest.select("archive").where("archive IS NOT NULL")
    return paths.repartition(max(1, paths.count())).mapInArrow(_read, RECORD)


def _uri(folder: str) -> str:
    return re.sub(r"^file:/+", "file:///", folder)


def _write(folder: str, archive_bytes: int, date: str):
    def run(batches):
        system, path = pyarrow.fs.FileSystem.from_uri(folder)
        name, out, n, size, done = None, None, 0, 0, []

        def close() -> None:
            out.close()
            system.move(f"{path}/.{name}", f"{path}/{name}")
            done.append((f"{folder}/{name}", n, size))

        for batch in batches:
            for page_id, url, payload, first in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "first")), strict=True):
                if out is None:
                    system.create_dir(path, recursive=True)
                    name, n, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{path}/.{name}", compression=None)
                data = record(page_id.as_py(), url.as_py(), payload.as_py(), first.as_py(), date)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            columns = zip(*done, strict=True)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["archive", "records", "bytes"])

    return run


KINDS = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(), "valid": pa.bool_()}


def _read(batches):
    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in KINDS.items()], list(KINDS))

    for batch in batches:
        for uri in batch.column("archive").to_pylist():
            system, path = pyarrow.fs.FileSystem.from_uri(uri)
            rows, size = [], 0
            with system.open_input_stream(path, compression=None) as stream:
                for member in members(stream):
                    rows.append(parse(member))
                    size += len(member)
                    if size >= 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
            if rows:
                yield batch_of(rows)
