"""WARC derivatives: metadata and plain-text records linked to their responses.

Each response becomes one ``metadata`` and one ``conversion`` record.  Both name
the response in WARC-Refers-To and keep its target, date and digests; the
metadata record holds the response's WARC and HTTP headers as JSON.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import itertools
import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import shipped, table
from tallywick.llm.html_text import lines

#: fixed values of the format
VERSION = "WARC/1.0"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # names that are URLs


def sha1_digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    """The same for equal parts, so a repeated task writes the same record."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(0).join(map(str, parts)))}>"


def record(headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Headers and blocks of all records of a plain or gzipped file.

    Record lengths are followed, so a block may hold anything; a file cut inside
    a record raises.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    out, stream = [], io.BytesIO(data)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record here")
        headers = {}
        while (line := stream.readline()).strip(b"\r\n"):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        if not line.endswith(b"\n"):
            raise ValueError("the header is cut")
        size = int(headers.get("Content-Length", 0))
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the record is cut")
        out.append((headers, block))
    return out


def response(url: str | None, page: str | None, page_id: object, date: str) -> tuple[dict[str, str], bytes]:
    """A response record for a page that was stored without one."""
    payload = (page or "").encode("utf-8", "surrogatepass")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    target = "".join((url or "").split())
    headers = {
        "WARC-Type": "response",
        "WARC-Record-ID": record_id("response", target, page_id, sha1_digest(payload)),
        "WARC-Target-URI": target,
        "WARC-Date": date,
        "WARC-Payload-Digest": sha1_digest(payload),
        "WARC-Block-Digest": sha1_digest(block),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    return headers, block


def http_parts(block: bytes) -> tuple[str, list[list[str]], bytes]:
    """Status line, header fields in order (repeated ones too) and payload."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        head, _, payload = block.partition(b"\n\n")
    status, *fields = head.decode("utf-8", "replace").splitlines() or [""]
    return status, [[n.strip(), v.strip()] for n, _, v in (f.partition(":") for f in fields) if n.strip()], payload


def derivatives(headers: dict[str, str], block: bytes) -> list[tuple[dict[str, str], bytes]]:
    """The metadata and the conversion record of one response record."""
    source = headers.get("WARC-Record-ID", "")
    status, fields, payload = http_parts(block)
    kind = next((v for n, v in fields if n.lower() == "content-type"), "")
    charset = kind.partition("charset=")[2].split(";")[0].strip(" \"'") or "utf-8"
    try:
        page = payload.decode(charset, "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    text = "\n".join(t for t, *_ in lines(page)[0])
    meta = {"warc": headers, "http": {"status": status, "headers": fields}, "payload": {"digest": sha1_digest(payload), "length": len(payload)}, "text": {"length": len(text)}}
    out = []
    for name, mime, body in (
        ("metadata", "application/json", json.dumps(meta, ensure_ascii=False, sort_keys=True).encode("utf-8", "surrogatepass")),
        ("conversion", "text/plain", text.encode("utf-8", "surrogatepass")),
    ):
        own = {
            "WARC-Type": name,
            "WARC-Record-ID": record_id(name, source),
            "WARC-Refers-To": source,
            "WARC-Target-URI": headers.get("WARC-Target-URI", ""),
            "WARC-Date": headers.get("WARC-Date", ""),
            "WARC-Payload-Digest": headers.get("WARC-Payload-Digest") or sha1_digest(payload),
            "WARC-Block-Digest": sha1_digest(body),
            "Content-Type": mime,
            "Content-Length": str(len(body)),
        }
        out.append((own, body))
    return out


_SCHEMA = pa.schema(
    [("page_id", pa.int64())] + [(n, pa.string()) for n in ("warc_type", "record_id", "refers_to", "target_uri", "warc_date", "payload_digest", "block_digest", "content_type")]
    + [("content_length", pa.int64()), ("record", pa.binary())]
)
RECORDS = "page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, payload_digest string, block_digest string, content_type string, content_length long, record binary"


def _rows(key, made):
    for h, body in made:
        yield (key, h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Target-URI"], h["WARC-Date"], h["WARC-Payload-Digest"], h["WARC-Block-Digest"], h["Content-Type"], len(body), record(h, body))


def _batches(rows, size: int = 500):
    while some := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), _SCHEMA, strict=True)], schema=_SCHEMA)


def derived_from_pages(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Two records per page; missing addresses and pages are empty, equal rows give equal records."""
    shipped(pages.sparkSession)

    def made(batches):
        for batch in batches:
            data = batch.to_pydict()
            rows = (
                row
                for key, url, page in zip(data["page_id"], data["url"], data["html"], strict=True)
                for row in _rows(key, derivatives(*response(url, page, key, date)))
            )
            yield from _batches(iter(rows))

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return chosen.mapInArrow(made, RECORDS)


def derived_from_files(spark, path: str) -> DataFrame:
    """Two records per response in WARC files, one file per task; other records are passed over."""
    shipped(spark)

    def made(batches):
        for batch in batches:
            for data in batch.column("content"):
                rows = (row for h, b in parse(data.as_py()) if h.get("WARC-Type") == "response" for row in _rows(None, derivatives(h, b)))
                yield from _batches(iter(rows))

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(made, RECORDS)


def op10_warc_derivatives(spark, folder: str) -> DataFrame:
    return derived_from_pages(table(spark, folder, "pages"))
