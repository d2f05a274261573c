"""WARC archives: a writer with revisit records and a splittable reader.

*Writing*: ids and digests alone settle which pages revisit which: the largest page_id of each digest is
aggregated in parts, and only the revisits' ids go back to the payloads, joined by page. Equal payloads are never
gathered; writing needs payloads moved only if there are many revisits. Each task writes one
``.warc.gz`` file, a gzip member per record; a Parquet list names the files of the tasks that succeeded.

*Reading*: files are cut into byte ranges, one row each. A task looks for the gzip magic in its range,
inflates the start of each candidate and takes it for a record only if a WARC header decodes; it owns
the records that start inside its range and reads on past the range's end to finish the last one. From one
record it goes to the next at the end of its member; where that fails it scans on from there.

Edge cases: a null payload is empty; a null page_id never stands for other pages, and its record has no
page id; rows that share the largest page_id of a payload are all responses; blanks and control
characters in a url are percent-encoded in its header, null ones are left out; a damaged member, one whose
header doesn't parse and one without a type or with a length that is no number are skipped; ids of other
writers are read as null; an empty table gives no file; further columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import commit_file, file_system, materialize, ship_package

MAGIC = b"\x1f\x8b\x08"
RANGE = 32 << 20
_ID = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_PAGE = re.compile(f"<{_ID}(-?[0-9]{{1,19}})>")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: 5 hexadecimal digits make 4 of base 32."""
    h = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, refers_to); refers_to is null for responses."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", payload_digest(F.col("payload")))
    # which pages revisit which is settled on ids and digests alone; payloads then meet the revisits' few bytes
    keys = rows.where(F.length("payload") >= min_bytes).select("page_id", "digest")
    first = keys.where("page_id is not null").groupBy("digest").agg(F.max("page_id").alias("first"))
    again = keys.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    first = materialize(first.join(again, "digest", "left_semi"), folder, "first")
    revisits = keys.join(first, "digest").where("page_id is null or page_id <> first")
    revisits = materialize(revisits.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "first").distinct(), folder, "revisits")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    return rows.join(revisits, same, "left").select("page_id", "url", "payload", "digest", F.col("first").alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    http = _HTTP.format(len(payload)).encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{page_id}>" if page_id is not None else f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def write(pages: DataFrame, folder: str, *, min_bytes: int = 0) -> DataFrame:
    """Write (page_id, url, html) as archives below ``folder``; returns their list (path, bytes, records)."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        n = 0
        uri = f"{folder}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"

        def save(out) -> None:
            nonlocal n
            batch = first
            while batch is not None:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out.write(record(*row))
                n += batch.num_rows
                batch = next(batches, None)

        size = commit_file(uri, save)
        yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], ["path", "bytes", "records"])

    rows = with_revisits(pages, folder, min_bytes)
    return materialize(rows.mapInArrow(run, "path string, bytes long, records long"), folder, "list")


def _inflate(data: bytes, more, limit: int | None = None) -> tuple[bytes, int] | None:
    """(content, bytes used) of the gzip member at the start of ``data``; ``more`` gives further bytes."""
    z, out, used = zlib.decompressobj(31), [], 0
    try:
        while True:
            out.append(z.decompress(data, 0 if limit is None else limit))
            used += len(data) - len(z.unused_data)
            if z.eof:
                return b"".join(out), used
            if limit is not None:
                return b"".join(out), used
            data = more()
            if not data:
                return None
    except zlib.error:
        return None


def parse(content: bytes) -> dict | None:
    """Headers (lower-case names) and payload of one record; None if it is no WARC record."""
    if not content.startswith(b"WARC/1."):
        return None
    head, gap, block = content.partition(b"\r\n\r\n")
    if not gap:
        return None
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]))
    lengths = [fields.get(n, "0") for n in ("content-length", "x-payload-length")]
    if "warc-type" not in fields or not all(n.isascii() and n.isdigit() and len(n) < 19 for n in lengths):
        return None
    if "content-length" in fields:
        block = block[: int(fields["content-length"])]
    fields["payload"] = block.partition(b"\r\n\r\n")[2]
    return fields


def _page(value: str | None) -> int | None:
    found = _PAGE.fullmatch(value or "")
    return int(found[1]) if found and -(2**63) <= int(found[1]) < 2**63 else None


def read_range(uri: str, start: int, end: int, size: int, step: int = 1 << 20) -> Iterator[dict]:
    """Records of a ``.warc.gz`` file that start in bytes [start, end)."""
    fs, path = file_system(uri)
    with fs.open_input_file(path) as f:
        window, base, at = b"", start, start  # window holds the bytes from base on

        def at_least(n: int) -> bytes:
            nonlocal window, base
            if at < base or at + n > base + len(window):
                window, base = f.read_at(min(max(n, step), size - at), at), at
            return window[at - base :]

        while at < end:
            data = at_least(min(len(MAGIC), size - at))
            if not data.startswith(MAGIC):  # scan
                found = data.find(MAGIC, 0, end - at + len(MAGIC) - 1)
                at += found if found >= 0 else max(1, min(len(data), end - at) - (len(MAGIC) - 1 if at + len(data) < size and len(data) >= len(MAGIC) else 0))
                continue
            data = at_least(min(64 << 10, size - at))
            begin = _inflate(data, lambda: b"", 64)
            if not begin or not begin[0].startswith(b"WARC/1."):
                at += 1
                continue
            ahead = at + len(data)

            def more() -> bytes:
                nonlocal ahead
                part = f.read_at(min(step, size - ahead), ahead) if ahead < size else b""
                ahead += len(part)
                return part

            whole = _inflate(data, more)
            found = parse(whole[0]) if whole else None
            if found is None:
                at += 1
                continue
            yield found
            at += whole[1]


def read(archives: DataFrame, *, range_bytes: int = RANGE) -> DataFrame:
    """Records of listed archives (path, bytes): page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload (null for revisits), intact (a response's digest and length fit its payload)."""
    spark = archives.sparkSession
    ship_package(spark)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = archives.where("bytes > 0").select("path", "bytes", starts.alias("start"))
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("intact", pa.bool_())]
        )
        for batch in frames:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                for r in read_range(path, start, min(start + range_bytes, size), size):
                    response = r["warc-type"] == "response"
                    digest, length = r.get("warc-payload-digest", "").removeprefix("sha1:"), int(r.get("x-payload-length", len(r["payload"])))
                    own = base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode() if response else digest
                    rows.append((_page(r.get("warc-record-id")), r.get("warc-target-uri"), r["warc-type"], _page(r.get("warc-refers-to")),
                                 length, digest or own, r["payload"] if response else None, own == digest and (not response or length == len(r["payload"]))))
                    held += len(r["payload"])
                    if held > 8 << 20 or len(rows) >= 5_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return ranges.mapInArrow(
        run,
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, intact boolean",
    )


def sql(min_bytes: int = 0) -> str:
    """What the archives of ``pages`` hold, in DuckDB SQL (there sha1 gives hexadecimal digits)."""
    bits = "(SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(h, 1 + 5 * i, 5))::BIGINT >> (15 - 5 * j)) % 32, 1), '' ORDER BY i, j) FROM range(8) a(i), range(4) b(j))"
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, {bits} AS payload_digest,
  CASE WHEN payload_bytes >= {min_bytes} AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {min_bytes} AND page_id IS DISTINCT FROM first THEN first END AS refers_to, true AS intact FROM m"""
