"""WARC archives: writing with revisits and segments, and reading back with reassembly.

Writing: payloads with equal digests are kept once (the largest page_id is the response,
the others revisit it); a record's block is the HTTP message in chunked
transfer framing; blocks over ``segment`` bytes are cut into a first record and
continuation records. One row is one record and Spark's text writer puts the
records' closing line ends between them, so the files are WARC archives as they
stand (gzip), written by its commit protocol.

Reading: archives are parsed by file; unsegmented records are decoded on the
spot. Segments alone are shuffled, grouped by the identifier of their first
record, ordered by number, checked against the total length, joined and
decoded. A group is one page.

Defined cases: null html is an empty payload; a null page_id never is the
response of others, and refers to their response where there is one; repeated rows with the
response's page_id are responses too; empty tables give no rows. Missing,
repeated or short segments, and wrong digests or framing, raise.
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

from tidemark.llm._common import small_batches
from tidemark.session import checkpoint_dir, materialize

SEGMENT = 32 << 10          # bytes of a record's block
CHUNK = 8 << 10             # bytes of a transfer chunk
RECORDS_PER_FILE = 2000     # bounds an archive, which a task reads whole
MIN_REVISIT = 0             # payload bytes from which copies are revisits
CLOSE = "\r\n\r\n"          # after every record
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:page:"

RESULT = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "url string, payload binary")
PARSED = RESULT + ", origin string, segment long, total long, block binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are allowed."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a transfer chunk doesn't end where its size says")
        out.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None] + [f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def page_records(page_id: int | None, serial: int, url: str | None, payload: bytes, refers_to: int | None,
                 revisit: bool, segment: int = SEGMENT) -> list[bytes]:
    """The records of one page, without the line ends that close them."""
    name = f"<{PAGE}{'' if page_id is None else page_id}:{serial}>"
    common = [("WARC-Date", "2024-01-01T00:00:00Z"),
              ("WARC-Target-URI", None if url is None else "".join(url.splitlines())),
              ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common, ("WARC-Profile", PROFILE),
                         ("WARC-Refers-To", f"<{PAGE}{refers_to}>"),
                         ("Content-Type", "application/http; msgtype=response")],
                        http + b"Content-Length: %d\r\n\r\n" % len(payload))]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i:i + segment] for i in range(0, len(block), segment)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common,
             ("Content-Type", "application/http; msgtype=response"),
             ("WARC-Segment-Number", 1 if len(parts) > 1 else None)]
    return [_record(first, parts[0])] + [
        _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{n}>"), ("WARC-Date", common[0][1]),
                 ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", n),
                 ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None)], part)
        for n, part in enumerate(parts[1:], 2)]


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, segment: int = SEGMENT) -> None:
    """Write a record for every page below ``path``."""
    small_batches(pages.sparkSession, 200)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # the response of each digest that more than one page has; digests are combined before the shuffle
    kept = (rows.where(F.octet_length("payload") >= min_revisit).groupBy(F.col("digest").alias("_digest"))
            .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    rows = (rows.join(kept, F.col("digest") == F.col("_digest"), "left")
            .withColumn("revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("kept")) & F.col("kept").isNotNull(),
                                              F.lit(False)))
            .select("page_id", F.monotonically_increasing_id().alias("serial"), "url", "payload", "kept", "revisit"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [r for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                   for r in page_records(*row, segment)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    (rows.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", CLOSE).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
     .text(path))


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:end].split(b"\r\n")
        if version != VERSION:
            raise ValueError(f"a record begins with {version[:20]!r}")
        fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.decode().partition(":") for x in lines))
        size = int(fields["content-length"])
        block = archive[end + 4:end + 4 + size]
        if len(block) < size or archive[end + 4 + size:end + 8 + size] != CLOSE.encode():
            raise ValueError("a record doesn't end where its length says")
        yield fields, block
        at = end + 8 + size


def _page(urn: str) -> int | None:
    number = urn.strip("<>").removeprefix(PAGE).split(":")[0]
    return int(number) if number else None


def response_row(fields: dict[str, str], block: bytes) -> tuple:
    """The result of a whole response or revisit record."""
    head, _, body = block.partition(b"\r\n\r\n")
    http = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    page, url = _page(fields["warc-record-id"]), fields.get("warc-target-uri")
    if fields["warc-type"] == "revisit":
        return page, int(http[b"content-length"]), digest, "revisit", _page(fields["warc-refers-to"]), url, None
    payload = dechunked(body) if http.get(b"transfer-encoding", b"").lower() == b"chunked" else body
    if base32_sha1(payload) != digest:
        raise ValueError(f"payload of page {page} doesn't have its digest")
    return page, len(payload), digest, "response", None, url, payload


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else ([],) * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_RESULT = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                     ("payload", pa.binary())])
_PARSED = pa.schema([*_RESULT, ("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()),
                     ("block", pa.binary())])


def reassembled(parts: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of segments (number, total length or None, bytes) in any order."""
    parts = sorted(parts, key=lambda x: x[0])
    block = b"".join(x[2] for x in parts)
    if [x[0] for x in parts] != list(range(1, len(parts) + 1)) or parts[-1][1] != len(block):
        raise ValueError("segments are missing, repeated or short")
    return block


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per page of the archives below ``path`` (payload null in revisits, or if not wanted)."""
    small_batches(spark, 1)  # a row is an archive here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows = []
                for fields, block in parse(zlib.decompress(archive, wbits=31) if archive[:2] == b"\x1f\x8b" else archive):
                    if "warc-segment-number" not in fields:
                        row = response_row(fields, block)
                        rows.append((*(row if payloads else (*row[:-1], None)), None, None, None, None))
                        continue
                    first = fields["warc-type"] != "continuation"
                    total = fields.get("warc-segment-total-length")
                    head = (_page(fields["warc-record-id"]), None, fields["warc-payload-digest"], "response", None,
                            fields.get("warc-target-uri"), None) if first else (None,) * 7
                    rows.append((*head, fields["warc-record-id" if first else "warc-segment-origin-id"],
                                 int(fields["warc-segment-number"]), int(total) if total else None, block))
                yield from _table(rows, _PARSED).to_batches()

    parsed = materialize(spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, PARSED))
    small_batches(spark, 200)

    def join(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        block = reassembled([(r["segment"], r["total"], r["block"]) for r in rows])
        head = next(r for r in rows if r["segment"] == 1)
        row = response_row({"warc-type": "response", "warc-record-id": head["origin"],
                            "warc-payload-digest": head["payload_digest"],
                            **({} if head["url"] is None else {"warc-target-uri": head["url"]})}, block)
        return _table([row if payloads else (*row[:-1], None)], _RESULT)

    whole = parsed.where("origin is null").select(*[f.name for f in _RESULT])
    return whole.unionByName(parsed.where("origin is not null").groupBy("origin").applyInArrow(join, RESULT))


def round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write the pages' archives into the shared checkpoint folder and read them back."""
    spark = pages.sparkSession
    shared = checkpoint_dir(spark)
    if not shared:
        raise RuntimeError("archives are written to a shared folder: set spark.checkpoint.dir")
    path = f"{shared.rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return read_archives(spark, path, payloads)


def oracle_sql() -> str:
    """What reading the archives of ``pages`` back gives, for DuckDB (without archives)."""
    return f"""
WITH payloads AS (
    SELECT page_id, COALESCE(html, '') AS payload, sha1(COALESCE(html, '')) AS hex,
           CASE WHEN strlen(COALESCE(html, '')) >= {MIN_REVISIT}
                THEN MAX(page_id) OVER (PARTITION BY COALESCE(html, '')) END AS kept
    FROM pages)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
           CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)
           FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < kept THEN kept END AS refers_to
FROM payloads"""
