"""Web archives: write transactions as WARC records, read archives back, assemble captures."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soundlake.operators.lineage import cut

CRLF = "\r\n"
#: Fixed values of the format.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records in one archive file, three for each capture.
RECORDS_PER_FILE = 3 * 4096
RECORD = (
    "warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, head string, body string, "
    "payload binary, payload_bytes long, payload_digest string, digest_matches boolean"
)


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, from JVM functions: 20 bits, hence four letters, at a time."""
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(F.sha1(data), 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, 1) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def _uuid(name: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(name), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def transactions(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Every page with payload, its size and digest, record type and the response it revisits.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is the response (all of them, where several rows
    have that id); the others revisit it. Only digests are shuffled: groups of two and more are written first, so that the planner knows
    their size when it joins them with the pages.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": sha1_base32(F.col("payload").cast("binary"))})
    groups = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
    shared = cut(groups.agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "shared")
    rows = rows.join(shared, ["payload_digest", "payload_bytes"], "left")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    name = lambda c: _uuid(F.concat_ws("/", F.coalesce(F.col(c).cast("string"), F.lit("null")), "payload_digest"))
    return rows.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        name("page_id").alias("record_id"), F.when(again, name("last")).alias("refers_to"),
    )


def _record(kind: Column | str, record_id: Column, block: Column, mime: str, extra: list[Column], date: str) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {date}"), *extra]
    lines += [F.lit(f"Content-Type: {mime}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def write_archives(captures: DataFrame, path: str, date: str = "2025-01-01T00:00:00Z", per_file: int = RECORDS_PER_FILE) -> None:
    """Write the rows of :func:`transactions` as gzip-compressed WARC 1.1 files: response or revisit, request and metadata for each.

    A record ends with two line breaks; they are the line separator of Spark's text sink, whose commit protocol keeps the output whole when executors
    are lost, on any file system. Control characters in URLs are percent-encoded, since a header is one line.
    """
    url = F.coalesce("url", F.lit(""))
    for code in (10, 13):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    uri = F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url))
    near = F.concat(F.lit("WARC-Concurrent-To: "), F.col("record_id"))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF)
    )
    first = F.col("record_type") == "response"
    answer = _record(
        F.col("record_type"), F.col("record_id"), F.when(first, F.concat(head, F.col("payload"))).otherwise(head), "application/http;msgtype=response",
        [uri, F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")), F.when(~first, F.lit(f"WARC-Profile: {_REVISIT}")),
         F.concat(F.lit("WARC-Refers-To: "), F.col("refers_to"))], date,
    )
    own = lambda what: _uuid(F.concat(F.lit(f"{what}/"), F.col("record_id")))
    asked = F.concat(F.lit("GET "), url, F.lit(f" HTTP/1.1{CRLF}{CRLF}"))
    request = _record("request", own("request"), asked, "application/http;msgtype=request", [uri, near], date)
    notes = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF))
    metadata = _record("metadata", own("metadata"), notes, "application/warc-fields", [uri, near], date)
    rows = captures.select(F.explode(F.array(answer, request, metadata)).alias("value"))
    rows.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _parse(stream, payloads: bool) -> Iterator[tuple]:
    """Records of one archive, block by block; a record is read by its Content-Length, whatever bytes the block has."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"no WARC record: {line[:40]!r}")
            continue
        fields = {}
        while (line := stream.readline().strip()):
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        kind, declared = fields.get("warc-type"), fields.get("warc-payload-digest", "").partition(":")[2] or None
        head, body, payload, size, digest = None, None, None, None, declared
        if kind in ("response", "revisit"):
            top, _, payload = block.partition(b"\r\n\r\n")
            head = top.decode("utf-8", "replace")
            size = next((int(x.partition(":")[2]) for x in head.split(CRLF) if x.lower().startswith("content-length:")), None)
            if kind == "response":
                size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
            else:
                payload = None
        else:
            body = block.decode("utf-8", "replace")
        near, back = fields.get("warc-concurrent-to"), fields.get("warc-refers-to")
        same = None if declared is None else declared == digest
        yield kind, fields.get("warc-record-id"), near, back, fields.get("warc-target-uri"), fields.get("warc-date"), head, body, payload if payloads else None, size, digest, same


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of all archives under ``path``, compressed or not. Sizes and digests of responses are those of the payload read, and
    ``digest_matches`` says whether the header agrees; a revisit has them from its headers. Files stream through the parser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(n, {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}.get(k, pa.string())) for n, k in (x.split() for x in RECORD.split(", "))])
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_buffer()
                stream = io.BufferedReader(pa.BufferReader(raw)) if raw[:2].to_pybytes() != b"\x1f\x8b" else io.BufferedReader(gzip.GzipFile(fileobj=pa.BufferReader(raw)), 1 << 20)
                rows, held = [], 0
                for row in _parse(stream, payloads):
                    rows.append(row)
                    held += len(row[8] or b"")
                    if len(rows) >= 5000 or held > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: response (or revisit), request and metadata, joined through WARC-Concurrent-To.

    ``records`` is used three times: cut it first. Captures without request or metadata have null there. Several requests of one response,
    as repeated pages give, are one; a repeated response stays repeated.
    """
    pick = lambda kind, fields: (
        records.where(F.col("warc_type") == kind)
        .groupBy(F.col("concurrent_to").alias("_of"))
        .agg(F.min(F.struct("record_id", *fields)).alias(kind))
    )
    answers = records.where(F.col("warc_type").isin("response", "revisit"))
    answers = answers.select(
        F.col("record_id").alias("capture_id"),
        F.struct("record_id", "warc_type", "target_uri", "date", "refers_to", "head", "payload", "payload_bytes", "payload_digest", "digest_matches").alias("response"),
    )
    found = answers
    for kind in ("request", "metadata"):
        side = pick(kind, ("target_uri", "body"))
        found = found.join(side, found.capture_id == side._of, "left").drop("_of")
    return found


def archive_round_trip(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives under ``path`` and read them back: the captures with page_id and refers_to (a page_id).

    Null html is an empty payload and null urls stay null; pages with null ids are written and revisit like others. Repeated rows give repeated
    captures. Empty input gives no rows. Extra columns are not read.
    """
    write_archives(transactions(pages, min_bytes), path)
    captures = assemble(cut(read_archives(pages.sparkSession, path, payloads=False), "records"))
    number = F.nullif(F.regexp_extract("metadata.body", "page-id: (-?[0-9]*)", 1), F.lit("")).cast(pages.schema["page_id"].dataType)
    captures = cut(captures.withColumn("page_id", number), "captures")
    first = captures.where(F.col("response.warc_type") == "response")
    first = first.select(F.col("capture_id").alias("_first"), F.col("page_id").alias("refers_to")).distinct()
    return captures.join(first, F.col("response.refers_to") == F.col("_first"), "left").drop("_first")
