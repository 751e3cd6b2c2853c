"""WARC archives: records written as files, read back, and put together from segments.

Writing makes the records with DataFrame functions: an HTTP response with chunked transfer framing,
cut into a first segment and continuation records where it is long, or a revisit of the response
that has the same payload. Reading takes whole files (whose size is bounded on writing, plain or
gzip), parses them by their declared lengths, groups segments by their origin record, orders them by
number, verifies the total length, and decodes the framing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelane.llm.common import stored

#: Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
CHUNK_BYTES = 8192
SALTS = 16

_RECORD = "type string, record_id string, uri string, page_id long, digest string, refers_to string, origin string, number int, total long, block binary"
_END = b"\r\n"


def _utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def _joined(parts: Column) -> Column:
    """An array of binaries as one, in linear time."""
    return F.unhex(F.array_join(F.transform(parts, lambda x: F.hex(x)), ""))


def chunked(payload: Column, size: int = CHUNK_BYTES) -> Column:
    """A payload in chunked transfer framing."""
    n = F.octet_length(payload)

    def chunk(part: Column) -> Column:
        return F.concat(_utf8(F.concat(F.lower(F.hex(F.octet_length(part).cast("long"))), F.lit("\r\n"))), part, F.lit(_END))

    many = _joined(F.transform(F.sequence(F.lit(0), ((n - 1) / size).cast("int")), lambda i: chunk(F.substring(payload, i * size + 1, F.lit(size)))))
    body = F.when(n == 0, F.lit(b"")).when(n <= size, chunk(payload)).otherwise(many)
    return F.concat(body, F.lit(b"0\r\n\r\n"))


def dechunked(data: bytes) -> bytes:
    """The payload of chunked transfer framing; trailers and chunk extensions are passed over."""
    out, at = [], 0
    while True:
        end = data.index(_END, at)
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if data[at + size : at + size + 2] != _END or len(data) < at + size:
            raise ValueError("a chunk does not end where its size says")
        out.append(data[at : at + size])
        at += size + 2


def write_pages(pages: DataFrame, path: str, *, segment_bytes: int = 32_768, records_per_file: int = 1000) -> None:
    """Archives of ``page_id``, ``url``, ``html`` under ``path``, gzip files of at most ``records_per_file`` records.

    Of pages with equal payloads of at least ``REVISIT_BYTES``, the one with the largest id is a
    response and the others revisit it. A null html is an empty payload, a null url leaves out the
    header. Line ends in a url are percent-encoded. Null ids are never referred to. Other columns
    are not looked at; without pages there are no records.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        _utf8(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    rows = rows.withColumn("uuid", F.md5(_utf8(F.concat_ws("|", F.col("page_id").cast("string"), "digest", "url"))))
    alike = (
        rows.filter((F.octet_length("payload") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
        .groupBy("digest").agg(F.max(F.struct("page_id", "uuid")).alias("kept"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "kept", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    alike = stored(alike, "warc-alike")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(alike, ["digest", "salt"], "left")
    again = F.coalesce((F.octet_length("payload") >= REVISIT_BYTES) & (F.col("page_id") != F.col("kept.page_id")), F.lit(False))
    again = again | F.coalesce(F.col("page_id").isNull() & F.col("kept").isNotNull(), F.lit(False))
    rows = rows.withColumn("again", again)

    http = _utf8(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"))
    rows = rows.withColumn("block", F.when(F.col("again"), http).otherwise(F.concat(http, chunked(F.col("payload")))))
    total = F.octet_length("block")
    cut = F.when(total <= segment_bytes, F.array("block")).otherwise(
        F.transform(F.sequence(F.lit(0), ((total - 1) / segment_bytes).cast("int")), lambda i: F.substring(F.col("block"), i * segment_bytes + 1, F.lit(segment_bytes)))
    )
    rows = rows.withColumns({"total": total, "cut": cut}).select("*", F.posexplode("cut").alias("at", "part"))

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    first, last, many = F.col("at") == 0, F.col("at") == F.size("cut") - 1, F.size("cut") > 1
    origin = F.concat(F.lit("<urn:uuid:"), "uuid", F.lit(">"))
    safe_url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(~first, "continuation").when(F.col("again"), "revisit").otherwise("response")),
        header("WARC-Record-ID", F.when(first, origin).otherwise(F.concat(F.lit("<urn:uuid:"), "uuid", F.lit("-"), F.col("at").cast("string"), F.lit(">")))),
        F.lit("WARC-Date: 2020-01-01T00:00:00Z\r\n"),
        header("WARC-Target-URI", safe_url),
        header("WARC-Page-ID", F.col("page_id")),
        header("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), "digest"))),
        header("WARC-Refers-To", F.when(F.col("again"), F.concat(F.lit("<urn:uuid:"), F.col("kept.uuid"), F.lit(">")))),
        header("WARC-Profile", F.when(F.col("again"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        header("WARC-Segment-Number", F.when(many, F.col("at") + 1)),
        header("WARC-Segment-Origin-ID", F.when(~first, origin)),
        header("WARC-Segment-Total-Length", F.when(many & last, F.col("total"))),
        header("Content-Type", F.when(first, "application/http; msgtype=response")),
        header("Content-Length", F.octet_length("part")),
        F.lit("\r\n"),
    )
    # The writer ends each value with the last byte of the record's end.
    record = F.concat(_utf8(head), "part", F.lit(b"\r\n\r")).cast("string").alias("value")
    rows.select(record).write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record; an archive that breaks off is an error."""
    if data[:2] == b"\x1f\x8b":
        out = []
        while data:  # a member per file or per record
            member = zlib.decompressobj(31)
            out.append(member.decompress(data))
            if not member.eof:
                raise ValueError("a gzip member breaks off")
            data = member.unused_data
        data = b"".join(out)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("a record does not start with its version")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers["content-length"])
        block = data[end + 4 : end + 4 + size]
        if data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, block
        at = end + 8 + size


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of all archives under ``path``, segments by themselves."""
    schema = pa.schema(
        [("type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()),
         ("refers_to", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(headers: dict, name: str) -> int | None:
            return int(headers[name]) if name in headers else None

        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for h, block in parsed(content.as_py()):
                    rows.append(
                        (h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"), whole(h, "warc-page-id"), h.get("warc-payload-digest"),
                         h.get("warc-refers-to"), h.get("warc-segment-origin-id"), whole(h, "warc-segment-number"), whole(h, "warc-segment-total-length"), block)
                    )
                    held += len(block)
                    if held > 1 << 22:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                yield _batch(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(scan, _RECORD)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def reassembled(records: DataFrame) -> DataFrame:
    """Records with their whole blocks, and ``complete``.

    Segments are grouped by the id of their origin record and ordered by number. Numbers must run
    from 1 without a gap and the lengths add up to the total that the last declares; else
    ``complete`` is false and the block null. A record read more than once stays so often.
    """
    alone = records.filter(F.col("number").isNull() & F.col("origin").isNull()).withColumn("complete", F.lit(True))
    parts = records.filter(F.col("number").isNotNull() | F.col("origin").isNotNull())
    parts = parts.withColumn("origin", F.coalesce("origin", "record_id"))
    parts = parts.groupBy("origin", "number").agg(
        F.count("*").alias("copies"), F.max("total").alias("total"), F.first("block").alias("block"),
        *[F.max(F.when(F.col("type") != "continuation", F.col(c))).alias(c) for c in ("type", "record_id", "uri", "page_id", "digest", "refers_to")],
    )
    whole = parts.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("segments"), F.max("total").alias("total"), F.max("copies").alias("copies"),
        *[F.max(c).alias(c) for c in ("type", "record_id", "uri", "page_id", "digest", "refers_to")],
    )
    whole = whole.withColumn("block", _joined(F.col("segments.block"))).withColumn(
        "complete",
        F.coalesce(
            (F.col("segments.number") == F.transform(F.sequence(F.lit(1), F.size("segments")), lambda i: i.cast("int")))
            & (F.octet_length("block") == F.col("total")),
            F.lit(False),
        ),
    )
    whole = whole.withColumn("block", F.when(F.col("complete"), F.col("block")))
    whole = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    names = ["type", "record_id", "uri", "page_id", "digest", "refers_to", "block", "complete"]
    return alone.select(*names).unionByName(whole.select(*names))


def with_payloads(records: DataFrame) -> DataFrame:
    """Adds ``payload``: what follows the HTTP headers, with chunked framing decoded; null for a null block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block in batch["block"]:
                block = block.as_py()
                if block is not None:
                    head, _, body = block.partition(b"\r\n\r\n")
                    coded = any(
                        k.strip().lower() == b"transfer-encoding" and v.strip().lower() == b"chunked"
                        for k, _, v in (x.partition(b":") for x in head.split(_END))
                    )
                    block = dechunked(body) if coded and body else body
                out.append(block)
            keep = batch.drop_columns(["block"])
            yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(out, pa.binary())], [*keep.schema.names, "payload"])

    kinds = "type string, record_id string, uri string, page_id long, digest string, refers_to string, complete boolean, payload binary"
    return records.select("type", "record_id", "uri", "page_id", "digest", "refers_to", "complete", "block").mapInArrow(scan, kinds)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A row per response or revisit: its headers, ``complete`` and its own ``payload`` (empty for a revisit)."""
    return with_payloads(reassembled(read_records(spark, path)))


def resolved(pages: DataFrame) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` of each page read.

    Bytes and digest are those of the payload that was read; a revisit's are those of the response
    it refers to. ``intact`` says whether the digest is the one declared.
    """
    light = pages.select(
        "page_id", "record_id", "type", F.col("refers_to").alias("target"), F.substring("digest", 6, 40).alias("declared"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "complete",
    )
    light = stored(light, "warc-read")
    responses = light.filter("type != 'revisit'")
    revisits = light.filter("type = 'revisit'").drop("payload_bytes", "payload_digest")
    wanted = revisits.select(F.col("target").alias("record_id")).distinct()
    targets = (
        responses.join(wanted, "record_id").groupBy(F.col("record_id").alias("target"))
        .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    revisits = revisits.withColumn("salt", F.pmod(F.xxhash64("page_id", "record_id"), F.lit(SALTS)).cast("int")).join(targets, ["target", "salt"], "left")
    names = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to", (F.col("complete") & (F.col("declared") == F.col("payload_digest"))).alias("intact")]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*names).unionByName(revisits.select(*names))
