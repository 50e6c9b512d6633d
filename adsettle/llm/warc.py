"""WARC archives: writing with segmentation, reading with segment reassembly.

A record whose block is longer than SEGMENT bytes is written as a first segment and continuation records, which carry
the first one's identifier (WARC-Segment-Origin-ID) and their number; the last one carries the whole block's length.
Reading groups continuation records by that identifier, orders them by number, verifies numbers and length, and decodes
the chunked framing of the HTTP payload. Records in one piece take no part in the grouping and are not shuffled.

Archives are plain text files of Spark's own writer: each row is a record, and the two line ends behind it are the
writer's line separator. They are read by Spark's own reader, which splits files at version lines. (A separator that
began with line ends would follow other line ends, and the reader misses such a one where its buffer ends between them;
the version's first letter stands nowhere else in it.) The writer sees to it that neither a block nor a header holds a
version: a chunk ends within each version of a payload. In foreign
archives a block that does hold it shows as a record whose length is wrong.

Equal payloads of at least LEAST_BYTES bytes are written once, as the response with the largest page_id; the others
become revisit records without payload.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.llm.base import FEW_ROWS, query, table
from adsettle.session import stage, staging_path

#: Bytes of a block that a record holds; the longest tenth or so of pages like the given ones is written in segments.
SEGMENT = 8 * 1024
CHUNK = 1024
#: Segments of a record at most, or somewhat more where a version stands at a cut; longer blocks have longer ones.
SEGMENTS = 64
LEAST_BYTES = 1000

# Fixed values of the formats.
VERSION = "WARC/1.1\r\n"
ENDS = "\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CHUNKED = b"Transfer-Encoding: chunked\r\n"


def chunk(payload: bytes, most: int = CHUNK) -> bytes:
    """Chunked transfer framing. No version of a record stands in it: where the payload has one, a chunk ends."""
    mark = VERSION.strip().encode()
    out, at = [], 0
    while at < len(payload):
        end = min(at + most, len(payload))
        near = payload.find(mark, at, min(end + len(mark), len(payload)))
        if near >= 0:
            end = min(end, near + len(mark) // 2)
        out.append(b"%x\r\n%b\r\n" % (end - at, payload[at:end]))
        at = end
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def unchunk(framed: bytes) -> bytes | None:
    """The payload, or None if the framing is broken. Chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(framed[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if size < 0 or framed[at : at + 2] != b"\r\n":
            return None
        out.append(framed[end + 2 : at])
        at += 2


def cut(block: bytes, most: int = SEGMENT) -> list[bytes]:
    """The block in segments. None but the first begins like a record."""
    if len(block) <= most:
        return [block]
    out, at, version = [], 0, VERSION.encode()
    while at < len(block):
        end = min(at + most, len(block))
        while end < len(block) and block.startswith(version, end):
            end += 1
        out.append(block[at:end])
        at = end
    return out


def header(fields: Iterable[tuple[str, object]]) -> bytes:
    lines = "".join(f"{k}: {line(v)}\r\n" for k, v in fields if v is not None)
    return (VERSION + lines + "\r\n").encode()


def line(value: object) -> str:
    """A header value: one line without a version."""
    return " ".join(str(value).split()).replace("WARC/", "WARC%2F")


def records(row: dict, most: int = SEGMENT) -> Iterator[bytes]:
    """The record of a row, as one or more rows of the archive without the line ends behind them."""
    payload = row["payload"] or b""
    revisit = row["refers_to"] is not None
    block = HTTP + b"\r\n" if revisit else HTTP + CHUNKED + b"\r\n" + chunk(payload)
    own = f"<urn:uuid:{row['uuid']}>"
    common = [("WARC-Target-URI", row["url"]), ("WARC-Date", row["date"])]
    pieces = cut(block, max(most, -(-len(block) // SEGMENTS)))
    for number, piece in enumerate(pieces, 1):
        fields = [("WARC-Type", "continuation" if number > 1 else "revisit" if revisit else "response")]
        fields += [("WARC-Record-ID", own if number == 1 else f"<urn:uuid:{row['uuid']}:{number}>"), *common]
        if number == 1:
            fields += [
                ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
                ("WARC-Payload-Length", row["payload_bytes"]),
                ("WARC-Page-ID", row["page_id"]),
                ("WARC-Refers-To-Page-ID", row["refers_to"]),
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
            ]
        else:
            fields.append(("WARC-Segment-Origin-ID", own))
        if len(pieces) > 1:
            fields.append(("WARC-Segment-Number", number))
            if number == len(pieces):
                fields.append(("WARC-Segment-Total-Length", len(block)))
        fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(piece))]
        yield header(fields) + piece


def decided(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest, refers_to). refers_to is set for those rows of equal payloads of
    at least ``least`` bytes that don't have the largest page_id; rows that share it are all responses, and so is a
    row that has no page_id if no equal one has.

    Only digests that occur twice or more are joined back. They are counted first: a small table of them is broadcast,
    so that the pages stay where they are.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("digest"),
    )
    copies = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    copies = stage(copies, "copies")
    if copies.count() <= FEW_ROWS:  # rows of 40 characters and a number
        copies = F.broadcast(copies)
    other = (F.col("payload_bytes") >= least) & (F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()))
    return rows.join(copies, "digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "digest", F.when(other, F.col("first")).alias("refers_to")
    )


def write_warc(rows: DataFrame, path: str, most: int = SEGMENT) -> None:
    """Rows of ``decided`` as archives below ``path``, a file per task, by Spark's committer."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                # one row at a time: a long record makes a batch of its own
                yield pa.RecordBatch.from_arrays([pa.array(list(records(row, most)), pa.binary())], names=["value"])

    named = rows.withColumn("uuid", F.uuid()).withColumn(
        "date", F.date_format(F.lit("2024-01-01T00:00:00").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    text = named.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    text.write.option("lineSep", ENDS).text(path)


FIELDS = {
    "WARC-Type": "type",
    "WARC-Record-ID": "record_id",
    "WARC-Target-URI": "url",
    "WARC-Payload-Digest": "digest",
    "WARC-Payload-Length": "payload_bytes",
    "WARC-Page-ID": "page_id",
    "WARC-Refers-To-Page-ID": "refers_to",
    "WARC-Segment-Origin-ID": "origin_id",
    "WARC-Segment-Number": "segment",
    "WARC-Segment-Total-Length": "total_length",
    "Content-Length": "length",
}
NUMBERS = {"payload_bytes", "page_id", "refers_to", "segment", "total_length", "length"}
RECORD = ", ".join(f"{f} {'long' if f in NUMBERS else 'string'}" for f in FIELDS.values()) + ", block binary"


def parsed(value: bytes) -> dict | None:
    """A record's known fields and block; None for what is no record. Behind the block, line ends may follow; a block
    that is shorter than its length says is given as it is."""
    head, found, rest = value.partition(ENDS.encode())
    if not found:
        return None
    out: dict = dict.fromkeys(FIELDS.values())
    for text in head.decode(errors="replace").split("\r\n"):
        key, _, content = text.partition(":")
        name = FIELDS.get(key.strip())
        if name:
            content = content.strip()
            out[name] = (int(content) if content.lstrip("-").isdigit() else None) if name in NUMBERS else content
    length = out["length"]
    out["block"] = rest if length is None else rest[:length]
    return out


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``, a row each, segments apart. Large files are split."""
    lines = spark.read.option("lineSep", VERSION).text(path).select(F.col("value").cast("binary"))
    schema = pa.schema(
        [*((f, pa.int64() if f in NUMBERS else pa.string()) for f in FIELDS.values()), ("block", pa.binary())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for r in map(parsed, batch.column(0).to_pylist()) if r]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return lines.mapInArrow(run, RECORD)


def reassembled(found: DataFrame) -> DataFrame:
    """``read_records`` with one row per whole record and ``whole``: whether all of it is there.

    A segmented record is whole if its segments are numbered from 1 without gap, the last one gives the total length,
    and the blocks together have it. A segment that occurs twice counts once. A group holds the segments of a single
    record, so its size is that of one page.
    """
    single = found.filter("segment IS NULL").withColumn("whole", F.octet_length("block") == F.col("length"))
    pieces = found.filter("segment IS NOT NULL").withColumn("origin", F.coalesce("origin_id", "record_id"))
    first = F.col("segment") == 1
    grouped = pieces.groupBy("origin").agg(
        *[F.max(F.when(first, F.col(f))).alias(f) for f in FIELDS.values() if f not in ("segment", "total_length", "length")],
        F.max("total_length").alias("total_length"),
        F.max("segment").alias("segment"),
        F.array_sort(F.collect_set(F.struct("segment", "length", "block"))).alias("parts"),
    )
    blocks = F.transform("parts", lambda x: x["block"])
    block = F.aggregate(blocks, F.lit(b""), lambda a, b: F.concat(a, b))
    numbers = F.transform("parts", lambda x: x["segment"])
    sound = (numbers == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))) & F.forall(
        "parts", lambda x: F.octet_length(x["block"]) == x["length"]
    )
    joined = grouped.withColumn("block", block).withColumn("length", F.octet_length("block").cast("long"))
    whole = joined.withColumn("whole", F.coalesce(sound & (F.col("length") == F.col("total_length")), F.lit(False)))
    return single.unionByName(whole.select(*single.columns))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of the archives below ``path``: page_id, url, record_type, refers_to, digest,
    payload_bytes, payload (null for revisits) and sound: whether the record is whole, its framing intact and its
    payload of the digest it names."""
    whole = reassembled(read_records(spark, path))
    schema = pa.schema([("payload", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = []
            for kind, block in zip(batch.column("type").to_pylist(), batch.column("block").to_pylist()):
                head, _, body = (block or b"").partition(ENDS.encode())
                framed = b"transfer-encoding: chunked" in head.lower()
                payloads.append(None if kind == "revisit" else unchunk(body) if framed else body)
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(payloads, schema[0].type)], names=[*names, "payload"])

    names = ["page_id", "url", "type", "refers_to", "digest", "payload_bytes", "whole"]
    kinds = "page_id long, url string, type string, refers_to long, digest string, payload_bytes long, whole boolean"
    decoded = (
        whole.filter("type IN ('response', 'revisit')").mapInArrow(run, f"{kinds}, payload binary")
        .withColumnRenamed("type", "record_type")
        .withColumn("digest", F.regexp_replace("digest", "^sha1:", ""))
    )
    intact = F.when(F.col("record_type") == "revisit", F.col("refers_to").isNotNull()).otherwise(
        F.coalesce(F.sha1("payload") == F.col("digest"), F.lit(False))
    )
    return decoded.withColumn("sound", F.col("whole") & intact).drop("whole")


def archive(pages: DataFrame, path: str | None = None, most: int = SEGMENT) -> DataFrame:
    """Write every row of (page_id, url, html) to archives and read them back.

    A null html is an empty payload. Null page_ids and urls stay null; line breaks in an address become spaces.
    Repeated rows give a record each. Other columns are not looked at.
    """
    spark = pages.sparkSession
    path = path or staging_path(spark, "warc")
    write_warc(decided(pages), path, most)
    return read_warc(spark, path)


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest FROM p),
    f AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS first FROM d)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
        CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN first <> page_id THEN first END AS refers_to, true AS sound
    FROM f
    """
)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through archives and back. What the payload itself shows is taken from it, not from the header."""
    found = archive(table(spark, sf_dir, "pages"))
    there = F.col("payload").isNotNull()
    return found.select(
        "page_id",
        F.when(there, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(there, F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "sound",
    )
