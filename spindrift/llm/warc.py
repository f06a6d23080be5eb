"""WARC archives with revisit records.

Headers are grouped by payload digest, each record is joined with the original response of its digest,
and archives are written anew: the originals in full, all others as revisit records without payload.
"""

from __future__ import annotations

import base64
import functools
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm.common import bitmap, cut, ensure_checkpoint_dir, in_bitmap, join_counted, may_be_in

#: Characters of one archive file before compression; a larger record makes a larger file.
SEGMENT_CHARS = 16 << 20
#: The pages have no time of capture; this one stands in every record.
CAPTURED = "1970-01-01T00:00:00Z"
#: Fixed values of the format.
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def base32_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(page_id: int | None, url: str | None, html: str, payload_bytes: int, sha1_hex: str, original: int | None) -> str:
    """One record without the closing line ends; original: the page whose response has this payload already."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}{END}"
    revisit = original is not None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {CAPTURED}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{base32_digest(sha1_hex)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{original}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else payload_bytes)}"]
    return "\r\n".join(lines) + END + http + ("" if revisit else html)


def headers(pages: DataFrame) -> DataFrame:
    """page_id, url, digest and payload_bytes of every page; no payload."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("payload_bytes"))


def number_of(sha1_hex: str) -> int:
    """The first seven bytes of a digest."""
    return int(sha1_hex[:14], 16)


def resolve(pages: DataFrame, least_bytes: int = 0) -> tuple[DataFrame, np.ndarray]:
    """Headers of pages whose digest may occur more than once, with `original`, and the bitmap of such digests.

    `original` is the smallest page_id with this payload, null in its own rows. Payloads under least_bytes
    have no original. Only headers are shuffled and hot digests are not gathered. Every page whose digest
    is not in the bitmap is a response; the bitmap lets others through too, which here have no original.
    """
    rows = headers(pages)
    groups = cut(rows.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    number = F.conv(F.substring("digest", 1, 14), 16, 10).cast("long").alias("number")
    shared = bitmap(groups.select(number))
    total = groups.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            yield t.filter(pa.array(in_bitmap(shared, np.array([number_of(x) for x in t.column(2).to_pylist()], dtype=np.int64))))

    joined = join_counted(rows.mapInArrow(keep, rows.schema), groups, "digest", "copies", max(1, total), spread=F.xxhash64("page_id", "url").cast("string"))
    return cut(joined.select(*rows.columns, F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("original"))), shared


def pair_of(page_id: Column, digest: Column) -> Column:
    return F.concat_ws(":", digest, F.coalesce(page_id.cast("string"), F.lit("")))


def segments(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Records of all pages, joined to texts of about SEGMENT_CHARS.

    Payloads that occur once are written where they are read. Revisits are written from their headers. Of a
    payload that occurs more often only the rows of its smallest page are moved.
    """
    found, shared = resolve(pages, least_bytes)
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))

    def put(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        size = 0
        for row in rows:
            held.append(record(*row))
            size += len(held[-1])
            if size >= SEGMENT_CHARS:
                yield pa.RecordBatch.from_arrays([pa.array([END.join(held)])], names=["value"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([END.join(held)])], names=["value"])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for t in batches:
                payloads = [x.encode() for x in t.column(2).to_pylist()]
                digests = [hashlib.sha1(x).hexdigest() for x in payloads]
                met = in_bitmap(shared, np.array([number_of(x) for x in digests], dtype=np.int64)).tolist()
                for page_id, url, payload, digest, m in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), payloads, digests, met, strict=True):
                    if not m:
                        yield page_id, url, payload.decode(), len(payload), digest, None

        return put(rows())

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return put(row for t in batches for row in zip(*(c.to_pylist() for c in t.columns), strict=True))

    parts = [full.mapInArrow(alone, "value string")]
    responses = found.where("original IS NULL")
    wanted = bitmap(responses.select("page_id"))
    first = cut(responses.groupBy(pair_of(F.col("page_id"), F.col("digest")).alias("pair")).agg(F.count(F.lit(1)).alias("n")).withColumn("met", F.lit(True)))
    schema = "page_id long, url string, html string, digest string"

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            t = t.filter(pa.array(may_be_in(wanted, t.column(0))))
            digests = [hashlib.sha1(x.encode()).hexdigest() for x in t.column(2).to_pylist()]
            met = in_bitmap(shared, np.array([number_of(x) for x in digests], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*t.columns, pa.array(digests, pa.string())], names=["page_id", "url", "html", "digest"]).filter(pa.array(met))

    moved = full.mapInArrow(candidates, schema).withColumn("pair", pair_of(F.col("page_id"), F.col("digest")))
    kept = join_counted(moved, first, "pair", "n", max(1, found.count()), spread=F.xxhash64("url", F.monotonically_increasing_id()).cast("string")).where("met")
    none = F.lit(None).cast("long")
    parts.append(kept.select("page_id", "url", "html", F.octet_length("html").cast("long").alias("payload_bytes"), "digest", none.alias("original")).mapInArrow(again, "value string"))
    parts.append(found.where("original IS NOT NULL").select("page_id", "url", F.lit("").alias("html"), "payload_bytes", "digest", "original").mapInArrow(again, "value string"))
    return functools.reduce(DataFrame.unionAll, parts)


def write_archives(records: DataFrame, path: str) -> None:
    """Writes .warc files (gzip) of about SEGMENT_CHARS each into a folder; every file is written by one task."""
    records.write.option("lineSep", END).option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields in lower case and block of each record of an archive, compressed or not."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        stop = content.find(b"\r\n\r\n", at)
        if stop < 0:
            raise ValueError("record cut off")
        version, *lines = content[at:stop].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin, size = stop + 4, int(fields["content-length"])
        if begin + size > len(content):
            raise ValueError("record cut off")
        yield fields, content[begin : begin + size]
        at = begin + size + 4


def page_of(uri: str | None) -> int | None:
    number = (uri or "").strip("<>").rpartition(":")[2]
    return int(number) if number else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; sizes and digests of responses are taken from the payload as stored, those of revisits from their headers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for content in t.column(0):
                rows = []
                for fields, block in parse(content.as_py()):  # a task without records leaves an empty file
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind = fields["warc-type"]
                    if kind == "response":
                        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    else:
                        size, digest = int(re.search(rb"(?i)content-length: *([0-9]+)", http)[1]), fields["warc-payload-digest"].removeprefix("sha1:")
                    rows.append((page_of(fields["warc-record-id"]), size, digest, kind, page_of(fields.get("warc-refers-to")), fields.get("warc-target-uri")))
                if not rows:
                    continue
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in READ_SCHEMA.split(", ")])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, READ_SCHEMA)


def deduplicate(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes deduplicated archives of pages and reads them back; one row per page.

    path: where the archives go, by default a new folder in the shared one. A null html is an empty
    payload. Rows that repeat the smallest page_id of a payload are responses too. A null page_id stays
    null and is never the original unless all are null; then all its rows are responses. A payload of any
    length is one record. An empty table gives no rows. Only columns page_id, url and html are read, so
    others may have any names.
    """
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(segments(pages, least_bytes), path)
    return read_archives(spark, path)
