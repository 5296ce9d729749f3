"""Content-addressed WARC archive.

``write_archive`` stores every payload once, under its SHA-256, and a header block
per record in a second table; ``records`` reads both back, verifies each payload
against its digest, and rebuilds the records by a join on the digest.  Of records
with equal payloads (of at least ``least`` bytes) the one with the largest page id
is the response and the others revisit it; smaller payloads are all responses.

Scale: payload bytes are shuffled once, with map-side aggregation, so a payload that
a third of all pages share leaves each task once; headers and digests are narrow
and their joins are ordinary equi-joins, which adaptive execution splits when skewed.
Digests are computed per stored payload, not per record.

Defined cases: a null payload is empty; rows with equal payload and equal page id are
all responses if that id is the group's largest; null page ids count as smaller than any other and,
in a group of nulls only, are responses; a null address gives no WARC-Target-URI;
line breaks in addresses are percent-encoded; other columns are ignored.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import column, materialise, new_folder, read_table, write_file

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in bare upper-case base32: five hexadecimal digits give four characters."""
    h = F.sha1(payload)
    out = []
    for g in range(8):
        v = F.conv(F.substring(h, 5 * g + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(_ALPHABET), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def write_archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> tuple[DataFrame, DataFrame]:
    """(payloads: digest, payload; headers: digest, seq columns and header) as written tables."""
    data = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), data.alias("payload"))
    newest = F.max(F.struct("page_id", "url")).alias("newest")
    digest = F.sha2("payload", 256).alias("digest")
    store = rows.select("page_id", "url", "payload", digest).groupBy("digest").agg(newest, F.any_value("payload").alias("payload"), F.min(F.crc32("payload")).alias("c0"), F.max(F.crc32("payload")).alias("c1"))
    # Equal strong digests with unequal checksums would be a collision: the write must stop.
    store = store.select("digest", "newest", F.when(F.col("c0") == F.col("c1"), F.col("payload")).otherwise(F.raise_error(F.lit("digest collision")).cast("binary")).alias("payload"))
    store = materialise(store, "warc-payloads")
    meta = store.select("digest", "newest", F.octet_length("payload").alias("bytes"), base32_sha1(F.col("payload")).alias("sha1"))
    known = rows.select("page_id", "url", digest).join(meta, "digest")
    return store.select("digest", "payload"), materialise(known.select("digest", _header(least).alias("header")), "warc-headers")


def _record_id(page: Column, url: Column) -> Column:
    """Of page, address and payload: pages that share an id have records of their own."""
    h = F.md5(F.concat_ws("\u0001", F.lit("page"), F.coalesce(page.cast("string"), F.lit("-")), F.coalesce(url, F.lit("-")), F.col("digest")))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _header(least: int) -> Column:
    revisit = F.coalesce((F.col("bytes") >= least) & F.col("newest.page_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest.page_id")), F.lit(False))
    address = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("url"))),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), address),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("newest.page_id"), F.col("newest.url")))),
        F.concat(F.lit("X-Page-ID: "), F.col("page_id").cast("string")),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page-ID: "), F.col("newest.page_id").cast("string"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    ]
    return F.concat(F.array_join(F.array_compact(F.array(*lines)), "\r\n"), F.lit("\r\n\r\n"))


def field(name: str, header: str = "header") -> Column:
    """A named field of a header block, null where absent."""
    return F.nullif(F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def verified(payloads: DataFrame) -> DataFrame:
    """digest, payload, payload_bytes, payload_digest of stored payloads, each held against its digest."""
    right = F.when(F.sha2("payload", 256) == F.col("digest"), F.octet_length("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("int"))
    return payloads.select("digest", "payload", right.cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))


def records(payloads: DataFrame, headers: DataFrame) -> DataFrame:
    """header, payload with its size and SHA-1, and the exact bytes of every original record."""
    # Digests are taken of stored payloads, before the join gives them to every record.
    whole = headers.join(verified(payloads), "digest")
    body = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return whole.select("header", "payload", "payload_bytes", "payload_digest", F.concat(F.col("header").cast("binary"), body, F.lit(b"\r\n\r\n")).alias("record"))


def export_warc(payloads: DataFrame, headers: DataFrame, folder: str) -> DataFrame:
    """Writes ``.warc.gz`` files (a gzip member per record), one per partition; returns path and records."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path, n = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", [0]

        def members():
            for b in it:
                for r in column(b, "record"):
                    n[0] += 1
                    yield gzip.compress(r.as_py(), mtime=0)

        write_file(path, members())
        yield pa.record_batch({"path": [path], "records": pa.array(n, pa.int64())})

    return records(payloads, headers).select("record").mapInArrow(run, "path string, records long")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """header (string) and block (binary) of every record of ``.warc`` and ``.warc.gz`` files."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for name, content in zip(column(b, "path").to_pylist(), column(b, "content")):
                raw = io.BytesIO(content.as_py())
                f = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw
                while line := f.readline():
                    head = [line]
                    while (line := f.readline()) not in (b"\r\n", b""):
                        head.append(line)
                    text = b"".join(head).decode() + "\r\n"
                    size = next(int(x.split(b":")[1]) for x in head if x.lower().startswith(b"content-length:"))
                    block = f.read(size)
                    f.read(4)
                    yield pa.record_batch({"header": [text], "block": pa.array([block], pa.binary())})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "header string, block binary")


def op3(spark, sf_dir: str) -> DataFrame:
    """Contract query over all of ``pages``: every column comes from a rebuilt record."""
    back = records(*write_archive(read_table(spark, sf_dir, "pages")))
    # The header as it stands in the record's own bytes.
    back = back.select(F.substring("record", F.lit(1), F.octet_length("header")).cast("string").alias("header"), "payload_bytes", "payload_digest", F.octet_length("record").alias("size"), F.octet_length("header").alias("skip"))
    told = F.when(field("WARC-Type") == "revisit", F.lit(0)).otherwise(F.col("payload_bytes"))
    whole = (F.col("size") == F.col("skip") + told + 4) & (field("Content-Length").cast("long") == told) & (field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest")))
    right = F.when(whole, F.col("payload_digest")).otherwise(F.raise_error(F.lit("record, header and payload disagree")).cast("string"))
    return back.select(field("X-Page-ID").cast("long").alias("page_id"), "payload_bytes", right.alias("payload_digest"), field("WARC-Type").alias("record_type"), field("X-Refers-To-Page-ID").cast("long").alias("refers_to"))


SQL = """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
d as (select page_id, octet_length(body) as n, sha256(body) as k, sha1(body) as h from p),
g as (select k, max(page_id) as newest from d group by k)
select page_id, cast(n as bigint) as payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast(('0x' || substr(h, 5 * (i // 4) + 1, 5)) as integer) >> (15 - 5 * (i % 4))) & 31 as integer) + 1, 1) for i in range(0, 32)], '') as payload_digest,
       case when newest is null or page_id = newest then 'response' else 'revisit' end as record_type,
       case when page_id = newest then null else newest end as refers_to
from d join g using (k)
"""
