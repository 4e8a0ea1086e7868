"""A content-addressed WARC archive.

``store`` keeps two tables in the shared folder: ``payloads`` holds the bytes of each distinct
payload once under its SHA-256, and ``headers`` holds each record's exact header block with the
digest of its payload. ``restore`` joins the two back to records and checks every payload's
digest again. ``write_files`` puts restored records into WARC files, a gzip member for each record, and ``read_files``
parses such files by their Content-Length.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, that with the largest id is
the response and the others are revisits of it, written without the payload.

Defined results: a null html is an empty payload; a null url is written as ``about:blank``. A null id is written
as ``null`` and is less than any other: with such a payload it revisits the largest id; where all ids are null, all are
responses. A payload may hold anything, record boundaries included. Every row is a record: rows that repeat the largest id
are all responses. An empty table gives an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import BROADCAST_IDS, cut, drop, new_path, small_batches

REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
#: Records that a reader hands on at once.
HELD_RECORDS = 4096
#: Zipped bytes that a writer gathers, about, and how often into one file.
CHUNK_BYTES, FILE_CHUNKS = 1 << 23, 8
#: Payload bytes that a reader hands on at once, about.
HELD_BYTES = 1 << 24
CRLF = "\r\n"


def _uri(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))


def _row_key() -> Column:
    """What a row is looked up by: its id; a hash of its payload where that is null."""
    return F.coalesce(F.col("page_id").cast("long"), F.xxhash64(F.coalesce("html", F.lit(""))))


def classify(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, row_key, url, payload_digest`` (SHA-1), ``strong`` (SHA-256), ``payload_bytes, record_type, refers_to``.

    Only ids and digests are shuffled. A digest's largest id is an aggregate, so copies don't meet.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", _row_key().alias("row_key"), "url", F.sha1(body).alias("payload_digest"), F.unhex(F.sha2(body, 256)).alias("strong"), F.length(body).cast("long").alias("payload_bytes"))
    rows = cut(rows, "digests")
    # a payload of one record has no other to refer to
    top = rows.where(F.col("payload_bytes") >= least).groupBy("strong").agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    joined = rows.join(top, "strong", "left")
    other = F.col("_top").isNotNull() & F.coalesce(F.col("page_id") < F.col("_top"), F.lit(True))
    return joined.select(*rows.columns, F.when(other, "revisit").otherwise("response").alias("record_type"), F.when(other, F.col("_top")).alias("refers_to"))


def header(row_type: Column, key: Column, url: Column, refers: Column, digest: Column, length: Column) -> Column:
    """A record's header block, up to and with its empty line."""
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), row_type),
        F.concat(F.lit("WARC-Record-ID: "), _uri(key)),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("about:blank")), r"[\r\n]", "")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
        F.when(row_type == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(row_type == "revisit", F.concat(F.lit("WARC-Refers-To: "), _uri(refers))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(row_type == "revisit", F.lit("0")).otherwise(length.cast("string"))),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def store(pages: DataFrame, path: str, least: int = REVISIT_BYTES) -> None:
    """Write ``path/headers`` and ``path/payloads``."""
    spark = pages.sparkSession
    kinds = classify(pages, least)
    made = header(F.col("record_type"), F.col("page_id"), F.col("url"), F.col("refers_to"), F.col("payload_digest"), F.col("payload_bytes"))
    kinds.withColumn("header", made).drop("url").write.option("compression", "zstd").parquet(f"{path}/headers")
    heads = spark.read.parquet(f"{path}/headers")
    one = heads.groupBy("strong").agg(F.coalesce(F.max("page_id"), F.max("row_key")).alias("row_key"))
    rows = pages.select(_row_key().alias("row_key"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    # a row that holds a payload for all its copies; the other rows are those of copies
    copies = cut(heads.select("row_key", "strong").join(one, ["row_key", "strong"], "left_anti").select("row_key"), "copies")
    unique = heads.count() == heads.select("row_key").distinct().count()
    if unique and copies.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        rows = rows.join(F.broadcast(copies), "row_key", "left_anti").select(F.unhex(F.sha2("payload", 256)).alias("strong"), "payload")
    else:
        rows = rows.join(one, "row_key").where(F.unhex(F.sha2("payload", 256)) == F.col("strong")).dropDuplicates(["strong"]).select("strong", "payload")
    rows.write.option("compression", "zstd").parquet(f"{path}/payloads")
    drop(copies)


def restore(spark, path: str, revisits: bool = True) -> DataFrame:
    """Records ``page_id, record_type, refers_to, payload_digest, header, payload`` from the two tables.

    A payload whose digest isn't the one it is stored under fails the job. Without ``revisits`` those records have empty payloads.
    """
    heads = spark.read.parquet(f"{path}/headers").drop("row_key")
    bodies = spark.read.parquet(f"{path}/payloads")
    good = F.when(F.unhex(F.sha2("payload", 256)) == F.col("_strong"), F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload does not match its digest")))
    bodies = bodies.select(F.col("strong").alias("_strong"), "payload").select("_strong", good.cast("binary").alias("payload"))
    bare = F.col("payload_bytes") == 0
    bare = bare if revisits else bare | (F.col("record_type") == "revisit")
    full = heads.where(~bare).join(bodies, F.col("strong") == F.col("_strong")).drop("_strong")
    return full.unionByName(heads.where(bare).withColumn("payload", F.lit(b"")))


def _members(record: bytes) -> bytes:
    """The record as a gzip member; as several if it has 2^24 bytes or more, so that the last byte (of the length) is 0."""
    return b"".join(gzip.compress(record[i : i + (1 << 24) - 1], 6, mtime=0) for i in range(0, len(record), (1 << 24) - 1))


def write_files(records: DataFrame, path: str) -> None:
    """WARC files of about ``CHUNK_BYTES * FILE_CHUNKS`` zipped bytes at most; a revisit is written without its payload."""

    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def made() -> pa.RecordBatch:
            # the writer's line end is the last byte
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["value"])

        for b in batches:
            for head, kind, body in zip(b.column("header"), b.column("record_type"), b.column("payload"), strict=True):
                held.append(_members(head.as_py().encode() + (b"" if kind.as_py() == "revisit" else body.as_py()) + b"\r\n\r\n"))
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield made()
                    held, size = [], 0
        if held:
            yield made()

    rows = records.select("header", "record_type", "payload").mapInArrow(zipped, "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", FILE_CHUNKS).text(path)


_FIELD = {k: re.compile(rb"(?m)^" + v + rb": *(.*?)\r$") for k, v in {"type": b"WARC-Type", "id": b"WARC-Record-ID", "refers": b"WARC-Refers-To", "digest": b"WARC-Payload-Digest", "length": b"Content-Length"}.items()}


def parse(source: bytes | BinaryIO) -> Iterator[tuple[bytes, bytes]]:
    """Header block and payload of each record of a WARC file, read one after the other."""
    source = io.BytesIO(source) if isinstance(source, bytes) else source
    while line := source.readline():
        head = [line]
        while head[-1] not in (CRLF.encode(), b""):
            head.append(source.readline())
        block = b"".join(head)
        n = int(_FIELD["length"].search(block)[1])
        body, end = source.read(n), source.read(4)
        if len(body) < n or end != b"\r\n\r\n":
            raise ValueError("a record does not end where its Content-Length says")
        yield block, body


def _key(uri: bytes) -> int | None:
    key = uri.removeprefix(b"<urn:page:").removesuffix(b">")
    return None if key == b"null" else int(key)


def read_files(spark, path: str, with_payload: bool = True) -> DataFrame:
    """``page_id, record_type, refers_to, header_digest, payload_digest, payload_bytes`` and the payload, of each record.

    ``payload_digest`` is computed anew from a response's payload; it must equal the header's.
    """
    small_batches(spark, 1)  # a file a batch

    names = ["page_id", "record_type", "refers_to", "payload_digest", "stored_bytes", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def made(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                out, size = [], 0
                # unzipped as it is read: records are handed on before the file is through
                for head, body in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    got = {k: (m[1] if (m := x.search(head)) else None) for k, x in _FIELD.items()}
                    kind, said = got["type"].decode(), got["digest"].decode().removeprefix("sha1:")
                    digest = said if kind == "revisit" else hashlib.sha1(body).hexdigest()
                    if digest != said:
                        raise ValueError(f"the payload of {got['id']} does not match its digest")
                    out.append((_key(got["id"]), kind, _key(got["refers"]) if got["refers"] else None, digest, len(body), body if with_payload else None))
                    size += len(body) if with_payload else 0
                    if len(out) >= HELD_RECORDS or size >= HELD_BYTES:
                        yield made(out)
                        out, size = [], 0
                yield made(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(read, "page_id long, record_type string, refers_to long, payload_digest string, stored_bytes long, payload binary")


def roundtrip(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Store, restore, write files, read them back: a row per record, with the full payload's bytes and digest."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    small_batches(spark)
    store(pages, f"{path}/store", least)
    write_files(restore(spark, f"{path}/store", revisits=False), f"{path}/files")
    got = cut(read_files(spark, f"{path}/files", with_payload=False).drop("payload"), "records")
    small_batches(spark)
    columns = ["page_id", F.col("stored_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"]
    own = got.where("record_type = 'response'").select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), F.col("stored_bytes").alias("_bytes")).distinct()
    # a revisit has the bytes of the response that it refers to
    again = got.where("record_type = 'revisit'").join(own, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    return got.where("record_type = 'response'").select(*columns).unionByName(again.withColumn("stored_bytes", F.col("_bytes")).select(*columns))
