"""WARC archives with dictionary compression: one Zstandard frame per record, the dictionary in a leading skippable frame.

An archive is a sequence of Zstandard frames: first a skippable frame (magic 0x184D2A5D) that holds the dictionary,
then each record compressed on its own with that dictionary, so any record can be read from its offset. Spark's text
sink writes the frames as raw bytes to any file system, one file per task, committed as a whole; the sink's line
separator is an empty skippable frame, which readers pass over.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.llm.common import bounded_batches, bounded_sample, shared_folder

DICT_MAGIC, GAP = 0x184D2A5D, "P*M\x18\x00\x00\x00\x00"  # GAP: skippable frame 0x184D2A50 of no bytes
DICT_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 64 << 10, 512, 16 << 10
SLICE = 1 << 16  # bytes of an archive that a reader is given at once
ARCHIVE_BYTES = 24 << 20
LEVEL = 3


def planned(pages: DataFrame, id_col: str, url_col: str, payload_col: str, revisit_min_bytes: int, archives: int) -> DataFrame:
    """The records to write, dealt to ``archives`` partitions: page_id, url, payload, digest (SHA-1 in hex), refers_to
    (null: a response). Payloads move once: which rows are revisits is found from ids and digests alone, and joins the
    payloads where their archive is. The digest is a plain ``sha1`` of a payload that is never null, so the joins' null
    checks fold away; on a longer expression they would hash the payload again for each of its parts."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    keys = rows.where(F.length("payload") >= revisit_min_bytes).select("page_id", "digest")
    last = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    revisits = keys.join(last, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()
    dealt = rows.repartition(archives, "page_id", "digest")
    return dealt.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to")


def trained_dictionary(records: DataFrame, size: int = DICT_BYTES, sample: int = SAMPLE_RECORDS) -> bytes:
    """A Zstandard dictionary from at most ``sample`` payloads (the first ``SAMPLE_BYTES`` of each), chosen by a hash
    of the id; empty where there is too little to learn from. It changes the archives' size, never their records."""
    picked = bounded_sample(records.where(F.length("payload") > 0).select("page_id", F.substring("payload", 1, SAMPLE_BYTES).alias("payload")), "page_id", sample)
    samples = [bytes(r[0]) for r in picked.select("payload").collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url or '')}",
        f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(digest))}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Bytes: {len(payload)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>", f"X-Refers-To-Page: {refers_to}"]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode() + payload + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes a record for each row of ``pages`` into archives of about ``archive_bytes`` of payload under ``path``.

    Of rows with equal payloads of at least ``revisit_min_bytes`` that with the largest page_id is a response, the
    others are revisits of it; rows that share even the id are all responses. A null payload is an empty one, a null
    id is written empty and always a response, a null url is empty. No pages: no archive. Rows are dealt by id and
    digest, so copies of one payload spread over all archives.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    total = pages.agg(F.sum(F.length(F.col(payload_col).cast("binary")))).first()[0] or 0
    dictionary = spark.sparkContext.broadcast(trained_dictionary(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(payload_col).cast("binary").alias("payload"))))

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        comp = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned, write_checksum=True)
        lead = [struct.pack("<II", DICT_MAGIC, len(dictionary.value)) + dictionary.value]
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(5)), strict=True)
            out = lead + [comp.compress(record_bytes(*r)) for r in rows]
            lead = []
            yield pa.record_batch([pa.array(out, pa.binary())], names=["frame"])

    records = planned(pages, id_col, url_col, payload_col, revisit_min_bytes, max(1, -(-total // archive_bytes)))
    records.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("lineSep", GAP).text(path)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of the records of one archive."""
    at, learned = 0, None
    decomp = zstandard.ZstdDecompressor()
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0]
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            size = struct.unpack_from("<I", data, at + 4)[0]
            if magic == DICT_MAGIC and size:
                learned = zstandard.ZstdCompressionDict(data[at + 8 : at + 8 + size])
                decomp = zstandard.ZstdDecompressor(dict_data=learned)
            at += 8 + size
            continue
        reader, parts = decomp.decompressobj(), []
        while not reader.eof:
            if at >= len(data):
                raise ValueError("the archive ends inside a record")
            parts.append(reader.decompress(memoryview(data)[at : at + SLICE]))
            at += min(SLICE, len(data) - at)
        at -= len(reader.unused_data)  # of the last slice, not of the archive
        record = b"".join(parts)
        head, _, body = record.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
        yield fields, body[: int(fields["Content-Length"])]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload (null for revisits), payload_bytes and payload_digest of every
    record of the archives under ``path``. A response's size and digest are taken from its payload, a revisit's from
    its headers; a response whose payload does not match its digest fails the job."""
    bounded_batches(spark)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        for b in batches:
            for data in b.column(0):
                out, size = [], 0
                for f, body in parsed(data.as_py()):
                    whole = f["WARC-Type"] == "response"
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    if whole and base32(hashlib.sha1(body).digest()) != digest:
                        raise ValueError(f"the payload of page {f['X-Page-Id']} does not match its digest")
                    number = lambda k, f=f: int(f[k]) if f.get(k) else None
                    out.append((number("X-Page-Id"), f["WARC-Target-URI"], f["WARC-Type"], number("X-Refers-To-Page"), body if whole else None, len(body) if whole else number("X-Payload-Bytes"), digest))
                    size += len(body)
                    if size > 16 << 20:
                        yield pa.record_batch([pa.array(c, k) for c, (_, k) in zip(zip(*out, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])
                        out, size = [], 0
                if out:
                    yield pa.record_batch([pa.array(c, k) for c, (_, k) in zip(zip(*out, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])

    schema = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(rows, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder."""
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
