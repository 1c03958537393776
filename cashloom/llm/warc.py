"""WARC archives with revisit records.

Headers (id, size, payload digest) are shuffled by digest; the largest id of a digest is the
original and every other record with that digest becomes a revisit that refers to it. Only
then are payloads read again and written, each record under fresh headers, so a payload that
occurs many times is stored once.

Archives are written by Spark's text writer: a record is one string value and the writer's
line separator is the blank line that ends a WARC record. Task commit, retries and shared
storage are therefore Spark's own. Each file is one gzip stream of records.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..sources.staging import shared_copy, shared_folder

ARCHIVE_BYTES = 64 << 20
"""Payload bytes that one archive file holds on average."""

# fixed values: the digits of base 32 in number conversion and in the base32 encoding
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"


def payload_digest(payload: Column) -> Column:
    """Base32 SHA-1 of a text's UTF-8 bytes, upper case, without a prefix.

    Four groups of 40 bits: ten hexadecimal digits each become eight base-32 digits.
    """
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 10 * g + 1, 10), 16, 32), 8, "0") for g in range(4)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def record_headers(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """One small row per page: page_id, payload_bytes, payload_digest. A NULL payload counts as empty."""
    body = F.coalesce(F.col(payload), F.lit(""))
    return pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        payload_digest(body).alias("payload_digest"),
    )


def resolve_revisits(headers: DataFrame, *, min_payload: int = 0) -> DataFrame:
    """page_id, payload_digest, refers_to of every record that revisits another.

    Of records with equal payloads of at least ``min_payload`` bytes, the largest page_id is the
    original. Rows repeated with the id of the original are responses too; rows without an id
    revisit the original where there is one.
    """
    large = headers.where(F.col("payload_bytes") >= min_payload)
    originals = (
        large.groupBy("payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and refers_to is not null")
        .select("payload_digest", "refers_to")
    )
    return (
        spread_join(large.select("page_id", "payload_digest"), originals, "payload_digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .distinct()
    )


def _clean(column: Column) -> Column:
    """A header value: no line breaks or other control characters."""
    return F.regexp_replace(F.coalesce(column, F.lit("")), r"[\x00-\x1F\x7F]+", " ")


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_payload: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> str:
    """Write one WARC record per page under ``path`` and return it.

    An empty table writes no record. Other columns of ``pages`` are ignored.
    """
    headers = shared_copy(record_headers(pages, key=key, url=url, payload=payload))
    total = headers.agg(F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("n")).first().n
    revisits = shared_copy(resolve_revisits(headers, min_payload=min_payload))

    body = F.coalesce(F.col(payload), F.lit(""))
    named = lambda column: F.coalesce(F.col(column).cast("long").cast("string"), F.lit("none"))
    rows = pages.select(named(key).alias("name"), _clean(F.col(url)).alias("url"), body.alias("payload"))
    rows = rows.withColumn("payload_digest", payload_digest(F.col("payload")))
    known = revisits.select(named("page_id").alias("name"), "payload_digest", "refers_to")
    # one shuffle of payloads: both sides are dealt alike, over the partitions that bound an archive's size
    parts = max(1, -(-total // archive_bytes))
    rows, known = (side.repartition(parts, "name", "payload_digest") for side in (rows, known))
    if revisits.limit(1).count():
        joined = rows.join(known, ["name", "payload_digest"], "left")
    else:
        # a join that turns out to be empty would be taken out at run time and the payloads dealt again
        joined = rows.withColumn("refers_to", F.lit(None).cast("long"))

    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"\r\nWARC-Record-ID: <{_ID}"),
        F.col("name"),
        F.lit(">\r\nWARC-Date: "),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Target-URI: "),
        F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(
            revisit,
            F.concat(
                F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <{_ID}"),
                F.col("refers_to").cast("string"),
                F.lit(">"),
            ),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(F.col("block")).cast("string"),
        F.lit("\r\n\r\n"),
        F.col("block"),
    )
    written = joined.withColumn("block", block).select(record.alias("value"))
    written.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
    return path


def parse_records(chunks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of one archive, read by its stated lengths."""
    held, at = bytearray(), 0
    source = iter(chunks)

    def fill(size: int) -> bool:
        while len(held) < size:
            chunk = next(source, None)
            if chunk is None:
                return False
            held.extend(chunk)
        return True

    while True:
        if at > 1 << 20:  # what was read is let go now and then, not for each record
            del held[:at]
            at = 0
        end = held.find(b"\r\n\r\n", at)
        while end < 0:
            seen = max(at, len(held) - 3)
            if not fill(len(held) + 1):
                if held[at:].strip():
                    raise ValueError("archive ends inside a header")
                return
            end = held.find(b"\r\n\r\n", seen)
        lines = held[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        named = dict(line.split(": ", 1) for line in lines[1:])
        stop = end + 4 + int(named["Content-Length"])
        if not fill(stop + 4):
            raise ValueError("archive ends inside a record")
        yield named, bytes(held[end + 4 : stop])
        at = stop + 4


def _unzip(data: memoryview, step: int = 1 << 20) -> Iterator[bytes]:
    """The members of a gzip file, a bounded piece at a time."""
    while len(data):
        member = zlib.decompressobj(31)
        at = 0
        while not member.eof and at < len(data):
            piece, at = data[at : at + step], at + step
            while len(piece):
                yield member.decompress(piece, step)
                piece = member.unconsumed_tail
        yield member.flush()
        at = len(data[:at]) - len(member.unused_data)
        data = data[at:]


_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, path: str, *, payloads: bool = False) -> DataFrame:
    """One row per record under ``path``; with ``payloads`` also its payload, NULL for a revisit.

    The digest and size of a response are those of the payload found; a response whose digest
    differs from its header stops the read. Those of a revisit are its headers'.
    """
    schema = _READ + (", payload binary" if payloads else "")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from base64 import b32encode
        from hashlib import sha1

        number = lambda name: int(name[1:-1].removeprefix(_ID)) if name and not name.endswith(":none>") else None
        names = [part.split(" ")[0] for part in schema.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: len(names)]

        def batch(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for archives in batches:
            for content in archives.column("content"):
                found, held = [], 0
                for named, block in parse_records(_unzip(memoryview(content.as_buffer()))):
                    digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = len(payload)
                    if named["WARC-Type"] == "revisit":
                        size, payload = int(http.rpartition(b"Content-Length: ")[2]), None
                    elif b32encode(sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload of {named['WARC-Record-ID']} does not match its digest")
                    row = (number(named["WARC-Record-ID"]), named["WARC-Target-URI"], size, digest, named["WARC-Type"], number(named.get("WARC-Refers-To", "")))
                    found.append((*row, payload) if payloads else row)
                    held += len(block) if payloads else 200
                    if held > 8 << 20:
                        yield batch(found)
                        found, held = [], 0
                yield batch(found)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(rows, schema)


def round_trip(pages: DataFrame, *, min_payload: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid4()}"
    return read_archives(spark, write_archives(pages, path, min_payload=min_payload))
