"""Content-addressed archive of web records.

Three parts under one folder, all written and read by Spark, so a lost executor costs a task retry:

* ``headers``: one row per record with its exact header block, its kind and the address of its payload;
* ``payloads``: each different payload once, under its SHA-256 address;
* records are reconstructed by joining the two (``reconstruct``).

Records with equal payloads of at least ``min_bytes``: the one with the largest page_id holds the payload
(``response``), the others revisit it. The address is verified, never trusted: reading back hashes the stored bytes
again, and a payload whose bytes do not give its address, or a header without its payload, raises.

Defined cases: null html is an empty payload; a null page_id counts as smaller than any other; repeated rows (same page_id and
payload) are one response and revisits of it, by row order; empty tables give empty archives; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfwise.session import stage_dir

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values: base32
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
UNKNOWN_DATE = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    spark: SparkSession
    path: str

    @property
    def headers(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/headers")

    @property
    def payloads(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/payloads")


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a hex digest whose length is a multiple of five digits (SHA-1 has forty)."""
    letters = []
    for group in range(0, 40, 5):
        value = F.conv(F.substring(digest, group + 1, 5), 16, 10).cast("int")
        letters += [
            F.substr(F.lit(ALPHABET), F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)
        ]
    return F.concat(*letters)


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def _record_id(page: Column, row: Column) -> Column:
    """Page and row: pages that repeat are records of their own."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit("#"), row.cast("string"), F.lit(">"))


def _header_block(date: str) -> Column:
    """The record's header lines, each ended by CRLF, without the empty line that ends the block."""
    response = F.col("record_type") == "response"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("row"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(response, F.lit("")).otherwise(
            F.concat(line("WARC-Refers-To", _record_id(F.col("holder"), F.col("holder_row"))), line("WARC-Profile", F.lit(PROFILE)))
        ),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(response, F.col("payload_bytes")).otherwise(F.lit(0)).cast("string")),
    )


def write(pages: DataFrame, min_bytes: int = 0, path: str | None = None, date: str = UNKNOWN_DATE) -> Archive:
    """Archive of (page_id, url, html); ``date`` is that of the capture, which the pages do not tell.

    The scan keeps digests only; the payload moves once more, for the rows that hold it. The digests are grouped with partial
    aggregation, so a payload of a third of all rows is one row per task before the shuffle.
    """
    spark = pages.sparkSession
    path = path or f"{stage_dir(spark)}/warc-{uuid.uuid4().hex}"
    source = pages.select("page_id", "url", "html")
    payload = _payload(F.col("html"))
    digests = source.select(
        "page_id",
        "url",
        F.sha2(payload, 256).alias("address"),
        base32_of_hex(F.sha1(payload)).alias("payload_digest"),
        F.length(payload).cast("bigint").alias("payload_bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    digests.write.option("compression", "zstd").parquet(f"{path}/scan")
    digests = spark.read.parquet(f"{path}/scan")
    order = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))), "row")
    holders = digests.groupBy("address").agg(F.max_by(F.struct("page_id", "row"), order).alias("h")).select(
        "address", F.col("h.page_id").alias("holder"), F.col("h.row").alias("holder_row")
    )
    small = F.col("payload_bytes") < min_bytes
    headers = (
        digests.join(holders, "address")
        .withColumn("record_type", F.when(small | (F.col("row") == F.col("holder_row")), "response").otherwise("revisit"))
        .select(
            "page_id", "address", "payload_bytes", "payload_digest", "record_type",
            F.when(F.col("record_type") == "revisit", F.col("holder")).alias("refers_to"),
            _header_block(date).alias("header"),
        )
    )
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")
    # Small payloads below the limit may repeat; one row of each address is enough to store.
    stored = (
        source.select("page_id", payload.alias("payload"), F.sha2(payload, 256).alias("own"))
        .join(holders, (F.col("own") == F.col("address")) & F.col("page_id").eqNullSafe(F.col("holder")))
        .select("address", "payload")
    )
    _once(stored, digests).write.option("compression", "zstd").parquet(f"{path}/payloads")
    return Archive(spark, path)


def _once(stored: DataFrame, digests: DataFrame) -> DataFrame:
    """Drops repeated (page_id, payload) rows, which only tables with repeated page_ids have."""
    repeated = digests.groupBy("page_id", "address").count().where("count > 1").limit(1).count()
    return stored.dropDuplicates(["address"]) if repeated else stored


def verified(archive: Archive) -> DataFrame:
    """address, bytes and SHA-1 of each stored payload, computed from the bytes read; wrong bytes raise."""
    return archive.payloads.select(
        F.when(F.sha2("payload", 256) == F.col("address"), F.col("address"))
        .otherwise(F.raise_error(F.concat(F.lit("payload does not match its address "), F.col("address"))))
        .alias("address"),
        F.length("payload").cast("bigint").alias("stored_bytes"),
        base32_of_hex(F.sha1("payload")).alias("stored_digest"),
    )


def _field(name: str) -> Column:
    # Unix lines: only a line feed ends one, as in the block; other line separators are part of a url.
    return F.regexp_extract("header", rf"(?dm)^{name}: ([^\r\n]*)", 1)


def read(archive: Archive) -> DataFrame:
    """Per record what its header block says, with bytes and digest from the payload that was read."""
    found = archive.headers.select("page_id", "address", "header").join(verified(archive), "address", "left")
    refers = F.regexp_extract(_field("WARC-Refers-To"), "<urn:page:(-?[0-9]+)#", 1)
    digest = F.when(F.concat(F.lit("sha1:"), F.col("stored_digest")) == _field("WARC-Payload-Digest"), F.col("stored_digest"))
    return found.select(
        "page_id",
        F.col("stored_bytes").alias("payload_bytes"),
        F.coalesce(digest, F.raise_error(F.concat(F.lit("no payload for the record with address "), F.col("address")))).alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("bigint")).alias("refers_to"),
    )


def reconstruct(archive: Archive) -> DataFrame:
    """page_id and the original record: header block, empty line and full payload, also for revisits.

    The join is on the payload's address; an address with very many records is split by adaptive execution.
    """
    return archive.headers.join(archive.payloads, "address").select(
        "page_id",
        "record_type",
        F.concat(F.col("header").cast("binary"), F.lit(CRLF).cast("binary"), F.col("payload")).alias("record"),
    )


def export(archive: Archive, path: str) -> None:
    """Plain WARC files: responses with their payload, revisits with an empty block, two line ends after each record."""
    rows = archive.headers.join(archive.payloads, "address")
    body = F.when(F.col("record_type") == "response", F.decode("payload", "UTF-8")).otherwise(F.lit(""))
    rows.select(F.concat("header", F.lit(CRLF), body).alias("value")).write.option("lineSep", CRLF * 2).text(path)


def sql() -> str:
    """The same rows as SQL."""
    letters = " || ".join(
        f"substr('{ALPHABET}', ((('0x' || substr(hex, {g + 1}, 5))::INT >> {s}) & 31) + 1, 1)" for g in range(0, 40, 5) for s in (15, 10, 5, 0)
    )
    return f"""
        WITH d AS (
            SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS hex,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder FROM pages)
        SELECT page_id, octet_length(encode(p))::BIGINT AS payload_bytes, {letters} AS payload_digest,
               CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> holder THEN holder END AS refers_to
        FROM d"""
