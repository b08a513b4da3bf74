"""A content-addressed web archive.

``write_archive`` keeps two tables under one path: ``payloads`` holds the bytes of each
distinct payload once, under its SHA-256, and ``headers`` the exact WARC/1.1 header block of
every record with the SHA-256 it belongs to. ``read_archive`` parses the headers, checks the
stored bytes against both digests, and joins them to reconstruct each record.

Of records with equal payloads (of ``least`` bytes or more) the one with the largest page_id
is a response, the others are revisits of it; shorter payloads are all responses. Digests are
strong, and equal digests with unequal lengths stop the job.

Only digests and ids are grouped. Payload bytes are shuffled once, by (page_id, digest), so
thousands of copies of one page spread over tasks and are dropped there; the hot digest
meets one row in the joins on the digest.

Null html is empty. Rows with the largest page_id twice are both responses of one stored
payload. A null page_id sorts below all others. Line breaks in a url are percent-encoded; a
null url has no header line. Extra columns are ignored; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.shared import need, written

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values: RFC 4648
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value: WARC/1.1
EOL = "\r\n"


def base32_of_sha1(hex_digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hex digest: five hex digits are four base32 letters."""
    parts = []
    for i in range(8):
        n = F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            parts.append(F.substring(F.lit(BASE32), F.shiftright(n, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*parts)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(EOL))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _records(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("sha256", F.unhex(F.sha2("payload", 256)))


def write_archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least: int = 0) -> None:
    need(pages, "page_id", "url", "html")
    records = _records(pages)
    heads = records.select("page_id", "url", "sha256", F.octet_length("payload").cast("long").alias("n_bytes"),
                           base32_of_sha1(F.sha1("payload")).alias("sha1"))
    first = heads.groupBy("sha256").agg(
        F.max("page_id").alias("response_id"), F.min("n_bytes").alias("n_min"), F.max("n_bytes").alias("n_max")
    ).withColumn("sha256", F.when(F.col("n_min") == F.col("n_max"), F.col("sha256")).otherwise(
        F.raise_error(F.lit("payloads of different lengths share a SHA-256"))))
    # written: a join of two plain tables is one that adaptive execution can split at a hot digest
    first = written(first.select("sha256", "response_id"), "responses")
    joined = heads.join(first, "sha256")
    is_response = F.col("page_id").eqNullSafe(F.col("response_id")) | (F.col("n_bytes") < least)
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit("WARC/1.1" + EOL),
        _line("WARC-Type", F.when(is_response, "response").otherwise("revisit")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        F.coalesce(_line("WARC-Target-URI", url), F.lit("")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(is_response, "").otherwise(F.concat(
            _line("WARC-Refers-To", _record_id(F.col("response_id"))), _line("WARC-Profile", F.lit(REVISIT_PROFILE)))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(is_response, F.col("n_bytes")).otherwise(F.lit(0)).cast("string")),
        F.lit(EOL))
    joined.select("sha256", header.alias("header")).write.parquet(f"{path}/headers")

    # the record that keeps the payload; rows that tie are one group of the same partitioning
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none")).alias("key")
    stored = records.select("sha256", key("page_id"), "payload").join(
        first.select("sha256", key("response_id")).hint("shuffle_hash"), ["sha256", "key"])
    stored.groupBy("sha256", "key").agg(F.first("payload").alias("payload")).select(
        "sha256", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("header", f"\\r\\n{name}: ([^\\r]*)\\r\\n", 1), F.lit(""))


def _page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: what its header says, and the SHA-256 of its payload."""
    number = lambda c: F.nullif(_page_of(c), F.lit("")).cast("long")
    return spark.read.parquet(f"{path}/headers").select(
        "sha256", "header", number(_field("WARC-Record-ID")).alias("page_id"),
        _field("WARC-Target-URI").alias("url"), _field("WARC-Type").alias("record_type"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("payload_digest"),
        number(_field("WARC-Refers-To")).alias("refers_to"),
        _field("Content-Length").cast("long").alias("content_length"))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads, each checked against the digest it is stored under."""
    good = F.unhex(F.sha2("payload", 256)) == F.col("sha256")
    checked = F.when(good, F.col("sha256")).otherwise(F.raise_error(F.lit("a stored payload does not match its SHA-256")))
    return spark.read.parquet(f"{path}/payloads").select(
        checked.alias("sha256"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_sha1(F.sha1("payload")).alias("stored_digest"))


def _joined(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    stored = read_payloads(spark, path).select("sha256", "payload_bytes", "stored_digest", *columns)
    both = read_headers(spark, path).join(stored, "sha256")
    same = F.col("stored_digest") == F.col("payload_digest")
    return both.withColumn("payload_digest", F.when(same, F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a record's digest does not match its payload")))).drop("stored_digest")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url."""
    return _joined(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records: index columns, ``payload`` (of revisits too, from the store) and
    ``record``, the exact bytes of the WARC record."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    record = F.concat(F.col("header").cast("binary"), block, F.lit(b"\r\n\r\n"))
    return _joined(spark, path, "payload").select(
        "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", record.alias("record"))


def _oracle_base32() -> str:
    letter = "substr('" + BASE32 + "', ((('0x' || substr(hex, {at}, 5))::INTEGER >> {shift}) & 31) + 1, 1)"
    return " || ".join(letter.format(at=5 * i + 1, shift=s) for i in range(8) for s in (15, 10, 5, 0))


# DuckDB SQL of read_index over the pages table with least = 0
ORACLE = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS response_id FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_oracle_base32()} AS payload_digest,
       CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response_id THEN NULL ELSE response_id END AS refers_to, url
FROM r
"""
