"""Content-addressed web archive: each distinct payload is stored once, records keep their exact headers.

An archive is a folder with two Parquet tables. ``payloads`` holds (address, first_id, payload), one row for each
distinct payload, addressed by its SHA-256. ``headers`` holds (record_id, address, header), the exact bytes of each
record before its payload. A response record is its header followed by the payload of its address; a revisit record
is its header alone. Reading recomputes every SHA-256 and fails on a payload that does not fit its address.

Defined cases: a null payload is empty; the empty payload is stored and revisited like any other. Rows that repeat
an id with an equal payload are all responses. Null ids come after all others. A null address of the page gives no
target line. An empty table gives an empty archive. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hex digits are 20 bits, or 4 digits to the base 32."""
    hexa = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexa, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), DIGITS, ALPHABET)


def lines(*parts) -> Column:
    """Header lines, each ended by CR LF; null parts are left out."""
    return F.concat(F.concat_ws("\r\n", *parts), F.lit("\r\n\r\n"))


def target(url: Column) -> Column:
    """A URL as a header value: carriage returns and line feeds, which would end the line, are percent-encoded."""
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write(pages: DataFrame, path: str, record_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> None:
    """Write the archive of ``pages`` to ``path``. Payloads shorter than ``least`` bytes never become revisits.

    The payload is shuffled once, after each task has dropped its own copies; all else is narrow.
    """
    rows = pages.select(
        F.col(f"`{record_id}`").cast("long").alias("record_id"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("address", F.sha2("payload", 256))
    rows.groupBy("address").agg(F.min("record_id").alias("first_id"), F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")
    spark = pages.sparkSession
    firsts = spark.read.schema("address string, first_id long").parquet(f"{path}/payloads")
    narrow = rows.select("record_id", "url", "address", F.octet_length("payload").alias("size"), base32_sha1(F.col("payload")).alias("digest"))
    known = narrow.join(firsts, "address")
    revisit = (F.col("size") >= least) & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    http = lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), "size"))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    header = F.concat(
        lines(
            F.lit("WARC/1.1"),
            F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
            F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("record_id").cast("string"), F.lit("none")), F.lit(">")),
            F.concat(F.lit("WARC-Target-URI: "), target(F.col("url"))),
            F.lit(f"WARC-Date: {DATE}"),
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
            F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
            F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.coalesce(F.col("first_id").cast("string"), F.lit("none")), F.lit(">"))),
            F.lit("Content-Type: application/http; msgtype=response"),
            F.concat(F.lit("Content-Length: "), block),
        ),
        http,
    )
    known.select("record_id", "address", header.alias("header")).write.parquet(f"{path}/headers")


def field(name: str, header: str = "header") -> Column:
    """The value of a line of the first header block, null without such a line. Only CR LF ends a line."""
    block = F.split(F.substring_index(header, "\r\n\r\n", 1), "\r\n")
    start = f"{name}: "
    return F.substring(F.get(F.filter(block, lambda line: line.startswith(start)), F.lit(0)), len(start) + 1, 2**31 - 1)


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(address, payload), verified: a row whose bytes do not hash to its address ends the job."""
    stored = spark.read.schema("address string, payload binary").parquet(f"{path}/payloads")
    right = F.sha2("payload", 256) == F.col("address")
    return stored.select("address", F.when(right, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("archive payload does not fit "), "address")).cast("binary")).alias("payload"))


def headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("record_id long, address string, header string").parquet(f"{path}/headers")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, warc, payload_bytes, payload_digest): every original record, header and payload joined again, and what its
    stored payload says. Payloads are digested once, before the join."""
    stored = payloads(spark, path).select("address", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    whole = headers(spark, path).join(stored, "address")
    body = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return whole.select("record_id", F.concat(F.col("header").cast("binary"), body, F.lit(b"\r\n\r\n")).alias("warc"), "payload_bytes", "payload_digest")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Per record what its reconstructed bytes say. A record whose header names another digest than that of its payload, or
    whose own body has another, ends the job."""
    header = F.substring_index(F.col("warc").cast("string"), "\r\n\r\n", 1)
    rows = records(spark, path).withColumn("header", header)
    number = lambda name: F.regexp_extract(field(name), r"<urn:page:(-?\d+)>", 1).try_cast("long")
    own = F.substring(F.col("warc"), F.octet_length("warc") - 3 - F.col("payload_bytes").cast("int"), F.col("payload_bytes").cast("int"))
    said = field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    right = said & ((field("WARC-Type") == "revisit") | (base32_sha1(own) == F.col("payload_digest")))
    digest = F.when(right, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("archive record does not fit its payload: "), "header")))
    return rows.select(
        number("WARC-Record-ID").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), field("WARC-Type").alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"), field("WARC-Target-URI").alias("url"))
