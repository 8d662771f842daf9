"""Content-addressed WARC archive.

``write_archive`` makes one WARC/1.1 record per page.  Payload bytes are stored
once per SHA-256 digest (table ``payloads``); every record's exact header block
is stored apart (table ``records``).  ``read_archive`` rebuilds the original
records by joining the two on the digest and checks the digest of the bytes.

Of records with equal payloads of at least ``min_revisit`` bytes the one with
the smallest id is ``response``; the others are ``revisit`` records that refer
to it.  Smaller payloads are always ``response``.

Defined results: a null payload is empty; a null URI is written as
``urn:unknown``; rows that repeat the smallest id of their payload are all
``response``; a null id is never the smallest unless all ids are null, and then
all records are ``response``; an empty table gives an empty archive.  Further
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumen.session import scratch_dir

MIN_REVISIT = 100
WARC_DATE = "1970-01-01T00:00:00Z"  # the tables carry no crawl time
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(c):
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))


def _headers(date: str):
    """WARC header and HTTP header lines of a record, ending before the payload."""
    nl = F.lit("\r\n")
    uri = F.regexp_replace(F.coalesce("uri", F.lit("urn:unknown")), r"[\x00-\x20\x7f]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("revisit")
    body = F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), nl,
        F.lit("WARC-Record-ID: "), _record_id(F.col("id")), nl,
        F.lit(f"WARC-Date: {date}\r\nWARC-Target-URI: "), uri, nl,
        F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest"), nl,
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("first_id")), nl,
                                 F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + body).cast("string"), F.lit("\r\n\r\n"), http)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
                  payload_col: str = "html", min_revisit: int = MIN_REVISIT, date: str = WARC_DATE) -> None:
    """Write the archive of ``pages`` under ``path`` (``payloads`` and ``records``)."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    src = pages.select(F.col(id_col).alias("id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    src = src.withColumn("payload_digest", F.sha2("payload", 256))
    # Pre-aggregated per task, so a payload shared by many rows leaves each task once.
    (src.groupBy("payload_digest")
        .agg(F.min("id").alias("first_id"), F.first("payload").alias("payload"))
        .write.option("compression", "zstd").parquet(f"{path}/payloads"))
    first = spark.read.parquet(f"{path}/payloads").select("payload_digest", "first_id")
    (src.withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload")
        .join(first, "payload_digest")
        .withColumn("revisit", (F.col("payload_bytes") >= min_revisit) & F.col("first_id").isNotNull()
                    & ~F.col("id").eqNullSafe(F.col("first_id")))
        .select("id", "payload_digest", F.encode(_headers(date), "UTF-8").alias("header"))
        .write.option("compression", "zstd").parquet(f"{path}/records"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Rebuild every record: ``id``, ``header``, ``payload`` (a revisit's comes
    from the record it refers to), ``record`` (the exact WARC bytes) and
    ``verified`` (the payload has the digest that the header states)."""
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads").select("payload_digest", "payload")
    stated = F.regexp_extract(F.decode("header", "UTF-8"), r"WARC-Payload-Digest: sha256:([0-9a-f]{64})", 1)
    body = F.when(F.decode("header", "UTF-8").contains("\r\nWARC-Refers-To: "), F.lit(b"")).otherwise(F.col("payload"))
    return records.join(payloads, "payload_digest").select(
        "id", "header", "payload", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"),
        (F.sha2("payload", 256) == stated).alias("verified"))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the archive in the shared folder, read it back, and give per page
    what its record's own header and rebuilt payload say."""
    path = scratch_dir(pages.sparkSession, "warc")
    write_archive(pages, path)
    head = F.decode("header", "UTF-8")
    kind = pages.schema["page_id"].dataType
    refers = F.regexp_extract(head, r"WARC-Refers-To: <urn:page:([^>]*)>", 1)
    return read_archive(pages.sparkSession, path).select(
        F.col("id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        F.regexp_extract(head, r"WARC-Type: (\w+)", 1).alias("record_type"),
        F.when(refers != "", refers).cast(kind).alias("refers_to"),
        "verified")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, octet_length(encode(body)) AS n, sha256(body) AS digest FROM p
), f AS (
  SELECT digest, min(page_id) AS first_id FROM d GROUP BY digest
)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN d.n >= 100 AND d.page_id <> f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.n >= 100 AND d.page_id <> f.first_id THEN f.first_id END AS refers_to,
       true AS verified
FROM d JOIN f USING (digest)
"""
