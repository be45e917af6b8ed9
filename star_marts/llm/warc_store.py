"""A content-addressed WARC archive.

Three tables: `headers` has one row per record with the exact header bytes, `blobs` has each
distinct payload once under its SHA-256, with its number of records, and `records()` joins them to the original bytes.  The
digest is verified where payloads meet: a blob is found by SHA-256, SHA-1 and length together,
and reading takes the rebuilt bytes apart and recomputes both digests and the length from them.

Of records with equal payloads of at least 1000 bytes the one with the largest page_id is a
response, the others revisit it; shorter payloads are all responses.

Defined cases: a null html is an empty payload; a null url an empty target; rows without page_id
are archived as responses of their own and rank below every page_id; of repeated rows (equal
page_id) with equal long payloads, each refers to the page_id unless it is the largest, whose rows
are all responses; an empty table gives an empty archive; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from star_marts.llm.common import spread_join
from star_marts.session import scratch_path, stage

LEAST_REVISIT = 1000
DATE = "1970-01-01T00:00:00Z"  # pages carry no date
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
_END = "\r\n"
CONTENT = ["sha256", "sha1", "length"]  # what a payload is found by


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, length and digests."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    return pages.select(
        "page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"), body.alias("payload")
    ).select(
        "page_id", "url", "payload", F.octet_length("payload").cast("long").alias("length"),
        F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"),
    )


def _header(kind: Column) -> Column:
    """The exact header block, which ends with an empty line."""
    record = lambda name: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record("page_id")),
        F.lit(f"WARC-Date: {DATE}"),
        # A line break inside a url must not end its header line.
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(kind == "revisit", F.concat(F.lit("WARC-Refers-To: "), record("refers_to"))),
        F.when(kind == "revisit", F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.col("length").cast("string")),
        F.lit(_END),
    ]
    return F.encode(F.concat_ws(_END, *lines), "UTF-8")


def write_archive(pages: DataFrame, path: str) -> None:
    """Write `path`/headers, `path`/contents (a row per distinct payload) and `path`/blobs."""
    rows = payloads(pages)
    index = stage(rows.drop("payload"), "index")
    index.groupBy(*CONTENT).agg(
        F.max("page_id").alias("holder"), F.count("*").alias("copies")
    ).write.parquet(f"{path}/contents")
    contents = pages.sparkSession.read.parquet(f"{path}/contents")

    known = spread_join(index, contents, CONTENT, "copies", ["page_id", "url"])
    long = (F.col("length") >= LEAST_REVISIT) & F.col("holder").isNotNull()
    revisit = long & (F.col("page_id") < F.col("holder"))
    kind = F.when(revisit, "revisit").otherwise("response")
    known.withColumn("refers_to", F.when(revisit, F.col("holder"))).select(
        _header(kind).alias("header"), *CONTENT
    ).write.parquet(f"{path}/headers")

    # Only the holder's row of each payload moves.  Its repetitions have the same bytes.
    holders = contents.withColumnRenamed("holder", "page_id")
    same = [rows[c].eqNullSafe(holders[c]) for c in (*CONTENT, "page_id")]
    stored = rows.join(holders, same).select(*[rows[c] for c in CONTENT], "payload", "copies")
    if _repeated_pages(index):
        stored = stored.dropDuplicates(CONTENT)
    stored.write.parquet(f"{path}/blobs")


def _repeated_pages(index: DataFrame) -> bool:
    """Whether a page_id, or the missing one, occurs in more than one row."""
    return not index.groupBy("page_id").count().filter("count > 1").isEmpty()


def records(spark: SparkSession, path: str) -> DataFrame:
    """header, payload, the bytes of the whole record, and the digest the payload is stored under."""
    headers = spark.read.parquet(f"{path}/headers")
    blobs = spark.read.parquet(f"{path}/blobs")
    joined = spread_join(headers, blobs, CONTENT, "copies", ["header"])
    record = F.concat("header", "payload", F.encode(F.lit(_END * 2), "UTF-8"))
    return joined.select("header", "payload", record.alias("record"), "sha256")


def parse(archived: DataFrame) -> DataFrame:
    """Read records back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The header ends at the first empty line, the payload follows it.  Length and digests are those
    of the payload that was read; a record whose header, length or stored SHA-256 says otherwise is
    an error.
    """
    # One character per byte, so that positions are those of bytes.
    ends = archived.withColumn("_end", F.instr(F.decode("record", "ISO-8859-1"), _END * 2))
    parts = ends.select(
        F.decode(F.substring("record", F.lit(1), F.col("_end") + 1), "UTF-8").alias("text"),
        F.substring("record", F.col("_end") + 4, F.octet_length("record") - F.col("_end") - 7).alias("payload"),
        "sha256",
    )
    # (?d): only a line feed ends a line, not what a url may hold beside it.
    field = lambda pattern: F.regexp_extract("text", "(?md)^" + pattern, 1)
    number = lambda s: F.when(s != "", s.cast("long"))
    digest, size = F.sha1("payload"), F.octet_length("payload").cast("long")
    intact = (
        (field("WARC-Payload-Digest: sha1:([0-9a-f]{40})") == digest)
        & (number(field("Content-Length: ([0-9]+)")) == size)
        & (F.sha2("payload", 256) == F.col("sha256"))
    )
    return parts.select(
        number(field("WARC-Record-ID: <urn:page:(-?[0-9]*)>")).alias("page_id"),
        size.alias("payload_bytes"),
        F.when(intact, digest).otherwise(F.raise_error(F.lit("a record differs from its header"))).alias("payload_digest"),
        field("WARC-Type: ([a-z]+)").alias("record_type"),
        number(field("WARC-Refers-To: <urn:page:(-?[0-9]*)>")).alias("refers_to"),
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the archive to the shared folder and read every record back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, path)
    return parse(records(spark, path))


ORACLE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
q AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
  max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM q
"""
