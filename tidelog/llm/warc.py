"""Content-addressed WARC archive: each payload once, record headers apart, records by join.

An archive is two Parquet tables in one folder:

    payloads/   sha256, payload            one row per distinct payload
    records/    record_id, header, sha256  one row per record, the exact header text

All stock expressions, no Python on the executors.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_HEX32, _RFC4648 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CRLF = "\r\n"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: every five hex digits are four base32 symbols."""
    digest = F.sha1(data)
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), _HEX32, _RFC4648)


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per page: its digests, and whether it carries the payload or revisits another.

    `pages` has page_id, url, html; other columns are ignored.  Null html is an empty payload.
    Of equal payloads with at least `min_bytes` bytes the largest page_id is the response and
    the others revisit it; smaller payloads are all responses.  Rows that repeat the response's
    page_id are responses too; without any page_id in a group all its rows are responses.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    facts = pages.select(
        "page_id",
        "url",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("sha256"),
        base32_sha1(payload).alias("sha1"),
    )
    # Partial aggregation first: a payload on a third of all pages sends one row per task.
    keepers = facts.groupBy("sha256").agg(F.max("page_id").alias("keeper"))
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(
        F.col("keeper")
    ) & F.col("keeper").isNotNull()
    return facts.join(keepers, "sha256").withColumns(
        {
            "record_type": F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
            "refers_to": F.when(revisit, F.col("keeper")),
        }
    )


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def header_text(date: str) -> Column:
    """The header of a planned record, up to and with the empty line that ends it."""
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        # A line break inside a URL would end the field early.
        F.concat(
            F.lit("WARC-Target-URI: "),
            F.regexp_replace("url", r"[\r\n]", "%0A"),
        ),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(
            F.col("record_type") == "revisit",
            F.concat_ws(
                _CRLF,
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to"))),
            ),
        ),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")),
    ]
    return F.concat(F.concat_ws(_CRLF, *fields), F.lit(_CRLF + _CRLF))


def write_archive(
    pages: DataFrame, path: str, date: str = "2025-01-01T00:00:00Z", min_bytes: int = 0
) -> None:
    """Write the two tables of the archive of `pages` below `path`."""
    planned = plan_records(pages, min_bytes)
    planned.select(
        _record_id(F.col("page_id")).alias("record_id"), header_text(date).alias("header"), "sha256"
    ).write.option("compression", "zstd").parquet(f"{path}/records")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    # Null ids as one value: plain equality, so that the join and the removal of repeated rows
    # share one exchange.
    page = F.coalesce(F.col("page_id").cast("long"), F.lit(-(2**63)))
    bodies = pages.select(
        F.sha2(payload, 256).alias("sha256"), page.alias("page"), payload.alias("payload")
    )
    keepers = bodies.groupBy("sha256").agg(F.max("page").alias("page"))
    # Whole payloads move once, by (digest, page): page ids are spread even where a digest is hot.
    stored = (
        bodies.join(keepers, ["sha256", "page"], "left_semi")
        .dropDuplicates(["sha256", "page"])
        .select("sha256", "payload")
    )
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads, each checked against its address: a damaged one raises."""
    stored = spark.read.parquet(f"{path}/payloads")
    sound = F.sha2("payload", 256) == F.col("sha256")
    damaged = F.concat(F.lit("payload does not match its digest "), F.col("sha256"))
    return stored.withColumn(
        "sha256", F.when(sound, F.col("sha256")).otherwise(F.raise_error(damaged).cast("string"))
    )


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """The records with their header fields parsed."""

    def field(name: str) -> Column:
        return F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)", 1)

    def page(name: str) -> Column:
        return F.regexp_extract(field(name), r"<urn:page:(-?\d+)>", 1).try_cast("long")

    return spark.read.parquet(f"{path}/records").select(
        "record_id",
        "header",
        "sha256",
        page("WARC-Record-ID").alias("page_id"),
        field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        field("Content-Length").try_cast("long").alias("content_length"),
        field("WARC-Payload-Digest").alias("declared_digest"),
    )


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """Every original record: record_id, record (header, payload, closing empty lines)."""
    records = spark.read.parquet(f"{path}/records")
    end = F.encode(F.lit(_CRLF + _CRLF), "UTF-8")
    return records.join(read_payloads(spark, path), "sha256").select(
        "record_id", F.concat(F.encode("header", "UTF-8"), F.col("payload"), end).alias("record")
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Facts of every record as the archive has them.

    Length and digest are computed from the stored bytes, once per payload, and joined to the
    headers; a header that declares others raises.
    """
    bodies = read_payloads(spark, path).select(
        "sha256",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    agrees = (F.col("content_length") == F.col("payload_bytes")) & (
        F.col("declared_digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    )
    wrong = F.concat(F.lit("header disagrees with payload: "), F.col("record_id"))
    return (
        read_headers(spark, path)
        .join(bodies, "sha256")
        .select(
            "page_id",
            F.when(agrees, F.col("payload_bytes")).otherwise(F.raise_error(wrong).cast("long")).alias("payload_bytes"),
            "payload_digest",
            "record_type",
            "refers_to",
        )
    )
