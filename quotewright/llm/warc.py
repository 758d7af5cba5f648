"""Content-addressed WARC archive.

Each page becomes a WARC record. The bytes of a payload are stored once, under
their SHA-256; the exact header block of every record is stored apart and names
that digest. Records come back by joining both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EPOCH = "1970-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """The bare base32 form of a SHA-1: five hex digits make four letters."""
    digest = F.sha1(payload)
    letters = []
    for part in range(8):
        value = F.conv(F.substring(digest, 5 * part + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(BASE32), place, 1))
    return F.concat(*letters)


def _hashed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
    ).withColumn("content_key", F.sha2("payload", 256))


def _header(date: str) -> Column:
    """The header block. Characters that would end a line are percent-encoded in a URL."""
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    revisit = F.col("record_type") == "revisit"

    def record(number: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(number.cast("string"), F.lit("")), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record(F.col("page_id"))),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(
                F.coalesce(line("WARC-Refers-To", record(F.col("refers_to"))), F.lit("")),
                line("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line(
            "Content-Length",
            F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string"),
        ),
        F.lit(CRLF),
    )


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    date: str = EPOCH,
) -> None:
    """Write the records of all pages below ``path``: payloads once, headers for each.

    Of the records with equal payloads of ``min_bytes`` or more, the one with
    the largest id is the response and the others revisit it; smaller payloads
    are responses all. A null html is an empty payload, a null url has no
    target line. Rows that share the largest id are responses alike; payloads
    whose ids are all null are responses too. No rows make an empty archive,
    and other columns are not looked at.

    Only digests are shuffled to find the responses; payloads go through one
    shuffle, after each task has put its equal ones together.
    """
    spark = pages.sparkSession
    hashed = _hashed(pages, id_col, url_col, html_col)
    stored = hashed.groupBy("content_key").agg(
        F.first("payload").alias("payload"),
        F.min(F.xxhash64("payload")).alias("least"),
        F.max(F.xxhash64("payload")).alias("most"),
    )
    # The digest is trusted only as far as a second hash agrees on all its payloads.
    same = F.col("least") == F.col("most")
    stored.select(
        "content_key",
        F.when(same, F.col("payload")).otherwise(F.raise_error(F.lit("unequal payloads"))).alias("payload"),
    ).write.mode("overwrite").parquet(f"{path}/payloads")

    keys = hashed.select(
        "page_id",
        "url",
        "content_key",
        F.length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    keys.write.mode("overwrite").parquet(f"{path}/keys")
    keys = spark.read.schema(keys.schema).parquet(f"{path}/keys")
    response = keys.groupBy("content_key").agg(F.max("page_id").alias("response_id"))
    revisits = (F.col("payload_bytes") >= min_bytes) & (F.col("page_id") < F.col("response_id"))
    headers = (
        keys.join(response, "content_key")
        .withColumn("record_type", F.when(revisits, F.lit("revisit")).otherwise(F.lit("response")))
        .withColumn("refers_to", F.when(revisits, F.col("response_id")))
        .select("content_key", F.encode(_header(date), "UTF-8").alias("header"))
    )
    headers.write.mode("overwrite").parquet(f"{path}/headers")


def _field(name: str) -> Column:
    head = F.decode("header", "UTF-8")
    found = F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _number(name: str) -> Column:
    digits = F.regexp_extract(_field(name), r"^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(digits != "", digits.cast("long"))


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    headers = spark.read.schema("content_key string, header binary").parquet(f"{path}/headers")
    payloads = spark.read.schema("content_key string, payload binary").parquet(f"{path}/payloads")
    return headers, payloads


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """What the archive holds of each record: the fields of its header, and size and
    digest of the stored payload, taken from its bytes. A payload that does not
    have the digest it is stored under ends the job."""
    headers, payloads = _parts(spark, path)
    sound = F.sha2("payload", 256) == F.col("content_key")
    measured = payloads.select(
        "content_key",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.when(sound, base32_sha1(F.col("payload")))
        .otherwise(F.raise_error(F.lit("payload does not have its digest")))
        .alias("payload_digest"),
    )
    fields = headers.select(
        "content_key",
        _number("WARC-Record-ID").alias("page_id"),
        _field("WARC-Type").alias("record_type"),
        _number("WARC-Refers-To").alias("refers_to"),
    )
    return fields.join(measured, "content_key").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def original_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record with its header block and full payload, revisits included."""
    headers, payloads = _parts(spark, path)
    return headers.join(payloads, "content_key").select(
        _number("WARC-Record-ID").alias("page_id"),
        _field("WARC-Type").alias("record_type"),
        "header",
        "payload",
    )


def export_warc(spark: SparkSession, path: str, target: str) -> None:
    """Write the archive as plain WARC files: header, payload of responses, two line ends.

    Payloads are UTF-8, so a record is a line of text that ends with CRLF.
    """
    records = original_records(spark, path)
    body = F.when(F.col("record_type") == "response", F.decode("payload", "UTF-8")).otherwise("")
    text = F.concat(F.decode("header", "UTF-8"), body, F.lit(CRLF))
    records.select(text.alias("value")).write.mode("overwrite").option("lineSep", CRLF).text(target)
