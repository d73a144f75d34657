"""Content-addressed WARC archive: each payload once, every record's exact header apart.

An archive is two tables below one folder of the shared store:

``payloads``  one row per distinct payload: ``digest`` (SHA-256, the key), ``payload``
``headers``   one row per record: ``header`` (the exact bytes before the payload),
              ``digest`` of the payload it stands for

A record is its header, its payload (none in a revisit) and two line ends; the join on
``digest`` gives all of it back, for a revisit also the content that it refers to.
The digest is checked against the bytes on the way in (two texts under one digest would
differ in length or SHA-1) and again on the way out; a mismatch raises.

Defined cases: a null text is an empty payload. A null url leaves its header line out,
line ends inside a url are percent-encoded. Rows that repeat the winner's page_id with the
same payload are responses too. A null page_id is never a winner unless all of a group
are null. Extra columns are ignored. An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.session import scratch_path

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary ``data``: 160 bits are 32 digits, no padding."""
    text = F.sha1(data)
    parts = [(1, 15, 12), (16, 15, 12), (31, 10, 8)]
    digits = [F.lpad(F.upper(F.conv(F.substring(text, at, n), 16, 32)), width, "0") for at, n, width in parts]
    return F.translate(F.concat(*digits), _DIGITS, _BASE32)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), page_id.cast("string"), F.lit(">"))


def archive_write(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", min_bytes: int = 0) -> None:
    """Archive ``page_id``, ``url``, ``html`` below ``path``, which must not exist.

    Of the records with one payload of at least ``min_bytes``, the one with the largest
    page_id is the response and the others revisit it.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id",
        "url",
        "payload",
        F.sha2("payload", 256).alias("digest"),
        base32_sha1(F.col("payload")).alias("sha1"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    same = (F.min("bytes") == F.max("bytes")) & (F.min("sha1") == F.max("sha1"))
    clash = F.raise_error(F.concat(F.lit("two payloads under one digest: "), F.col("digest")))
    # Copies fold in their tasks before the exchange, however many a payload has.
    stored = rows.groupBy("digest").agg(F.first("payload").alias("payload"), same.alias("same"))
    stored.select("digest", F.when(F.col("same"), F.col("payload")).otherwise(clash.cast("binary")).alias("payload")).write.option(
        "compression", "zstd"
    ).parquet(f"{path}/payloads")

    # The narrow rows come from a scan of their own, so payloads take part in one exchange only.
    narrow = rows.drop("payload")
    winners = narrow.groupBy(F.col("digest").alias("of")).agg(F.max("page_id").alias("winner"))
    joined = narrow.join(winners, F.col("digest") == F.col("of"))
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("winner"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _urn(F.col("winner"))), _line("WARC-Profile", F.lit(_REVISIT)))).otherwise(""),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        F.lit(_END),
    )
    joined.select(F.encode(header, "UTF-8").alias("header"), "digest").write.parquet(f"{path}/headers")


def archive_read(spark: SparkSession, path: str) -> DataFrame:
    """Records as ``header``, ``payload`` (of a revisit: what it refers to), ``record`` (the exact bytes)."""
    headers = spark.read.schema("header binary, digest string").parquet(f"{path}/headers")
    stored = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("stored payload does not match its digest: "), F.col("digest")))
    checked = stored.select(
        F.col("digest").alias("of"),
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(wrong.cast("binary")).alias("payload"),
    )
    joined = headers.join(checked, F.col("digest") == F.col("of"), "left")
    missing = F.raise_error(F.concat(F.lit("no payload for digest: "), F.col("digest"))).cast("binary")
    payload = F.coalesce("payload", missing)
    own = F.when(header_field(F.col("header"), "WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("header", payload.alias("payload")).withColumn(
        "record", F.concat(F.col("header"), own, F.lit(b"\r\n\r\n"))
    )


def header_field(header: Column, name: str) -> Column:
    """The value of a header line, null where the line is missing."""
    found = F.regexp_extract(F.decode(header, "UTF-8"), rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def page_of(urn: Column) -> Column:
    return F.nullif(F.regexp_extract(urn, r"^<urn:x-page:(-?[0-9]+)>$", 1), F.lit("")).cast("long")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, read the records back and describe them."""
    path = scratch_path(spark, "warc")
    archive_write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    records = archive_read(spark, path)
    header = F.col("header")
    return records.select(
        page_of(header_field(header, "WARC-Record-ID")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        header_field(header, "WARC-Type").alias("record_type"),
        page_of(header_field(header, "WARC-Refers-To")).alias("refers_to"),
        F.octet_length("record").cast("long").alias("record_bytes"),
    )


#: record_bytes counts the header lines above, so the SQL spells their lengths out.
WARC_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
d AS (
  SELECT page_id, url, sha1(payload) AS hex, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
         max(page_id) OVER (PARTITION BY sha256(payload)) AS winner
  FROM p),
b AS (
  SELECT *, list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform(range(4), lambda k:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST(1 + ((CAST('0x' || substr(hex, CAST(5 * g + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * k)) & 31) AS BIGINT), 1)),
      'string_agg', '')), 'string_agg', '') AS payload_digest,
    page_id IS DISTINCT FROM winner AS again
  FROM d),
h AS (
  SELECT *, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: ', CASE WHEN again THEN 'revisit' ELSE 'response' END,
    chr(13), chr(10), 'WARC-Record-ID: <urn:x-page:', page_id, '>', chr(13), chr(10),
    'WARC-Date: 1970-01-01T00:00:00Z', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10),
    'WARC-Payload-Digest: sha1:', payload_digest, chr(13), chr(10),
    CASE WHEN again THEN concat('WARC-Refers-To: <urn:x-page:', winner, '>', chr(13), chr(10),
      'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest', chr(13), chr(10)) ELSE '' END,
    'Content-Type: text/html; charset=utf-8', chr(13), chr(10),
    'Content-Length: ', CASE WHEN again THEN 0 ELSE payload_bytes END, chr(13), chr(10), chr(13), chr(10)) AS header
  FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN winner END AS refers_to,
  CAST(octet_length(encode(header)) + CASE WHEN again THEN 0 ELSE payload_bytes END + 4 AS BIGINT) AS record_bytes
FROM h
"""
