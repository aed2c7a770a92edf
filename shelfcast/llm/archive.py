"""Content-addressed WARC archive: every payload once, every record's headers apart, records rebuilt by joins.

``write_archive`` makes two tables in one folder. ``headers`` has a row per record with its exact WARC and HTTP header bytes
and the key of its payload; ``payloads`` has each different payload once under that key, its SHA-256 digest.
``read_archive`` joins them and recomputes both digests of every payload that it hands out. ``record`` of a restored row is the
record as it stands in a WARC file, and ``write_warc`` puts the records into such files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.session import new_path

CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(CRLF))


def _one_line(value: Column) -> Column:
    """A value on one line: control characters and spaces as percent codes, null as nothing."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    clean = text
    for code in (*range(33), 127):
        clean = F.replace(clean, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(text.rlike(r"[\x00-\x20\x7F]"), clean).otherwise(text)


def write_archive(
    pages: DataFrame,
    path: str | None = None,
    min_revisit_bytes: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
    id_column: str = "page_id",
    url: str = "url",
    payload: str = "html",
) -> str:
    """Writes ``pages`` as an archive and returns its folder (by default one in the session's shared folder).

    Of records with equal payloads of at least ``min_revisit_bytes``, the one with the largest id is a response and the
    others are revisits that refer to it; smaller payloads are all responses. A null payload is empty; a null url is an
    empty target; a record with a null id has an empty id and is a response only if no equal payload has an id. Repeated
    rows with the largest id are all responses. Other columns are left out; an empty table makes an empty archive.

    Payloads move once at most: only keys are shuffled to find equal ones, and the owners of equal payloads are
    joined back by a measured broadcast or a skew-safe shuffle.
    """
    spark = pages.sparkSession
    folder = path or new_path(spark, "archive")
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{url}`").alias("url"),
        body.alias("payload"),
        F.sha2(body, 256).alias("payload_key"),
    )
    groups = rows.groupBy("payload_key").agg(F.count(F.lit(1)).alias("records"), F.max("id").alias("owner"))
    rows = attach(rows, groups.filter("records > 1").drop("records").withColumn("several", F.lit(True)), ["payload_key"])
    several = F.coalesce("several", F.lit(False))
    size = F.octet_length("payload").cast("long")
    revisit = several & (size >= min_revisit_bytes) & F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}"),
        _line("Content-Type", "text/html; charset=utf-8"),
        _line("Content-Length", size.cast("string")),
        F.lit(CRLF),
    )
    block = F.octet_length("http_header") + F.when(F.col("revisit"), 0).otherwise(F.octet_length("payload"))
    warc = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), _one_line(F.col("id")), F.lit(">"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", _one_line(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        F.when(
            F.col("revisit"),
            F.concat(
                _line("WARC-Profile", REVISIT_PROFILE),
                _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), _one_line(F.col("owner")), F.lit(">"))),
            ),
        ).otherwise(""),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", block.cast("string")),
        F.lit(CRLF),
    )
    headers = rows.withColumn("revisit", revisit).withColumn("http_header", http).select(
        "id", warc.alias("warc_header"), "http_header", "payload_key"
    )
    headers.write.parquet(f"{folder}/headers")
    alone = rows.filter(~several).select("payload_key", "payload")
    owned = rows.filter(several & F.col("id").eqNullSafe(F.col("owner"))).select("payload_key", "payload")
    alone.unionByName(owned.dropDuplicates(["payload_key"])).write.parquet(f"{folder}/payloads")
    return folder


def _field(name: str) -> Column:
    return F.regexp_extract("warc_header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive, one row each.

    ``id, record_type, target, refers_to`` (text of an id, else null), ``payload_digest`` (hex SHA-1), ``payload_bytes, payload``
    (full, of revisits too) and ``record``, the exact record: headers, the payload unless it is a revisit, and the blank
    lines at its end. A payload that does not have its digests, or is missing, ends the job with an error.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads")
    joined = headers.join(payloads, "payload_key", "left")
    stated = F.regexp_extract("warc_header", r"\r\nWARC-Payload-Digest: sha1:([0-9a-f]{40})\r\n", 1)
    sound = (F.sha2("payload", 256) == F.col("payload_key")) & (F.sha1("payload") == stated)
    checked = F.when(F.coalesce(sound, F.lit(False)), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not have the digest "), F.col("payload_key")))
    )
    kind = _field("WARC-Type")
    refers = F.regexp_extract("warc_header", r"\r\nWARC-Refers-To: <urn:page:([^\r]*)>\r\n", 1)
    whole = F.concat("warc_header", "http_header", F.when(kind == "revisit", "").otherwise(F.col("payload")), F.lit(CRLF + CRLF))
    return joined.withColumn("payload", checked).select(
        "id",
        kind.alias("record_type"),
        _field("WARC-Target-URI").alias("target"),
        F.when(kind == "revisit", refers).alias("refers_to"),
        stated.alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload",
        whole.alias("record"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """The restored records as WARC files, one per partition."""
    ended = F.expr("substring(record, 1, length(record) - 4)")
    records.select(ended.alias("value")).write.option("lineSep", CRLF + CRLF).text(path)
