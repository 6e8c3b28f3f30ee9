"""Content-addressed WARC archive.

Payload bytes are stored once per verified SHA-256 digest; the exact header block of every record is kept in a
table of its own. Records are rebuilt by joining headers with payloads. Writing groups whole
payloads by (digest, payload) map-side first, so copies shrink before the shuffle, and two payloads
under one digest would be seen. Reading recomputes each stored payload's digest and length.

Defined results: a null payload counts as empty; a null url is written without WARC-Target-URI; of equal
payloads of at least ``min_bytes`` bytes, rows with the smallest id are responses (identical ids
can't be told apart, so each is one) and the others revisits; null ids rank last; an empty table
gives an empty archive; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrospark.llm.common import lookup, scratch, written

CRLF = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _field(name: str, value: Column) -> Column:
    """``Name: value`` with its line end; nothing where the value is null. Line breaks in a value would forge fields."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), "[\r\n]", ""), F.lit(CRLF))).otherwise("")


def _uuid(*cols: Column) -> Column:
    m = F.md5(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols]))
    at = lambda i, n: F.substring(m, i, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", at(1, 8), at(9, 4), at(13, 4), at(17, 4), at(21, 12)), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 100, date: str = "2020-01-01T00:00:00Z") -> None:
    """Write ``path/payloads`` (digest, payload, n_refs, first_id) and ``path/headers`` (one row per record)."""
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    stored = rows.groupBy("digest", "payload").agg(F.count("*").alias("n_refs"), F.min("id").alias("first_id"))
    stored.write.parquet(f"{path}/payloads")
    spark = pages.sparkSession
    kept = spark.read.parquet(f"{path}/payloads")
    refs = written(kept.select("digest", "n_refs", "first_id", F.octet_length("payload").cast("long").alias("n")), "warc-refs")
    if refs.groupBy("digest").count().filter("count > 1").limit(1).count():
        raise ValueError("two payloads share a digest")
    got = lookup(rows.select("id", "url", "digest"), refs, ["digest"], "n_refs", ["id", "url"])
    is_response = (F.col("n") < min_bytes) | F.col("id").eqNullSafe(F.col("first_id"))
    head = lambda kind, length, *more: F.concat(F.lit(f"WARC/1.1{CRLF}"), _field("WARC-Type", F.lit(kind)),
        _field("WARC-Record-ID", _uuid(F.col("id"), F.col("url"))), _field("WARC-Date", F.lit(date)), _field("WARC-Target-URI", F.col("url")),
        *more, _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), _field("X-Page-ID", F.col("id")),
        _field("Content-Type", F.lit("text/html")), _field("Content-Length", length), F.lit(CRLF))
    first = F.when(~is_response, F.col("first_id"))
    header = F.when(is_response, head("response", F.col("n"))).otherwise(
        head("revisit", F.lit(0), _field("WARC-Profile", F.lit(REVISIT)), _field("X-Refers-To-Page", first)))
    got.select("id", F.col("digest").alias("block"), header.cast("binary").alias("header")).write.parquet(f"{path}/headers")


def header_field(header: Column, name: str) -> Column:
    """Value of a named field of a header block (null where it is missing)."""
    v = F.regexp_extract(header.cast("string"), rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(v != "", v)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, rebuilt from its header block and the payload it names.

    ``id, record_type, refers_to, payload_digest, payload_bytes, verified, header, payload, record``:
    ``record`` holds the record's exact bytes (a revisit's has no payload), ``verified`` that
    the stored payload has the digest that the header names and, in a response, the length.
    """
    blocks = spark.read.parquet(f"{path}/payloads").select(
        F.col("digest").alias("block"), "n_refs", F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), "payload")
    got = lookup(spark.read.parquet(f"{path}/headers"), blocks, ["block"], "n_refs", ["id", "header"])
    kind, length = header_field(F.col("header"), "WARC-Type"), header_field(F.col("header"), "Content-Length").cast("long")
    ok = ((header_field(F.col("header"), "WARC-Payload-Digest") == F.concat(F.lit("sha256:"), F.col("payload_digest")))
          & ((kind == "revisit") | (length == F.col("payload_bytes"))))
    end = F.lit(CRLF * 2).cast("binary")
    return got.select(
        header_field(F.col("header"), "X-Page-ID").cast("long").alias("id"), kind.alias("record_type"),
        header_field(F.col("header"), "X-Refers-To-Page").cast("long").alias("refers_to"), "payload_digest", "payload_bytes",
        F.coalesce(ok, F.lit(False)).alias("verified"), "header", "payload",
        F.concat(F.col("header"), F.when(kind == "response", F.col("payload")).otherwise(F.lit("").cast("binary")), end).alias("record"))


def export_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write the records' exact bytes as WARC files, one per partition.

    The text sink writes a string's bytes as they are, followed by the line separator; each record ends in CRLF CRLF, so
    that is the separator and the record goes without it.
    """
    body = F.expr("substring(record, 1, octet_length(record) - 4)").cast("string").alias("value")
    records.select(body).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read its records back."""
    path = scratch(pages.sparkSession, "warc")
    write_archive(pages, path, **options)
    return read_archive(pages.sparkSession, path)
