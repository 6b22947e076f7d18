"""A content-addressed web archive: payload bytes once by verified digest, exact record headers beside them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import table
from reviewlake.session import pin, shared_folder

#: Payloads below this many bytes are never replaced by a revisit.
REVISIT_BYTES = 1000
#: Pages carry no fetch time; every record gets this one.
DATE = "1970-01-01T00:00:00Z"
#: Fixed value of the archive format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """One header line; a null value leaves the line out, and line ends inside a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _record_id(page: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"), row, F.lit(">"))


def write_archive(pages: DataFrame, folder: str) -> None:
    """Write `folder`/payloads (one row per distinct payload) and `folder`/headers (one row per record).

    A payload's address is its SHA-256. Rows that share an address must agree in length and SHA-1, else the write
    fails. Of records with equal payloads of at least REVISIT_BYTES, that with the largest page_id (of equal ids,
    the last row) is the response and the others revisit it; a null page_id is the smallest. Null html is an empty
    payload, a null url leaves its header line out. An empty table gives an archive without records.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.monotonically_increasing_id().alias("row"))
    facts = rows.select(
        "page_id",
        "url",
        "row",
        F.octet_length("payload").cast("long").alias("bytes"),
        F.sha1("payload").alias("sha1"),
        F.sha2("payload", 256).alias("address"),
    )
    facts = pin(facts)
    kept = facts.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("address").agg(F.max(F.struct("page_id", "row")).alias("first"))
    records = facts.join(kept, "address", "left")
    revisit = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("row").cast("string"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first.page_id"), F.col("first.row").cast("string")))),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )
    records.select("address", header.alias("header")).write.parquet(f"{folder}/headers")
    proof = F.struct(F.octet_length("payload").alias("bytes"), F.sha1("payload").alias("sha1"))
    stored = rows.groupBy(F.sha2("payload", 256).alias("address")).agg(
        F.first("payload").alias("payload"), F.min(proof).alias("low"), F.max(proof).alias("high")
    )
    agreed = F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(
        F.raise_error(F.lit("two payloads share one address")).cast("binary")
    )
    stored.select("address", agreed.alias("payload")).write.parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Records rebuilt by joining headers to payloads: `record` (the bytes of one WARC record) and `payload`.

    A payload whose bytes don't match its address stops the read. A revisit's record has an empty block; `payload`
    still holds the full payload it stands for.
    """
    payloads = spark.read.parquet(f"{folder}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.lit("a stored payload does not match its address")).cast("binary")
    )
    joined = spark.read.parquet(f"{folder}/headers").join(payloads.select("address", checked.alias("payload")), "address")
    block = F.when(F.col("header").contains("\r\nWARC-Type: revisit\r\n"), F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(F.encode("header", "UTF-8"), block, F.lit(b"\r\n\r\n"))
    return joined.select(record.alias("record"), "payload")


def record_fields(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, parsed from rebuilt records."""
    end = F.expr("instr(decode(record, 'UTF-8'), '\\r\\n\\r\\n')")
    parsed = records.select(F.substring(F.expr("decode(record, 'UTF-8')"), F.lit(1), end + 1).alias("head"), "payload")

    def value(name: str, pattern: str) -> Column:
        found = F.regexp_extract("head", f"\r\n{name}: {pattern}\r\n", 1)
        return F.when(found != "", found)

    return parsed.select(
        value("WARC-Record-ID", "<urn:x-page:(-?[0-9]+):[0-9]+>").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        value("WARC-Type", "([a-z]+)").alias("record_type"),
        value("WARC-Refers-To", "<urn:x-page:(-?[0-9]+):[0-9]+>").cast("long").alias("refers_to"),
    )


def op4_warc(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(table(spark, sf_dir, "pages"), folder)
    return record_fields(read_archive(spark, folder))
