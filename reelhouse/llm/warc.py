"""Deduplicated WARC archives by revisit resolution.

Payload digests are shuffled without the payloads: records with equal digests elect the one with
the least page id as response, the others revisit it. The decision is then joined to the
payloads by page id, so no task ever gathers the payloads of one digest. Archives are written by
Spark's own text writer, whose separator is the end of a WARC record, gzip-compressed; every
record names the archive it belongs to (WARC-Warcinfo-ID) right after its version line, and that
line pair is what the reader splits at, so records are read in parallel, one at a time.
An archive's folder is named by its id, which is drawn after the payloads exist and so cannot occur in them.

Defined cases: a null payload is empty; payloads under `MIN_BYTES` bytes are never revisited. Null page ids
come after all others; if all records of a digest have none, all are responses. Rows that
repeat the elected page id are all responses. A null url has no target URI; line breaks in a url are percent-encoded.
Columns besides those named are not archived.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import sha256_hex, whole
from reelhouse.session import joinable, run_dir, staged

MIN_BYTES = 100
VERSION = "WARC/1.1"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, digest, original_id, original_url) of the pages that repeat another's payload."""
    heads = _digested(pages).where(F.col("payload_bytes") >= min_bytes)
    heads = heads.select("page_id", "url", "digest")
    elected = (
        heads.where("page_id is not null")
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("page_id", "url")).alias("original"),
        )
        .select(
            "digest",
            F.col("original.page_id").alias("original_id"),
            F.col("original.url").alias("original_url"),
        )
    )
    return (
        heads.drop("url")
        .join(joinable(elected), "digest")
        .where("page_id is null or page_id > original_id")
        .distinct()
    )


def _digested(pages: DataFrame) -> DataFrame:
    payload = whole("html")
    return pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        sha256_hex(payload).alias("digest"),
    )


def write_archives(
    pages: DataFrame, root: str, date: str | None = None, min_bytes: int = MIN_BYTES
) -> str:
    """Write one record per page below `root`; returns the archive's folder."""
    archive = str(uuid.uuid4())
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    again = revisits(pages, min_bytes).withColumnsRenamed({"page_id": "_page", "digest": "_digest"})
    decided = _digested(pages).join(
        again,
        F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")),
        "left",
    )
    path = f"{root.rstrip('/')}/{archive}"
    (
        decided.select(_record(archive, date).alias("value"))
        .write.option("lineSep", CRLF * 2)
        .option("compression", "gzip")
        .text(path)
    )
    return path


def _record(archive: str, date: str) -> Column:
    revisit = F.col("original_id").isNotNull()
    block = F.when(revisit, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), "payload"))
    digest = F.col("digest")

    def header(name: str, value: Column) -> Column:
        """Nothing at all where the value is null."""
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    return F.concat(
        F.lit(_mark(archive)),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", _record_id(archive, F.col("page_id"), digest)),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", _one_line("url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        header("WARC-Refers-To", F.when(revisit, _record_id(archive, F.col("original_id"), digest))),
        header("WARC-Refers-To-Target-URI", F.when(revisit, _one_line("original_url"))),
        header("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        header("X-Page-ID", F.col("page_id").cast("string")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
    )


def _mark(archive: str) -> str:
    return f"{VERSION}{CRLF}WARC-Warcinfo-ID: <urn:uuid:{archive}>{CRLF}"


def _one_line(url: str) -> Column:
    return F.replace(F.replace(F.col(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(archive: str, page_id: Column, digest: Column) -> Column:
    """A UUID made from what identifies the record, so that a rerun of a task writes the same."""
    h = F.md5(F.concat_ws("|", F.lit(archive), F.coalesce(page_id.cast("string"), F.lit("")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_type, record_id, page_id, url, refers_to, digest, payload) of all records.

    `payload` is null in a revisit. A record whose block has not the stated length stops the read.
    """
    mark = _mark(path.rstrip("/").rsplit("/", 1)[1])
    raw = spark.read.option("lineSep", mark).text(path).where("value != ''")
    end = CRLF * 2
    head = F.substring_index("value", end, 1)
    parts = raw.select(
        "value", F.str_to_map(head, F.lit(CRLF), F.lit(": ")).alias("h"), F.length(head).alias("n")
    )
    block = F.expr(f"substring(value, n + {len(end) + 1}, length(value) - n - {2 * len(end)})")
    stated = F.col("h")["Content-Length"].cast("long")
    checked = F.when(F.octet_length("block") == stated, F.col("block")).otherwise(
        F.raise_error(F.concat(F.lit("broken record "), F.col("h")["WARC-Record-ID"])).cast("string")
    )
    response = F.col("h")["WARC-Type"] == "response"
    return parts.withColumn("block", block).select(
        F.col("h")["WARC-Type"].alias("record_type"),
        F.col("h")["WARC-Record-ID"].alias("record_id"),
        F.col("h")["X-Page-ID"].cast("long").alias("page_id"),
        F.col("h")["WARC-Target-URI"].alias("url"),
        F.col("h")["WARC-Refers-To"].alias("refers_to"),
        F.expr("substring(h['WARC-Payload-Digest'], 8)").alias("digest"),
        F.when(response, F.substring(checked, len(HTTP_HEAD) + 1, 2**31 - 1)).alias("payload"),
    )


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive with the length and digest of its full payload.

    A revisit takes both from the response it refers to.
    """
    heads = staged(
        read_archives(spark, path).select(
            "record_type",
            "record_id",
            "page_id",
            "refers_to",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.when(F.col("payload").isNotNull(), sha256_hex(F.col("payload"))).alias("payload_digest"),
        ),
        "warc-heads",
    )
    responses = heads.where("record_type = 'response'")
    originals = responses.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min("page_id").alias("original_id"),
        F.min("payload_bytes").alias("payload_bytes"),
        F.min("payload_digest").alias("payload_digest"),
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    again = heads.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        again.join(joinable(originals), "refers_to").select(
            *columns, F.col("original_id").alias("refers_to")
        )
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back, resolved."""
    spark = pages.sparkSession
    return resolved(spark, write_archives(pages, run_dir(spark, "warc")))
