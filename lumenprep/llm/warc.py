"""A content-addressed web archive: each payload's bytes once under a verified strong digest, record heads exact and apart.

An archive is two Parquet tables below a path: `heads` (page_id, sha256, head: every byte of the record before the
payload) and `payloads` (sha256, payload). A record is head + payload (none in a revisit) + CRLF CRLF, so joining the two
by digest gives the original records again. Everything is DataFrame code; copies never gather in one task, since payloads
meet by (page_id, sha256) and heads meet payload facts in a join that Spark can split.

Defined results: null html is an empty payload; null url an empty URI; of equal payloads the smallest page_id is the
response (rows that repeat it, too), a null page_id is so only where the group has no other; CR and LF in a URL are
percent-encoded; an empty table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save, ship

CRLF = "\r\n"


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: 8 times 20 bits, 4 digits each."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Writes the archive of pages (page_id, url, html); payloads under min_bytes are never revisits."""
    body = payload(F.col("html"))
    facts = save(
        pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.sha2(body, 256).alias("sha256"), F.sha1(body).alias("sha1"), F.octet_length(body).cast("long").alias("bytes")),
        "warc-facts",
    )
    groups = save(facts.filter(F.col("bytes") >= min_bytes).groupBy("sha256").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "warc-groups")
    typed = facts.join(groups, "sha256", "left").withColumn("revisit", F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))

    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        field("WARC-Record-ID", urn(F.col("page_id"))),
        field("WARC-Target-URI", uri),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        F.when(F.col("revisit"), F.concat(field("WARC-Refers-To", urn(F.col("first"))), field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", (F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))).cast("string")),
        F.lit(CRLF),
        http,
    )
    typed.select("page_id", "sha256", head.alias("head")).write.parquet(f"{path}/heads")
    # The row that stores a payload: the response's; small payloads, which are all responses, are stored once, too.
    if min_bytes:
        keep = facts.groupBy("sha256").agg(F.min("page_id").alias("page_id"))
    else:
        keep = facts.join(groups, "sha256", "left").filter("first IS NULL OR page_id = first")
    none = F.lit(-(1 << 63))
    one = keep.select(F.coalesce("page_id", none).alias("page"), "sha256").distinct()
    bodies = pages.select(F.coalesce("page_id", none).alias("page"), body.alias("payload")).withColumn("sha256", F.sha2("payload", 256))
    # One shuffle of the payloads: the join and the removal of repeated rows have the same keys.
    bodies.join(one, ["page", "sha256"], "left_semi").dropDuplicates(["page", "sha256"]).select("sha256", "payload").write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records: page_id, record_type, refers_to, uri, payload_bytes, payload_digest, payload, head, record.

    Each payload must hash to its address and each head's digest to its payload, else the read fails. Spark reads and
    shuffles only what is selected of it.
    """
    heads = spark.read.parquet(f"{path}/heads")
    body = F.col("payload")
    stored = spark.read.parquet(f"{path}/payloads").select(
        "sha256",
        "payload",
        F.octet_length(body).cast("long").alias("payload_bytes"),
        base32(F.sha1(body)).alias("payload_digest"),
        F.when(F.sha2(body, 256) == F.col("sha256"), True).otherwise(F.raise_error(F.concat(F.lit("not the payload of "), F.col("sha256")))).alias("verified"),
    )
    found = heads.join(stored, "sha256", "left")

    def field(name: str) -> Column:
        return F.regexp_extract("head", f"\\r\\n{name}: ([^\\r]*)\\r\\n", 1)

    def page(name: str) -> Column:
        return F.regexp_extract(field(name), r"^<urn:page:(.*)>$", 1)

    kind = field("WARC-Type")
    good = F.col("verified") & (field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest")))
    return found.select(
        F.nullif(page("WARC-Record-ID"), F.lit("")).cast("long").alias("page_id"),
        F.when(F.coalesce(good, F.lit(False)), kind).otherwise(F.raise_error(F.concat(F.lit("record without its payload: "), F.col("head")))).alias("record_type"),
        F.nullif(page("WARC-Refers-To"), F.lit("")).cast("long").alias("refers_to"),
        field("WARC-Target-URI").alias("uri"),
        "payload_bytes",
        "payload_digest",
        "payload",
        "head",
        F.concat(F.encode("head", "UTF-8"), F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload")), F.lit(b"\r\n\r\n")).alias("record"),
    )


def export_warc(records: DataFrame, path: str, per_file: int = 10_000, gzip: bool = True) -> None:
    """Ordinary WARC files of the column `record` (payloads are UTF-8 text here), through Spark's text writer."""
    body = F.decode("record", "UTF-8")
    writer = records.select(F.substring(body, F.lit(1), F.length(body) - 4).alias("value")).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", per_file)
    (writer.option("compression", "gzip") if gzip else writer).text(path)


def records_of(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(WARC header, block) of each record of an uncompressed WARC file, by its Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        size = next(int(x.split(b":")[1]) for x in data[at:end].split(b"\r\n") if x.lower().startswith(b"content-length:"))
        yield data[at:end], data[end : end + size]
        at = end + size + 4


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """header string and block binary of the records of WARC files (a file a task: their size is export_warc's to bound)."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).filter(~F.col("path").rlike("/[_.][^/]*$")).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            for content in batch.column(0).to_pylist():
                found = list(records_of(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content))
                yield pa.RecordBatch.from_arrays([pa.array([h.decode() for h, _ in found], pa.string()), pa.array([b for _, b in found], pa.binary())], names=["header", "block"])

    return files.mapInArrow(run, "header string, block binary")
