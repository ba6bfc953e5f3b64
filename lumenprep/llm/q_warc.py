"""Query of the archive and its SQL."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from . import warc
from .common import shared_dir, table


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri")


PART = "lpad(to_base(CAST(('0x' || substr(s, {}, 5)) AS BIGINT), 32), 4, '0')"
OP3_SQL = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, url, html, sha1(html) AS s, min(page_id) OVER (PARTITION BY html) AS first, count(*) OVER (PARTITION BY html) AS n FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  translate({" || ".join(PART.format(5 * i + 1) for i in range(8))}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to,
  replace(replace(url, chr(13), '%0D'), chr(10), '%0A') AS uri
FROM f"""
