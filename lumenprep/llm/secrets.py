"""Secret scanning with corpus-wide ownership frequency.

Base spans come from three fixed patterns. The method adds spans of kind `token`: strings of 20 or more credential
characters with a digit, a capital, a small letter and high entropy, which are no base span, and which the whole corpus
shows under one owner only. Every candidate's hash is counted over all rows by distinct repository (`source`) and owner
(what stands before its "/"): a value that several owners show is a copied example, one that a single owner shows and that
looks random is live-looking.

Defined results: null text is empty and has no spans; a null source is the owner ""; repeated rows each have their spans
and count as one repository; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, hold, save, ship

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "token")
WORDS = ("passw", "secret", "token", "api")
LONG = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
SPAN = "array<struct<kind:string,start:int,end:int,hash:string,entropy:double>>"


def entropy(s: str) -> float:
    """Bits a character."""
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0


def candidates(text: str, least_entropy: float = 3.5) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then kind: all base spans, and strings that may become added ones."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    base = sorted((a, b) for _, a, b, _ in found)
    for m in LONG.finditer(text):
        s, (a, b) = m[0], m.span()
        if re.search("[0-9]", s) and re.search("[A-Z]", s) and re.search("[a-z]", s) and entropy(s) >= least_entropy and not any(x < b and a < y for x, y in base):
            found.append(("token", a, b, s))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, source, and the candidates of each text as found array<struct<kind,start,end,hash,entropy>>."""
    ship(docs.sparkSession)
    source = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "text")
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.string()), ("entropy", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(__name__)
        for batch in batches:
            for first, end, texts in chunks(batch, "text"):
                rows = [[{"kind": k, "start": a, "end": b, "hash": hashlib.sha256(v.encode()).hexdigest(), "entropy": entropy(v)} for k, a, b, v in candidates(x)] for x in texts]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, end - first).columns[:2], pa.array(rows, arrow)], names=["doc_id", "source", "found"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, source string, found {SPAN}")


def ownership(found: DataFrame) -> DataFrame:
    """hash, repositories, owners, occurrences: first by (hash, repository), so that no hash gathers its rows in one task."""
    pairs = found.groupBy("hash", "source").agg(F.count("*").alias("n"))
    return (
        pairs.groupBy("hash", F.substring_index("source", "/", 1).alias("owner"))
        .agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
        .groupBy("hash")
        .agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"), F.sum("n").alias("occurrences"))
    )


def verdict(owners: Column, bits: Column, copied: int, live_bits: float) -> Column:
    return F.when(owners >= copied, "example").when((owners == 1) & (bits >= live_bits), "live").otherwise("unclear")


def find_secrets(docs: DataFrame, copied: int = 3, live_bits: float = 3.0) -> DataFrame:
    """doc_id and secrets array<struct<start,rank,kind,end,hash,repositories,owners,verdict>> by start, then kind: a row for each row of docs."""
    scanned = save(scan(docs).withColumn("row", F.monotonically_increasing_id()), "secrets")
    each = scanned.filter("size(found) > 0").select("row", "source", F.explode("found").alias("c")).select("row", "source", "c.*")
    counts = save(ownership(each), "secret-owners")
    judged = each.join(counts, "hash").withColumn("verdict", verdict(F.col("owners"), F.col("entropy"), copied, live_bits)).filter("kind <> 'token' OR owners = 1")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    per_row = judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end", "hash", "repositories", "owners", "verdict"))).alias("secrets"))
    some = scanned.filter("size(found) > 0").select("row", "doc_id").join(per_row, "row", "left").select("doc_id", "secrets")
    none = scanned.filter("size(found) = 0").select("doc_id", F.lit(None).cast(per_row.schema["secrets"].dataType).alias("secrets"))
    return some.unionByName(none).withColumn("secrets", F.coalesce("secrets", F.array().cast(per_row.schema["secrets"].dataType)))
