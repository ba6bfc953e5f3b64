"""SpotSigs fingerprints, in DataFrame functions only: chains of content words that follow common-word anchors.

Words are runs of letters and digits in small letters. At each common word (the anchor) the next `CHAIN` words that are
no common words, found within the next `LOOK` words, form a signature (anchor, chain); a text's fingerprint is the set of
its signatures' hashes. A text with no such chain takes all pairs of neighbouring words instead (one word: itself).
Likeness is the Jaccard similarity of sets; sets whose lengths differ by more than the threshold allows are never
compared: length partitions and the length bound prune them.

Defined results: null text is empty; a text without words has an empty fingerprint, equal to any other empty one
(likeness 1) and unlike all others (0); of rows with equal doc_id the smaller text comes first and each has its row; a null
doc_id comes last; a single document is its own next one; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save
from .links import joined, members_of

# Common words of English, French, German and Spanish.
COMMON = (
    "the of and a to in is it that for on as was with be by this are from or an at not have has he she they you we but his her "
    "la de le et les des en une un du que qui dans pour sur pas est au aux ce se ne par plus il elle "
    "der die und das den von zu mit sich dem ein eine nicht auf ist im für als auch es an "
    "el los las y por con del al una su lo no como más o si para"
).split()
CHAIN, LOOK = 2, 12


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with the sorted distinct signatures of a text as array<int>. The words are a column of their own, so that they are cut once."""
    w = F.col("__words")

    def common(x: Column) -> Column:
        return x.isin(*sorted(set(COMMON)))

    def chain(i: Column) -> Column:
        return F.filter(F.slice(w, i + 2, LOOK), lambda x: ~common(x))

    anchored = F.filter(F.transform(w, lambda x, i: F.when(common(x), F.struct(x.alias("anchor"), F.slice(chain(i), 1, CHAIN).alias("chain")))), lambda s: s.isNotNull() & (F.size(s["chain"]) == CHAIN))
    spots = F.transform(anchored, lambda s: F.hash(s["anchor"], s["chain"]))
    pairs = F.transform(w, lambda x, i: F.hash(F.lit(""), F.slice(w, i + 1, 2)))
    pairs = F.when(F.size(w) < 2, pairs).otherwise(F.slice(pairs, F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))))
    return (
        df.withColumn("__words", words(F.col(text)))
        .withColumn("__spots", spots)
        .withColumn(out, F.sort_array(F.array_distinct(F.when(F.size("__spots") > 0, F.col("__spots")).otherwise(pairs))))
        .drop("__words", "__spots")
    )


def fingerprint(signatures: Column) -> Column:
    return F.array_join(signatures.cast("array<string>"), " ")


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Of two sets; 0 without a comparison where their lengths alone keep it under `least`."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return F.when(large == 0, 1.0).when((small == 0) | (small < least * large), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text and others) with next: the struct of all columns of the document before it by doc_id, after the least the greatest.

    Rows are dealt into ranges of doc_id and ordered there; each range also gets the first row of the next range, so no
    window spans the table. Only the ranges' ends (at most 4096 numbers) reach the driver.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("__k", F.coalesce("doc_id", F.lit(-(1 << 63))))
    n = min(4096, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = keyed.agg(F.percentile_approx("__k", [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))
    bounds = F.array(*map(F.lit, cuts)).cast("array<bigint>")
    keyed = keyed.withColumn("__range", F.size(F.filter(bounds, lambda b: b < F.col("__k"))) if cuts else F.lit(0))
    tops = [tuple(r) for r in keyed.groupBy("__range").agg(F.max("__k")).orderBy("__range").collect()]
    ends = spark.createDataFrame([(tops[i - 1][1], tops[i][0]) for i in range(len(tops))], "__top long, __to int")
    borrowed = keyed.join(F.broadcast(ends), F.col("__k") == F.col("__top")).withColumn("__range", F.col("__to")).drop("__top", "__to")
    both = keyed.withColumn("__borrowed", F.lit(0)).unionByName(borrowed.withColumn("__borrowed", F.lit(1)))
    order = Window.partitionBy("__range").orderBy("__borrowed", F.col("__k").desc(), "text")
    return both.withColumn("next", F.lead(F.struct(*docs.columns)).over(order)).filter("__borrowed = 0").select(*docs.columns, "next")


def edited(text: Column, following: Column) -> Column:
    """text with its last floor(n/2) code points replaced by the first as many of `following`."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def classes(docs: DataFrame, threshold: float = 0.44) -> DataFrame:
    """doc_id and class_id (least doc_id): documents whose fingerprints have a Jaccard similarity of at least `threshold`, transitively.

    Sets are partitioned by length, p(i+1) = p(i)/threshold: a set meets those of the partitions its similar ones can lie
    in, on its n - ceil(threshold n) + 1 least hashes (two similar sets share one of these).
    """
    signed = save(with_signatures(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "s").select("doc_id", F.sha2(fingerprint(F.col("s")), 256).alias("node"), "s"), "spots")
    nodes = save(signed.groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.first("s").alias("s")).withColumn("n", F.size("s")), "spot-nodes")

    def part(n: Column) -> Column:
        return F.floor(F.log(n + 1e-9) / F.log(F.lit(1 / threshold)))

    parts = F.sequence(part(F.ceil(F.lit(threshold) * F.col("n") - 1e-9)), part(F.col("n")))
    prefix = F.slice("s", F.lit(1), F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1)
    rows = nodes.filter("n > 0").select("node", F.struct("copies", "n").alias("at"), F.explode(prefix).alias("h"), parts.alias("parts")).select(F.explode("parts").alias("p"), "h", F.col("node").alias("id"), "at").select(F.xxhash64("p", "h").alias("key"), "id", "at")
    sets = nodes.select("node", "s")

    def possible(x: Column, y: Column) -> Column:
        return F.least(x["n"], y["n"]) >= threshold * F.greatest(x["n"], y["n"])

    def verify(pairs: DataFrame) -> DataFrame:
        x, y = sets.select(F.col("node").alias("a"), F.col("s").alias("x")), sets.select(F.col("node").alias("b"), F.col("s").alias("y"))
        return pairs.join(x, "a").join(y, "b").filter(jaccard(F.col("x"), F.col("y"), threshold) >= threshold).select("a", "b")

    roots = joined(members_of(rows.distinct()), [-F.col("at.copies")], possible, verify)
    rooted = nodes.select("node", "first").join(roots.withColumnRenamed("id", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = save(rooted.groupBy("root").agg(F.min("first").alias("class_id")), "spot-firsts")
    named = save(rooted.join(firsts, "root").select("node", "class_id"), "spot-classes")
    return signed.select("doc_id", "node").join(named, "node", "left").select("doc_id", "class_id")
