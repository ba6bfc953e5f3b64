"""Links between members of hash buckets, and connected components: no group is gathered in a task, none expanded into all pairs.

Each bucket has a hub; members that possible() allows are verified against it, one candidate a member and bucket. What
that joins is one component and needs no further link among itself. Only members of one bucket that are still in different
components, and that possible() allows, are then verified with each other. So two members of a bucket that verify()
accepts always end in one component, whatever the bucket's size; possible() must allow every pair that verify() accepts,
and the sharper it is, the fewer candidates there are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, maybe_in, save


def members_of(rows: DataFrame) -> DataFrame:
    """The rows (key long, id and others; each once) of buckets with more than one member, written.

    Keys alone are counted first; a bitmap of those that occur again keeps most other rows out of the second shuffle.
    """
    several = save(rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select("key"), "keys")
    out = save(maybe_in(rows, F.col("key"), several).filter("__maybe").drop("__maybe").join(several, "key"), "members")
    drop(several)
    return out


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def joined(members: DataFrame, hub_order: list[Column], possible: Callable[[Column, Column], Column], verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, root), written, of all that is joined to another. members: key, id and `at`, a struct of what possible(at, at)
    and hub_order (least first) look at."""
    alone = members.withColumn("root", F.col("id"))
    stars = save(verify(near_hubs(alone, hubs_of(alone, ["key"], hub_order), ["key"], possible)), "star-links")
    first = merged(None, stars)
    rooted = save(members.join(first, "id", "left").select("key", "id", "at", F.coalesce("root", "id").alias("root")), "rooted")
    still = rooted.groupBy("key").agg(F.min("root").alias("l"), F.max("root").alias("g")).filter("l <> g").select("key")
    open_rows = save(rooted.join(still, "key"), "open-rows")
    # All buckets of a member (as many as it has keys): a pair is made in the first bucket that both are in, and in no other.
    parted = save(open_rows.join(open_rows.groupBy("id").agg(F.collect_set("key").alias("keys")), "id"), "parted")
    x = parted.select("key", F.col("id").alias("a"), F.col("at").alias("x"), F.col("root").alias("rx"), F.col("keys").alias("kx"))
    y = parted.select("key", F.col("id").alias("b"), F.col("at").alias("y"), F.col("root").alias("ry"), F.col("keys").alias("ky"))
    once = F.array_min(F.array_intersect("kx", "ky")) == x["key"]
    across = x.join(y, (x["key"] == y["key"]) & (F.col("rx") < F.col("ry")) & possible(F.col("x"), F.col("y")) & once).select("a", "b")
    rest = save(verify(ordered(across)), "cross-links")
    out = merged(first, rest)
    drop(stars, first, rooted, open_rows, parted, rest)
    return out


def hubs_of(rooted: DataFrame, by: list[str], hub_order: list[Column]) -> DataFrame:
    """by, hub (id, at, root): of each bucket the member that is least by hub_order."""
    return rooted.groupBy(*by).agg(F.min_by(F.struct("id", "at", "root"), F.struct(*hub_order, "id")).alias("hub"))


def near_hubs(rooted: DataFrame, hubs: DataFrame, by: list[str], possible: Callable[[Column, Column], Column]) -> DataFrame:
    """(a, b): each member with its bucket's hub, where possible() allows it and their roots differ."""
    near = rooted.join(hubs, by).filter((F.col("root") != F.col("hub.root")) & possible(F.col("at"), F.col("hub.at")))
    return ordered(near.select(F.col("hub.id").alias("a"), F.col("id").alias("b")))


def link(members: DataFrame, hub_order: list[Column], possible: Callable[[Column, Column], Column], verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (a, b), a < b, that join what joined() joins."""
    return joined(members, hub_order, possible, verify).filter("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b"))


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, root), written: components of links (a, b) and of what `roots` (id, root) has joined already."""
    if roots is None:
        return save(components(links), "roots")
    x, y = roots.toDF("a", "x"), roots.toDF("b", "y")
    between = ordered(links.join(x, "a", "left").join(y, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")).filter("a <> b"))
    between = save(between, "between")
    new = save(components(between), "new-roots")
    old = roots.join(new.toDF("root", "above"), "root", "left").select("id", F.coalesce("above", "root").alias("root"))
    out = save(old.unionByName(new.join(roots.select("id"), "id", "left_anti").select("id", "root")), "roots")
    drop(between, new)
    return out


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every end of a link: root is the least id of its component. Large stars and small stars in turn until all are stars."""

    def stars(edges: DataFrame, large: bool) -> DataFrame:
        pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
        least = save(pairs.groupBy("b").agg(F.min("a").alias("least")).select("b", F.least("b", "least").alias("least")), "least")
        joined = pairs.join(least, "b")
        if large:
            out = joined.filter("a > b").select(F.col("least").alias("a"), F.col("a").alias("b"))
        else:
            out = joined.select(F.explode(F.array(F.struct(F.col("least").alias("a"), F.col("a").alias("b")), F.struct(F.col("least").alias("a"), F.col("b")))).alias("e")).select("e.*")
        return save(out.filter("a <> b").distinct(), "edges")

    def done(edges: DataFrame) -> bool:
        """Whether each b has one a, and that is no b itself: then all edges are stars."""
        several = edges.groupBy("b").agg(F.count("*").alias("n")).filter("n > 1").select("b")
        return several.unionByName(edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").select("b")).isEmpty()

    edges = links
    while not done(edges):
        large = stars(edges, True)
        small = stars(large, False)
        old, edges = edges, small
        drop(large, *([] if old is links else [old]))
    return edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root")).unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct())
