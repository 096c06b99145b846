"""Connected components, and links found among the members of buckets.

All steps are joins and aggregates over edge tables in the shared folder: no list of
edges, links or components ever comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import discard, stored, stored_at

#: Leaders a bucket sends against its members in the second round; twice as many in each next.
LEADERS = 15


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is its smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. until the edges no
    longer change: then each node points at its root. Loops and repeated edges do no harm.
    """
    e = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = None
    while (now := _signature(e)) != seen:
        seen = now
        if now[0] == 0:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(lowest, "u").where("v > u AND v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .where("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.withColumnRenamed("m", "v"))
            .distinct()
        )
        e = stored(small, "small-star")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _signature(e: DataFrame) -> tuple[int, int | None]:
    row = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def merged_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, component) after more links (a, b); only components that links join are worked on."""
    if labels is None:
        return stored(components(links), "labels")
    left, right = labels.toDF("a", "ca"), labels.toDF("b", "cb")
    edges = links.join(left, "a", "left").join(right, "b", "left")
    edges = stored(
        edges.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct(), "joined"
    )
    if edges.isEmpty():
        return labels
    moved = stored(components(edges), "moved")
    new = moved.join(labels.select(F.col("component").alias("node")).distinct(), "node", "left_anti")
    old = labels.join(moved.toDF("component", "to"), "component", "left")
    old = old.select("node", F.coalesce("to", "component").alias("component"))
    return stored(old.unionByName(new), "labels")


def link_buckets(
    buckets: DataFrame, near: Callable[[Column, Column], Column], verify: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Components and links among nodes that share a bucket.

    buckets: distinct (key, node, sig), node a long, from a stored table; near: whether two
    sigs may be those of a link, asked in the join; verify: pairs (a, b) to those that link.
    Returns (node, component) for linked nodes, and the links found.

    Every bucket sends its smallest member against all others. Where that does not make
    the bucket one component, its next members are sent, twice as many each round, and
    only against members of other components, until every member of such a bucket has
    been sent: rounds grow with the logarithm of the largest such bucket. So two members that
    link always end in one component, though pairs inside a component are not listed.
    """
    spark = buckets.sparkSession
    dealt = buckets.repartition("key")  # shuffled once: the two reads below are the same
    heads = dealt.groupBy("key").agg(F.min(F.struct("node", "sig")).alias("head"), F.count("*").alias("n")).where("n > 1")
    met, met_at = stored_at(dealt.join(heads, "key"), "buckets")
    pairs = met.where((F.col("node") != F.col("head.node")) & near(F.col("head.sig"), F.col("sig")))
    tried = stored(pairs.select(F.col("head.node").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = stored(verify(tried), "links")
    labels = merged_labels(None, links)
    rest, rest_at = met.where("n > 2").select("key", "node", "sig"), met_at
    rank, width = 1, LEADERS
    while True:
        named = rest.join(labels, "node", "left").select("key", "node", "sig", F.coalesce("component", "node").alias("c"))
        open_keys = (
            named.groupBy("key")
            .agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
            .where((F.col("lo") != F.col("hi")) & (F.col("n") > rank))
            .select("key")
        )
        live, live_at = stored_at(named.join(open_keys, "key"), "open-buckets")
        discard(spark, rest_at)
        if live.isEmpty():
            return labels, links
        place = F.row_number().over(Window.partitionBy("key").orderBy("node"))
        leaders = (
            live.withColumn("r", place)
            .where(F.col("r") <= rank + width)
            .where(F.col("r") > rank)
            .select("key", F.col("node").alias("a"), F.col("c").alias("ac"), F.col("sig").alias("asig"))
        )
        apart = (F.col("node") > F.col("a")) & (F.col("c") != F.col("ac")) & near(F.col("asig"), F.col("sig"))
        pairs = live.join(leaders, "key").where(apart).select("a", F.col("node").alias("b")).distinct()
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.unionByName(pairs)
        more = stored(verify(pairs), "links")
        links, labels = links.unionByName(more), merged_labels(labels, more)
        rest, rest_at = live.select("key", "node", "sig"), live_at
        rank, width = rank + width, 2 * width
