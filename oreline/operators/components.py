"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of node and neighbours."""
    both = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("u"), F.col("dst").alias("v")),
        F.struct(F.col("dst").alias("u"), F.col("src").alias("v")),
    )).alias("e")).select("e.*")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("src"), F.col("m").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("src").agg(F.min("dst").alias("m"))
    pulled = edges.join(least, "src").where(F.col("dst") != F.col("m")) \
        .select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return pulled.unionByName(least.select("src", F.col("m").alias("dst")))


def star_forest(edges: DataFrame) -> DataFrame:
    """(src, dst): every node that has an edge, except the smallest, linked to the smallest of its component.

    Each round is two aggregations and two equi-joins; a hub's edges are never gathered in one place,
    since only its minimum is computed (with partial aggregation) and joined back (split by adaptive
    execution when the hub is hot). The rounds grow with the logarithm of the longest path.
    """
    current = edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    current = cut_lineage(current)
    seen = None
    while True:
        current = cut_lineage(_small_star(_large_star(current)).distinct())
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return current
        seen = tuple(mark)


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id of each component; a vertex without edges is its own."""
    forest = star_forest(edges.select("src", "dst")).select(F.col("src").alias("id"), F.col("dst").alias("component"))
    return vertices.select("id").distinct().join(forest, "id", "left") \
        .select("id", F.coalesce("component", "id").alias("component"))


def unplaced_links(links: DataFrame, known: DataFrame) -> DataFrame:
    """Links (src, dst) with an end that has no component in ``known`` (id, component), each once."""
    fresh = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct().join(known, "id", "left_anti")
    src, dst = fresh.select(F.col("id").alias("src")), fresh.select(F.col("id").alias("dst"))
    # an "or" of both ends would be no equi-join and pair all links with all ids
    return links.join(src, "src", "left_semi").select("src", "dst").unionByName(
        links.join(src, "src", "left_anti").join(dst, "dst", "left_semi").select("src", "dst"))


def extend_components(known: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component, previous): what new ``edges`` (src, dst) change in ``known`` (id, component).

    Only ids that are new or whose component gets a smaller name are given. The new edges are looked up in the stored
    components and joined among component names, so the work follows the new edges, and the rounds never touch stored members;
    those of renamed components are found by one join. Applied to ``known``, the result equals components of all edges.
    """
    new = edges.where("src is not null and dst is not null").select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    placed = cut_lineage(new.join(known, "id", "left").select("id", F.col("component").alias("previous"), F.coalesce("component", "id").alias("at")))
    between = edges.join(placed.select(F.col("id").alias("src"), F.col("at").alias("_src")), "src") \
        .join(placed.select(F.col("id").alias("dst"), F.col("at").alias("_dst")), "dst") \
        .select(F.col("_src").alias("src"), F.col("_dst").alias("dst"))
    forest = star_forest(between).select(F.col("src").alias("at"), F.col("dst").alias("renamed"))
    # an id that nobody knew can be a component's name only for itself, so members are looked up by old names
    members = known.join(forest, F.col("component") == F.col("at")).select("id", F.col("renamed").alias("component"), F.col("component").alias("previous"))
    fresh = placed.where("previous is null").join(forest, "at", "left").select("id", F.coalesce("renamed", "id").alias("component"), "previous")
    return members.unionByName(fresh)


def merge_components(known: DataFrame, changed: DataFrame) -> DataFrame:
    """``known`` (id, component) after the changes of ``extend_components``."""
    now = changed.select("id", F.col("component").alias("_now"))
    return known.join(now, "id", "full").select("id", F.coalesce("_now", "component").alias("component"))
