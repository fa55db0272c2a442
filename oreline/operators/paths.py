"""Paths of variable length over arbitrary links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def link_paths(links: DataFrame, starts: DataFrame, hops: int) -> DataFrame:
    """(start, end, hops): one row per path of 1 to ``hops`` links from each start, no link used twice on it.

    ``links`` (src, dst) run both ways and may repeat (each row is a link of its own); a link from a node to itself is one link. ``starts`` has
    a column id. Each round joins the open paths with the links of their last node and is stored before the next; paths carry the
    numbers of their links, not their nodes. The rows are as many as the paths, which grow with the degree to the power of
    ``hops``; use ``reached`` where only the ends matter.
    """
    numbered = cut_lineage(links.where("src is not null and dst is not null").select("src", "dst").withColumn("link", F.monotonically_increasing_id()))
    both = numbered.unionByName(numbered.where("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "link"))
    steps = both.select(F.col("src").alias("end"), F.col("dst").alias("next"), "link")
    front = starts.select("id").distinct().select(F.col("id").alias("start"), F.col("id").alias("end"), F.array().cast("array<bigint>").alias("used"))
    rounds = []
    for length in range(1, hops + 1):
        front = cut_lineage(front.join(steps, "end").where(~F.array_contains("used", F.col("link")))
                            .select("start", F.col("next").alias("end"), F.concat("used", F.array("link")).alias("used")))
        rounds.append(front.select("start", "end", F.lit(length).alias("hops")))
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out


def reached(links: DataFrame, starts: DataFrame, hops: int) -> DataFrame:
    """(start, end, hops): nodes within ``hops`` links of each start, itself not counted, with the length of the shortest way.

    A node is followed from once per start only, so the rows of a round are at most starts times nodes reached, whatever the number
    of ways.
    """
    pairs = links.where("src is not null and dst is not null and src <> dst").select(F.explode(F.array(
        F.struct(F.col("src").alias("end"), F.col("dst").alias("next")), F.struct(F.col("dst").alias("end"), F.col("src").alias("next")))).alias("s")).select("s.*").distinct()
    steps = cut_lineage(pairs)
    seen = starts.select("id").distinct().select(F.col("id").alias("start"), F.col("id").alias("end"), F.lit(0).alias("hops"))
    front = seen
    for length in range(1, hops + 1):
        further = front.select("start", "end").join(steps, "end").select("start", F.col("next").alias("end")).distinct()
        front = cut_lineage(further.join(seen, ["start", "end"], "left_anti").withColumn("hops", F.lit(length)))
        seen = cut_lineage(seen.unionByName(front))
    return seen.where("hops > 0")
