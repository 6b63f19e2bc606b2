"""Graphs as edge tables: components, bounded breadth-first search, seed tagging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut, discard


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected ``edges`` (columns u, v): root is the smallest node that it reaches.

    Alternating large-star and small-star rounds, a logarithmic number of them. Nothing is gathered by node: neighbours' minima are aggregated
    before their shuffle, and a join streams a hub's edges past its one minimum. A round is written once, and its files go when the next is written.
    """
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))))
        before, now = now, cut(large.join(low, "u").select(stars.alias("e")).select("e.u", "e.v").where("u <> v").distinct())
        discard(before)
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == seen or not sign[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = sign


def breadth_first(edges: DataFrame, seeds: DataFrame, depth: int, max_seeds: int | None = None) -> DataFrame:
    """``node, hop``: what ``depth`` steps along ``edges`` (src, dst, label) reach from ``seeds`` (node), each at its first hop.

    Seeds are hop 0; ``max_seeds`` bounds those that are expanded in the first step (the smallest ones), not later steps.
    """
    start = seeds.select("node").distinct()
    found = cut(start.withColumn("hop", F.lit(0)))
    frontier = start.orderBy("node").limit(max_seeds) if max_seeds else start
    for hop in range(1, depth + 1):
        reached = edges.join(frontier, edges["src"] == frontier["node"], "left_semi").select(F.col("dst").alias("node")).distinct()
        new = cut(reached.join(found, "node", "left_anti").withColumn("hop", F.lit(hop)))
        found = found.union(new)
        frontier = new.select("node")
    return found


def tag_seeds(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``node, seeds, labels``: for each node next to a seed, the sorted distinct seeds (as text) and edge labels that lead to it."""
    hit = edges.join(seeds, edges["src"] == seeds["node"], "left_semi")
    return hit.groupBy(F.col("dst").alias("node")).agg(F.array_sort(F.collect_set(F.col("src").cast("string"))).alias("seeds"), F.array_sort(F.collect_set("label")).alias("labels"))


def outcome_seeds(papers: DataFrame, attempts: DataFrame) -> DataFrame:
    """Seeds of the expansion: ids found through reviews, and ids with an attempt whose outcome is clear."""
    reviewed = papers.where(F.array_contains("discovery_sources", "review") & (F.col("pmid") != "")).select("pmid")
    clear = attempts.where(F.col("outcome") != "unclear").select("paper_id")
    tried = papers.where(F.col("pmid") != "").join(clear, "paper_id", "left_semi").select("pmid")
    return reviewed.union(tried).distinct().select(F.col("pmid").alias("node"))
