"""Batches and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut


def quota_batch(rows: DataFrame, limit: int, pool_col: str = "pool", order_cols: tuple[str, ...] = ("n",), quotas: dict[str, float] | None = None, rest: tuple[str, ...] = ("negative", "table", "other")) -> DataFrame:
    """``rows`` of a batch of ``limit``, with ``place`` from 1: each pool's quota first, then what is left of the pools in the order of ``rest``.

    A pool's quota is its share of the limit, rounded half to even, at least 1 if the pool has rows. Only the first ``limit`` rows of
    each pool can be chosen, so the final ordering runs over at most ``limit`` rows a pool.
    """
    quotas = quotas or {"negative": 0.35, "table": 0.45}
    within = Window.partitionBy(pool_col).orderBy(*order_cols)
    share = F.lit(0)
    pool_rank = F.lit(len(rest))
    for i, name in enumerate(rest):
        q = F.greatest(F.lit(1), F.bround(F.lit(limit * quotas[name]), 0).cast("int")) if name in quotas else F.lit(0)
        share, pool_rank = F.when(F.col(pool_col) == name, q).otherwise(share), F.when(F.col(pool_col) == name, i).otherwise(pool_rank)
    ranked = rows.withColumn("_r", F.row_number().over(within)).where(F.col("_r") <= limit)
    ranked = ranked.withColumns({"_late": F.col("_r") > share, "_pool": pool_rank})
    final = Window.orderBy("_late", "_pool", "_r")
    return ranked.withColumn("place", F.row_number().over(final)).where(F.col("place") <= limit).drop("_r", "_late", "_pool")


def stable_sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows by a hash of their key: the same ones for the same seed, however the table is partitioned."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def stratified_head(rows: DataFrame, stratum: str, order_col: str, sizes: dict[str, int]) -> DataFrame:
    """The first rows of each stratum, as many as ``sizes`` says."""
    most = F.lit(0)
    for value, n in sizes.items():
        most = F.when(F.col(stratum) == value, n).otherwise(most)
    head = rows.where(F.col(stratum).isin(*sizes)).withColumn("place", F.row_number().over(Window.partitionBy(stratum).orderBy(order_col)))
    return head.where((F.col("place") <= max(sizes.values())) & (F.col("place") <= most))


def greedy_quota(hits: DataFrame, per_topic: int, seen: DataFrame | None = None) -> DataFrame:
    """``topic, pass, rank, paper_id`` of the hits that fill the topics' quotas, topics taken in ``topic_no`` order.

    ``hits``: topic_no, topic, pass, rank, paper_id. Topics come one after another; only papers that no earlier hit took (and none in ``seen``)
    use quota, and a topic stops at its quota, which its passes share. First every topic is cut to the hits that it could need: its first
    ``per_topic`` papers and as many for each topic before it, for these can take no more; the bound is a literal, so tasks keep only that many a topic before
    anything is shuffled. Then a round for each topic takes the first of its hits whose papers no earlier round took. What rounds read is
    at most topics x topics x ``per_topic`` rows, whatever the table holds.
    """
    if seen is not None:
        hits = hits.join(seen.select("paper_id"), "paper_id", "left_anti")
    topics = [r.topic_no for r in hits.select("topic_no").where("topic_no IS NOT NULL").distinct().orderBy("topic_no").collect()]  # one number a topic
    # a repeat within the topic never uses quota
    order = ["pass", "rank", "paper_id"]
    rows = hits.groupBy("topic_no", "paper_id").agg(F.min(F.struct("pass", "rank", "topic")).alias("_r")).select("topic_no", "_r.topic", "_r.pass", "_r.rank", "paper_id")
    place = F.row_number().over(Window.partitionBy("topic_no").orderBy(*order))
    rows = cut(rows.withColumn("_p", place).where(F.col("_p") <= per_topic * max(1, len(topics))).drop("_p"))
    taken = rows.limit(0)
    for topic in topics:
        free = rows.where(F.col("topic_no") == topic).join(F.broadcast(taken.select("paper_id")), "paper_id", "left_anti")  # per_topic rows an earlier topic
        found = cut(free.select(*rows.columns).orderBy(*order).limit(per_topic))
        taken = taken.unionByName(found)
    return taken.select("topic", "pass", "rank", "paper_id")


def domain_counts(rows: DataFrame, col: str, domain: list[str]) -> DataFrame:
    """``value, n`` for each value of the domain, 0 where there is none, and for unexpected values that occur."""
    spark = rows.sparkSession
    values = spark.createDataFrame([(d,) for d in domain], "value string")
    counts = rows.groupBy(F.coalesce(F.col(col), F.lit("")).alias("value")).agg(F.count("*").alias("n"))
    return values.join(counts, "value", "full").select("value", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
