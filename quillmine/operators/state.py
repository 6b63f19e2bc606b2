"""Keyed state: upserts, status changes, healing, and incremental selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids

#: The statuses of a paper, in the order in which it goes through them; it need not meet all.
STATUS_RANK = ["discovered", "metadata_fetched", "fulltext_fetched", "fulltext_unavailable", "screened_irrelevant", "screened_relevant", "needs_review", "extraction_complete"]


def upsert(old: DataFrame, new: DataFrame, key: str, sets: list[str] = (), first: list[str] = (), monotone: str | None = None, order_col: str | None = None) -> DataFrame:
    """``old`` with ``new`` merged in by ``key``; both have the same columns.

    A non-empty incoming value wins; columns in ``sets`` (arrays) are united and sorted; those in ``first`` keep the old value if
    there is one; the status column ``monotone`` never falls in STATUS_RANK, and an incoming status that is none of these is an error
    (without ``monotone`` a new status wins like any value). Several incoming rows of a key are merged first: the last non-empty value by ``order_col``, the union of sets, the first of ``first``.
    """
    columns = [c for c in old.columns if c != key]
    place = lambda c: F.array_position(F.array(*map(F.lit, STATUS_RANK)), c)
    rank = lambda c: F.when(place(c) > 0, place(c)).otherwise(F.raise_error(F.concat(F.lit("no such status: "), c)).cast("long"))
    if order_col:
        pick = {}
        for c in columns:
            given = F.when(F.col(c).cast("string") != "", F.struct(order_col, F.col(c).alias("v"))) if c not in sets else None
            pick[c] = F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))) if c in sets else (F.min(given) if c in first else F.max(given))["v"]
        new = new.groupBy(key).agg(*(v.alias(c) for c, v in pick.items()))
    a, b = old.alias("a"), new.alias("b")
    out = []
    for c in columns:
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        there = F.coalesce(y.cast("string") != "", F.lit(False)) if c not in sets else None
        if c in sets:
            empty = F.array().cast("array<string>")
            out.append(F.array_sort(F.array_union(F.coalesce(x, empty), F.coalesce(y, empty))).alias(c))
        elif c in first:
            out.append(F.when(F.coalesce(x.cast("string") != "", F.lit(False)), x).otherwise(y).alias(c))
        elif c == monotone:
            out.append(F.when(there & (rank(y) > F.coalesce(place(x), F.lit(0))), y).when(x.isNull(), y).otherwise(x).alias(c))
        else:
            out.append(F.when(there | x.isNull(), y).otherwise(x).alias(c))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), *out)


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """``new`` rows in place of all ``old`` ones of the same parents, so none with a higher number stays behind."""
    return old.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new)


def keyed_merge(old: DataFrame, upserts: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Rows of ``old`` with ``upserts`` in place of those of the same key, without the keys in ``removed``."""
    kept = old.join(upserts.select(key).distinct(), key, "left_anti").unionByName(upserts)
    return kept.join(removed.select(key).distinct(), key, "left_anti")


def set_status(papers: DataFrame, extracted: DataFrame, manual: DataFrame, key: str = "paper_id") -> DataFrame:
    """``processing_status`` becomes ``extracted`` or else ``manual_review_required`` for the papers in those tables."""
    marks = extracted.select(key).distinct().withColumn("mark", F.lit("extracted")).union(manual.select(key).distinct().withColumn("mark", F.lit("manual_review_required")))
    marks = marks.groupBy(key).agg(F.min("mark").alias("mark"))  # "extracted" is the smaller
    return papers.join(marks, key, "left").withColumn("processing_status", F.coalesce("mark", "processing_status")).drop("mark")


def work_queue(papers: DataFrame, statuses: list[str], limit: int = 0, key: str = "paper_id") -> DataFrame:
    """Papers of some statuses by score, then first sight, then id; 0 is no limit."""
    rows = papers.where(F.col("processing_status").isin(*statuses)).orderBy(F.desc("candidate_score"), "first_seen_at", key)
    return rows.limit(limit) if limit else rows


def pending(candidates: DataFrame, done: DataFrame, key: str, limit: int = 0, order_col: str | None = None) -> DataFrame:
    """Candidates without a row in ``done``; the first ``limit`` by ``order_col``."""
    rows = candidates.join(done.select(key), key, "left_anti")
    return rows.orderBy(order_col or key).limit(limit) if limit else rows


def heal(triage: DataFrame, lookups: DataFrame, key: str = "paper_id") -> DataFrame:
    """Triage rows without the placeholders (no abstract) whose lookup now finds an abstract, so that they are tried again."""
    found = lookups.where(ids.text(F.col("abstract")) != "").select(key)
    healed = triage.where(~F.col("abstract_available")).join(found, key, "left_semi").select(key)
    return triage.join(healed, key, "left_anti")
