"""Which rows a step takes (P5, P8, P9, J4, J9, J13, S10, F41, F44): filters and lookups over the stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids


def open_reviews(papers: DataFrame) -> DataFrame:
    """Reviews with open full text and an id to fetch it by."""
    there = lambda c: F.coalesce(F.col(c), F.lit(False))
    return papers.where(there("is_review") & there("full_text_available") & (ids.text(F.col("pmcid")) != ""))


def processable(triage: DataFrame, papers: DataFrame, done: DataFrame, key: str = "paper_id") -> DataFrame:
    """Triaged yes or maybe on an abstract and not done yet, with what is known of the paper, nulls if nothing."""
    wanted = triage.where(F.col("decision").isin("yes", "maybe") & F.col("abstract_available")).join(done.select(key), key, "left_anti")
    extra = [c for c in papers.columns if c == key or c not in triage.columns]
    return wanted.join(papers.select(*extra), key, "left")


def with_signal(index: DataFrame, done: DataFrame, key: str = "paper_id") -> DataFrame:
    """Indexed papers with a signal that have no record yet."""
    return index.where("has_signal").join(done.select(key), key, "left_anti")


def pools(papers: DataFrame, table_rows: DataFrame, triaged: DataFrame, key: str = "paper_id") -> DataFrame:
    """Papers that are no reviews and not triaged, with ``pool``: negative (by route), table (an organism guess in a table row), or other."""
    guessed = table_rows.where(ids.text(F.col("organism_guess")) != "").select(F.col("matched_candidate_paper_id").alias(key)).distinct().withColumn("guessed", F.lit(True))
    rows = papers.where(~F.coalesce(F.col("is_review"), F.lit(False))).join(triaged.select(key), key, "left_anti").join(guessed, key, "left")
    negative = F.coalesce(F.array_contains("routes", "negative_keyword"), F.lit(False))
    return rows.withColumn("pool", F.when(negative, "negative").when(F.col("guessed"), "table").otherwise("other")).drop("guessed")


def review_status(is_review: Column) -> Column:
    """The first status of a record: reviews are seeds (P5)."""
    return F.when(F.coalesce(is_review, F.lit(False)), "review_seed").otherwise("discovered")


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """``key, n`` of non-empty keys that more than one row has: none if the key is unique."""
    return rows.where(ids.text(F.col(key).cast("string")) != "").groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def set_text(values: Column) -> Column:
    """A set column as sorted JSON text, and ``[]`` for none."""
    return F.to_json(F.array_sort(F.array_distinct(F.coalesce(values, F.array().cast("array<string>")))))


def text_set(text: Column) -> Column:
    """The set in a JSON text; empty if there is none or it can't be read."""
    return F.array_sort(F.array_distinct(F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))))


def utc_stamp(now: Column) -> Column:
    """A moment as text, to the second, in UTC (F41). The moment is a parameter, so that a run can be repeated."""
    return F.date_format(F.to_utc_timestamp(now, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def last_of_key(rows: DataFrame, key: str, order_col: str) -> DataFrame:
    """The last row of each key by ``order_col`` (D0): what a store that is read row by row is left with. Of rows that share the last place the largest counts; rows without a key stay out."""
    others = [c for c in rows.columns if c != key]
    last = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(F.col(order_col).alias("_order"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(others)))).alias("_r"))
    return last.select(*(F.col(key) if c == key else F.col(f"_r._{others.index(c)}").alias(c) for c in rows.columns))


def in_store_order(papers: DataFrame, key: str = "paper_id") -> DataFrame:
    """Papers as a store lists them: by year as text, missing ones first, then id (O3)."""
    return papers.orderBy(F.coalesce(F.col("year").cast("string"), F.lit("")), key)
