"""Bibliographic shapes made from the synthetic tables, so that every operator has input (and SQL a counterpart)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import Phrases

LEXICON = {"manipulation": ["the ", "der "], "success": ["license"], "failure": ["no ", "nicht"], "strain": ["que ", "stre"]}
PATTERNS = {"email": r"[\w.]+@[\w.]+", "number": r"\b\d{2,6}(?:\.\d+)?\b"}
PHRASES = Phrases(technique=["the ", "der ", "que "], failure=["no ", "nicht"], success=["license"], title_tools=["tion"], generic=["stre"], title_methods=["the and"])
#: The entities of page titles, in the order in which they become characters.
ENTITIES = {"&quot;": '"', "&copy;": "©", "&middot;": "·", "&lt;": "<", "&amp;": "&"}
BUCKETS = ["METHODS", "RESULTS", "SUPPLEMENT", "OTHER"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def title(text: str = "text"):
    """The first line, whole."""
    return F.regexp_extract(F.coalesce(F.col(text), F.lit("")), r"^[^\n]*", 0)


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers from documents: doi from a hash of the text (blank in every third row), year and routes from the id."""
    docs = documents(spark, sf_dir)
    doi = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("10.5555/"), F.left(F.md5(F.coalesce("text", F.lit(""))), F.lit(10))))
    routes = F.array_compact(F.array(F.when(F.col("doc_id") % 7 == 0, F.lit("negative_keyword")), F.when(F.col("doc_id") % 11 == 0, F.lit("organism_specific")), F.when(F.col("doc_id") % 5 == 0, F.lit("review_reference")), F.lit("broad_keyword")))
    return docs.select(
        F.col("doc_id").alias("n"), F.col("doc_id").cast("string").alias("paper_id"), title().alias("title"), F.coalesce("text", F.lit("")).alias("abstract"), doi.alias("doi"),
        F.lit("").alias("pmid"), F.col("source").alias("journal"), (F.col("doc_id") % 40 + 1985).cast("string").alias("year"), routes.alias("routes"), F.col("lang"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts from line items: paper is the order, strain the part, species the brand, technique the part's type."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    outcome = F.when(F.col("l_returnflag") == "R", "failure").when(F.col("l_returnflag") == "A", "success").otherwise("unclear")
    rows = li.join(part, li["l_partkey"] == part["p_partkey"])
    return rows.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("attempt_id"),
        F.col("l_orderkey").alias("paper_id"), F.col("l_partkey").cast("string").alias("strain"), F.col("p_brand").alias("species"), F.col("p_type").alias("technique"), outcome.alias("outcome"),
    )


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages from documents' lines; their buckets take turns."""
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "text"))
    return rows.select("doc_id", F.element_at(F.array(*map(F.lit, BUCKETS)), F.col("pos") % 4 + 1).alias("bucket"), (F.col("pos") + 1).alias("paragraph"), "pos", "text")


def citation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers (even nodes) cite the parts (odd nodes) of all their orders; parts are cited by them."""
    bought = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    pairs = bought.select((F.col("o_custkey") * 2).alias("c"), (F.col("l_partkey") * 2 + 1).alias("p")).distinct()
    ways = F.array(F.struct(F.col("c").alias("src"), F.col("p").alias("dst"), F.lit("reference").alias("label")), F.struct(F.col("p").alias("src"), F.col("c").alias("dst"), F.lit("cited_by").alias("label")))
    return pairs.select(F.explode(ways).alias("e")).select("e.*")


def citation_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the largest balances."""
    return table(spark, sf_dir, "customer").where("c_acctbal > 9900").select((F.col("c_custkey") * 2).alias("node"))


def triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage rows: quality 1 is yes, 0 is no, unlabelled is maybe without an abstract."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = docs.join(labels, "doc_id", "left")
    decision = F.when(F.col("quality") == 1, "yes").when(F.col("quality") == 0, "no").otherwise("maybe")
    return rows.select("doc_id", decision.alias("decision"), F.col("quality").isNotNull().alias("abstract_available"))
