"""Tagged sentences, first spans and their index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, lexicon, scoring, text
from ..functions.lexicon import Lexicon
from . import tagging

#: Spans kept for each document and category.
MAX_PER_CATEGORY = 12


def sentences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, pos, sentence``: positions from 0."""
    return docs.select(F.col(id_col), F.posexplode(text.sentences(F.col(text_col))).alias("pos", "sentence"))


def tagged(found: DataFrame, words: Lexicon) -> DataFrame:
    """Sentences with a hit, with ``tags``: map of category to terms."""
    return found.withColumn("tags", lexicon.tag(F.col("sentence"), words)).where(F.size("tags") > 0)


def keyword_spans(docs: DataFrame, words: Lexicon, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_PER_CATEGORY) -> DataFrame:
    """``id, category, rank, pos, sentence, terms``: the first ``most`` tagged sentences of each category, repeats (by lower case) left out.

    Everything happens within a document, so nothing is shuffled. Equal folded sentences have equal tags, so leaving repeats out before or
    after the category is chosen is the same.
    """
    first = tagging.tagged_documents(docs, words, id_col, text_col).select(id_col, F.filter("hit", lambda h: h["fresh"]).alias("hit"))
    by_category = F.array(*(F.struct(F.lit(c).alias("category"), F.slice(_having(c), 1, most).alias("spans")) for c in words))
    rows = first.select(id_col, F.explode(by_category).alias("c")).select(id_col, "c.category", F.posexplode("c.spans").alias("n", "s"))
    return rows.select(id_col, "category", (F.col("n") + 1).alias("rank"), F.col("s.pos").alias("pos"), F.col("s.sentence").alias("sentence"), F.col("s.tags")[F.col("category")].alias("terms"))


def _having(category: str) -> Column:
    return F.filter("hit", lambda s: F.map_contains_key(s["tags"], category))


def span_index(docs: DataFrame, words: Lexicon, id_col: str = "doc_id", text_col: str = "text", patterns: dict[str, str] | None = None) -> DataFrame:
    """``id, n_sentences_total, n_tagged_sentences, n_<category>..., n_accessions, has_signal`` for every document, without a shuffle; sentences are tagged once."""
    accessions = ids.accessions(F.array_join("sentences", " "), patterns or {"none": "(?!)"})
    number = F.aggregate(F.map_values(accessions), F.lit(0), lambda a, x: a + F.size(x))
    every = tagging.tagged_documents(docs, words, id_col, text_col, n_accessions=number)
    fresh = lambda c: F.size(F.filter("hit", lambda h: h["fresh"] & F.map_contains_key(h["tags"], c)))
    counts = {f"n_{c}": F.least(F.lit(MAX_PER_CATEGORY), fresh(c)) for c in words}
    rows = every.select(id_col, F.col("n_sentences").alias("n_sentences_total"), F.size("hit").alias("n_tagged_sentences"), *(v.alias(k) for k, v in counts.items()), "n_accessions")
    zero = F.lit(0)
    n = lambda c: F.col(f"n_{c}") if c in words else zero
    return rows.withColumn("has_signal", (n("manipulation") > 0) & ((n("success") > 0) | (n("failure") > 0) | (n("strain") > 0)))


def passage_chunks(passages: DataFrame, phrases: scoring.Phrases, id_col: str = "paper_id") -> DataFrame:
    """Passages of a scored bucket that hold a phrase, with their neighbours in the bucket (``context``) and their points.

    ``passages``: id, bucket, paragraph (1-based), text. Context stops at the bucket's ends.
    """
    scored = passages.where(F.col("bucket").isin("METHODS", "RESULTS", "SUPPLEMENT"))
    near = Window.partitionBy(id_col, "bucket").orderBy("paragraph")
    context = F.concat_ws(" ", F.lag("text").over(near), F.col("text"), F.lead("text").over(near))
    lists = {"matched_technique": phrases.technique, "matched_failure": phrases.failure, "matched_success": phrases.success}
    with_hits = scored.withColumn("context", context).withColumns({n: lexicon.hits(F.col("text"), terms) for n, terms in lists.items()})
    held = with_hits.where(F.size("matched_technique") + F.size("matched_failure") + F.size("matched_success") > 0)
    chunk = F.concat_ws("_", F.lower("bucket"), F.col("paragraph").cast("string"))
    return held.select(id_col, "bucket", chunk.alias("chunk_id"), "paragraph", *lists, "text", "context", scoring.passage_points(F.col("bucket"), F.col("text"), phrases).alias("points"))


def passage_scores(passages: DataFrame, papers: DataFrame, phrases: scoring.Phrases, id_col: str = "paper_id", sample: int = 60) -> DataFrame:
    """``id, score`` of every paper: passages' points, the title's, and a boost for several strains in the first ``sample`` passages.

    ``passages`` as above with ``pos``, the passage's place in the paper.
    """
    first = F.array_sort(F.collect_list(F.when(F.col("pos") < sample, F.struct("pos", "text"))))  # at most ``sample`` passages
    boost = F.array_join(F.transform(first, lambda x: x["text"]), " ").rlike(scoring.MULTI_STRAIN)
    sums = passages.groupBy(id_col).agg(F.sum(scoring.passage_points(F.col("bucket"), F.col("text"), phrases)).alias("p"), boost.alias("b"))
    title = scoring.points(lexicon.contains_any(F.col("title"), phrases.title_tools), 3) + scoring.points(lexicon.contains_any(F.col("title"), phrases.title_methods), 2)
    total = F.coalesce("p", F.lit(0)) + F.when(F.col("b"), 3).otherwise(0) + title
    return papers.join(sums, id_col, "left").select(id_col, total.cast("long").alias("score"))


def index_of_packets(packets: DataFrame, categories: list[str], id_col: str = "paper_id") -> DataFrame:
    """Index rows rebuilt from span packets (D10): counts of each of ``categories``, of accessions and strains, and ``has_signal``.

    ``packets`` hold ``spans_by_category`` (map to arrays), ``regex_accessions`` (map to arrays), ``regex_strains`` (array) and the sentence counts.
    """
    n = {c: F.coalesce(F.size(F.col("spans_by_category")[c]), F.lit(0)) for c in categories}
    n = {c: F.greatest(x, F.lit(0)) for c, x in n.items()}
    accessions = F.aggregate(F.map_values("regex_accessions"), F.lit(0), lambda total, found: total + F.size(found))
    signal = (n["manipulation"] > 0) & ((n["success"] > 0) | (n["failure"] > 0) | (n["strain"] > 0))
    return packets.select(
        id_col, *(F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in ("n_sentences_total", "n_tagged_sentences")), *(x.cast("int").alias(f"n_{c}") for c, x in n.items()),
        F.coalesce(accessions, F.lit(0)).alias("n_accessions"), F.greatest(F.coalesce(F.size("regex_strains"), F.lit(0)), F.lit(0)).alias("n_strains"), signal.alias("has_signal"),
    )
