"""Discovery: seeds, organism lists, queries, references and hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids, lexicon, scoring, vocabulary
from . import spans

PAPER_TEXTS = ["pmid", "pmcid", "doi", "title", "abstract", "journal", "year"]
PAPER_SETS = ["discovery_sources", "source_seed_pmids", "search_queries"]


def review_seeds(candidates: DataFrame) -> DataFrame:
    """Hits from candidates that reviews cite: no review itself, with an identifier (P12, P13). ``routes`` is an array."""
    own = candidates.where(~F.coalesce(F.col("is_review"), F.lit(False)) & F.array_contains("routes", "review_reference"))
    return own.where((ids.text(F.col("pmid")) != "") | (ids.text(F.col("doi")) != ""))


def organism_names(observations: DataFrame, attempts: DataFrame, listed: DataFrame | None = None, most_words: int = 4) -> DataFrame:
    """``organism``: distinct names of short observations, species of attempts, and a given list (column value)."""
    short = ids.collapse(ids.text(F.col("organism_name"))).alias("organism")
    names = observations.select(short).where((F.col("organism") != "") & (F.size(F.split("organism", " ")) <= most_words))
    names = names.union(attempts.select(F.col("species").alias("organism")).where("organism <> ''"))
    if listed is not None:
        names = names.union(listed.select("value"))
    return names.distinct().orderBy("organism")


def organism_queries(organisms: DataFrame, phrases: list[str] = vocabulary.PHRASES.technique) -> DataFrame:
    """One search query for each organism: its name and any of the phrases."""
    group = lexicon.any_of(phrases)
    return organisms.select("organism", F.concat(F.lit('"'), F.col("organism"), F.lit(f'" AND {group}')).alias("query"))


def search_plan(topics: list[str] = vocabulary.REVIEW_TOPICS) -> list[tuple[str, str, str, str]]:
    """(route, place, query, sort) of the list-driven searches: broad ones, those for failures, and reviews of a topic, by relevance and by citations."""
    context = " OR ".join(vocabulary.ORGANISM_TERMS)
    plan = [("broad_keyword", q, "") for q in vocabulary.BROAD_QUERIES] + [("negative_keyword", f"{p} AND ({context})", "") for p in vocabulary.FAILURE_QUERY_PHRASES]
    plan += [("review_topic", f'({t}) AND (PUB_TYPE:"Review")', sort) for t in topics for sort in ("", "CITED desc")]
    return [(route, str(i), query, sort) for i, (route, query, sort) in enumerate(plan)]


def phrase_plan() -> list[tuple[str, str]]:
    """(source, query) of the searches without an organism (S41): generic and first-of-its-kind phrases, and phrases of failure, each quoted."""
    quoted = lambda p: f'"{p}"' if " " in p else p
    generic = [("generic_technique_search", quoted(p)) for p in [*vocabulary.GENERIC_DISCOVERY, *vocabulary.NOVELTY]]
    return generic + [("failure_phrase_search", f'"{p}"') for p in vocabulary.FAILURE_DISCOVERY]


def run_tally(found: DataFrame, known: DataFrame, key: str = "paper_id") -> DataFrame:
    """One row: distinct papers of a run, of which new, of which known before and enriched."""
    rows = found.select(key).distinct().join(known.select(key).distinct().withColumn("there", F.lit(True)), key, "left")
    there = F.coalesce("there", F.lit(False))
    return rows.agg(F.count("*").alias("n_papers"), F.count_if(~there).alias("n_new"), F.count_if(there).alias("n_enriched"))


def reference_requests(papers: DataFrame, id_col: str = "paper_id") -> DataFrame:
    """``id_col, source, query`` of the papers whose reference lists can be asked for: those with a pmid, at its source (S43). ``query`` is what a crawl in numbered pages asks."""
    pmid = ids.strip(ids.text(F.col("pmid")))
    return papers.where(pmid != "").select(id_col, F.lit("MED").alias("source"), F.concat(F.lit("MED/"), pmid).alias("query"))


def references(reviews: DataFrame, body_col: str = "body") -> DataFrame:
    """Cited records of reviews' reference lists (JSON in ``body``): those with a title or identifier; a missing title gets a stand-in."""
    kind = "struct<referenceList:struct<reference:array<struct<id:string,source:string,title:string,doi:string,pubYear:string,journalAbbreviation:string,authorString:string>>>>"
    each = reviews.select(F.col("paper_id").alias("review_id"), F.explode(F.from_json(body_col, kind)["referenceList"]["reference"]).alias("r"))
    title, doi = F.rtrim(ids.strip(ids.text(F.col("r.title"))), F.lit(".")), ids.text(F.col("r.doi"))
    pmid = F.when(F.col("r.source") == "MED", ids.text(F.col("r.id"))).otherwise("")
    kept = each.where((title != "") | (doi != "") | (pmid != ""))
    stand_in = F.concat(F.lit("[untitled reference, doi="), F.when(doi != "", doi).otherwise("n/a"), F.lit("]"))
    return kept.select("review_id", F.when(title != "", title).otherwise(stand_in).alias("title"), doi.alias("doi"), pmid.alias("pmid"), ids.text(F.col("r.pubYear")).alias("year"), ids.text(F.col("r.journalAbbreviation")).alias("journal"), ids.text(F.col("r.authorString")).alias("authors"), F.lit("review_reference").alias("discovery_route"))


def hits_to_papers(records: DataFrame, hits: DataFrame) -> DataFrame:
    """Paper rows, ready for an upsert, of fetched records (one or more a pmid) and their hits (pmid, source, query, seed).

    Hits are gathered into sets by pmid before the join, so a paper found a thousand times is one row.
    """
    sets = {"source": "discovery_sources", "seed": "source_seed_pmids", "query": "search_queries"}
    found = hits.groupBy("pmid").agg(*(F.array_sort(F.collect_set(F.when(ids.text(F.col(a)) != "", F.col(a)))).alias(b) for a, b in sets.items()))
    one = records.where((ids.text(F.col("pmid")) != "")).dropDuplicates(["pmid"])
    rows = one.join(found, "pmid")
    return rows.select(ids.paper_id_v2(F.col("pmid"), F.col("doi")).alias("paper_id"), *(ids.text(F.col(c)).alias(c) for c in PAPER_TEXTS), *PAPER_SETS, F.lit("metadata_fetched").alias("processing_status"))


def screen(papers: DataFrame, passages: DataFrame, phrases: scoring.Phrases = vocabulary.PHRASES, threshold: int = vocabulary.RELEVANT_SCORE) -> DataFrame:
    """``papers`` with candidate_score, fulltext_status and processing_status set: by full text where there is any passage, else by the abstract.

    An abstract below the threshold makes a paper ``fulltext_unavailable``, not irrelevant.
    """
    there = passages.select("paper_id").distinct().withColumn("full", F.lit(True))
    full = spans.passage_scores(passages, papers.select("paper_id", "title"), phrases).withColumnRenamed("score", "full_score")
    short = scoring.abstract_score(F.col("title"), F.col("abstract"), phrases)
    rows = papers.drop("candidate_score", "fulltext_status", "processing_status").join(full, "paper_id").join(there, "paper_id", "left")
    score = F.when(F.col("full"), F.col("full_score")).otherwise(short)
    status = F.when(score >= threshold, "screened_relevant").when(F.col("full"), "screened_irrelevant").otherwise("fulltext_unavailable")
    return rows.withColumns({"candidate_score": score.cast("double"), "fulltext_status": F.when(F.col("full"), "available").otherwise("unavailable_from_pmc"), "processing_status": status}).drop("full", "full_score")


def chunk_packets(passages: DataFrame, titles: DataFrame, phrases: scoring.Phrases = vocabulary.PHRASES) -> DataFrame:
    """``paper_id, title`` and three arrays of chunks (methods, results, supplement) of papers with any chunk."""
    chunks = spans.passage_chunks(passages, phrases)
    chunk = F.struct("chunk_id", "paragraph", "matched_technique", "matched_failure", "matched_success", "text", "context")
    by_bucket = [F.array_sort(F.collect_list(F.when(F.col("bucket") == b, F.struct(F.col("paragraph").alias("p"), chunk.alias("c"))))) for b in ("METHODS", "RESULTS", "SUPPLEMENT")]
    lists = chunks.groupBy("paper_id").agg(*(F.transform(x, lambda s: s["c"]).alias(f"{n}_chunks") for n, x in zip(("methods", "results", "supplement"), by_bucket, strict=True)))
    return lists.join(titles.select("paper_id", "title"), "paper_id")
