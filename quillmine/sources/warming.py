"""Warming the response cache for a batch of papers: record, then article, then PDF.

Three steps, each a table of URLs that is fetched and written: the record of every paper; the article of those that are open and in the archive; and for those that got no
article, the resolver's answer and the PDF that it names. URLs that the cache holds are not asked for again. What became of each paper is counted by
the run that writes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import ids
from ..operators.lineage import cut
from .paging import full_text_url
from .responses import missing, open_pdf_url, search_records

#: (urls, kind) -> url_sha256, url, kind, body of those that answered; bodies of kind ``binary`` are binary
Fetch = Callable[[DataFrame, str], DataFrame]
OUTCOMES = ("abstract", "article", "pdf", "no_record")


def _had(rows: DataFrame, cache: DataFrame, name: str, url: str) -> DataFrame:
    """``rows`` with the body of their ``url`` as ``name``."""
    bodies = cache.groupBy("url_sha256").agg(F.first("body").alias(name))
    return rows.withColumn("_key", ids.url_key(F.col(url))).join(bodies, F.col("_key") == bodies["url_sha256"], "left").drop("_key", "url_sha256")


def _step(rows: DataFrame, url: str, kind: str, cache: DataFrame, fetch: Fetch) -> tuple[DataFrame, DataFrame]:
    """(rows with their bodies as ``body``, what was fetched)"""
    new = cut(fetch(missing(rows, cache.where(F.col("kind") == kind), url), kind))
    known = cache.where(F.col("kind") == kind).select("url_sha256", "body").unionByName(new.select("url_sha256", "body"))
    return _had(rows, known, "body", url), new


def warm(batch: DataFrame, texts: DataFrame, binaries: DataFrame, fetch: Fetch, lookup_base: str, archive_base: str, resolver_base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(papers, texts, binaries): ``paper_id, has_abstract, outcome`` of the batch, and the rows that the caches lack.

    ``batch``: paper_id, doi, pmid, title. ``texts`` and ``binaries`` are the caches (url_sha256, url, kind, body). ``outcome`` is ``article``, ``pdf``,
    ``abstract`` (a record, but no text), or ``no_record``. A paper that none of doi, pmid and title names has no record.
    """
    asked = batch.select("paper_id", "doi", ids.lookup_url(lookup_base, F.col("doi"), F.col("pmid"), F.col("title")).alias("url"))
    rows, fetched = _step(asked, "url", "json", texts, fetch)
    record = F.get(search_records(F.col("body")), F.lit(0))
    rows = cut(rows.select("paper_id", F.col("doi").alias("own_doi"), record.alias("r")))
    open_ = F.col("r.is_open_access") & (F.col("r.pmcid") != "")
    rows = rows.withColumn("article_url", F.when(open_, full_text_url(archive_base, F.col("r.pmcid"))))
    rows, articles = _step(rows, "article_url", "text", texts, fetch)
    rows = rows.withColumn("has_article", F.length(F.coalesce("body", F.lit(""))) > 0).drop("body")
    doi = ids.normalize_doi(F.when(F.col("r.doi") != "", F.col("r.doi")).otherwise(ids.text(F.col("own_doi"))))
    asks = F.col("r").isNotNull() & ~F.col("has_article") & (doi != "")
    rows = rows.withColumn("resolver_url", F.when(asks, F.concat(F.lit(f"{resolver_base}/works/https://doi.org/"), doi)))
    rows, resolved = _step(rows, "resolver_url", "json", texts.unionByName(fetched), fetch)
    rows = rows.withColumn("pdf_url", open_pdf_url(F.col("body"))).drop("body")
    rows, pdfs = _step(rows, "pdf_url", "binary", binaries, fetch)
    outcome = F.when(F.col("r").isNull(), "no_record").when(F.col("has_article"), "article").when(F.length("body") > 0, "pdf").otherwise("abstract")
    papers = rows.select("paper_id", F.coalesce(F.col("r.abstract") != "", F.lit(False)).alias("has_abstract"), outcome.alias("outcome"))
    return papers, fetched.unionByName(articles).unionByName(resolved), pdfs


def written(papers: DataFrame, path: str) -> dict[str, int]:
    """Write a warmed batch's papers; its tallies, counted as the rows go by (S14): papers, abstracts, articles, PDFs, failed lookups."""
    seen = Observation()
    of = lambda outcome: F.count_if(F.col("outcome") == outcome)
    counted = papers.observe(seen, F.count(F.lit(1)).alias("papers"), F.count_if("has_abstract").alias("abstracts"), of("article").alias("articles"), of("pdf").alias("pdfs"), of("no_record").alias("no_record"))
    counted.write.mode("overwrite").parquet(path)
    return seen.get
