"""Responses of remote services: a cache table, and a Python data source that fills it.

Queries read only the cache table ``url_sha256, url, kind, body``; a miss is a null body, never a call. ``fetched`` is the one place
that calls out: a data source whose partitions are hosts, so that one task paces each host. Its transport is injected.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import ids, markup, scoring
from ..operators.positions import pages

# Seconds between calls to a host, tries, seconds of waiting after the nth failure (times n).
PACE_S = {"default": 0.2, "eutils": 0.34, "eutils_with_key": 0.11}
TRIES, BACKOFF_S = {"json": 3, "text": 3, "binary": 2}, 1.5
# Section types of full-text passages and their buckets.
SECTION_BUCKETS = {"METHODS": "METHODS", "RESULTS": "RESULTS", "RESULTS_AND_DISCUSSION": "RESULTS", "SUPPL": "SUPPLEMENT", "SUPPLEMENTARY_MATERIAL": "SUPPLEMENT", "ABSTRACT": "ABSTRACT", "TITLE": "TITLE"}

CACHE = "url_sha256 string, url string, kind string, body string"


class _Host(InputPartition):
    def __init__(self, host: str, urls: list[str]):
        self.host, self.urls = host, urls


class ResponseSource(DataSource):
    """``format("responses")`` with options: urls (JSON list), kind, pace (seconds). Rows: url, kind, status, body.

    Set ``transport`` on a subclass: url -> (status, text). 404 (for binaries also 403) ends the tries; a failure gives a null body.
    """

    transport: Callable[[str], tuple[int, str | None]] | None = None

    @classmethod
    def name(cls) -> str:
        return "responses"

    def schema(self) -> str:
        return "url string, kind string, status int, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, type(self).transport)


class _Reader(DataSourceReader):
    def __init__(self, options, transport):
        self.urls, self.kind = json.loads(options["urls"]), options.get("kind", "json")
        self.pace, self.transport = float(options.get("pace", PACE_S["default"])), transport

    def partitions(self) -> list[_Host]:
        by_host: dict[str, list[str]] = {}
        for url in dict.fromkeys(self.urls):
            by_host.setdefault(url.split("/")[2] if "://" in url else "", []).append(url)
        return [_Host(h, u) for h, u in sorted(by_host.items())]

    def read(self, partition: _Host):
        final = {404, 403} if self.kind == "binary" else {404}
        for i, url in enumerate(partition.urls):
            status, body = 0, None
            for n in range(TRIES[self.kind]):
                if i or n:
                    time.sleep(self.pace)
                try:
                    status, body = self.transport(url)
                except OSError:
                    status, body = 0, None
                if status == 200 or status in final:
                    break
                time.sleep(BACKOFF_S * (n + 1) * (self.pace > 0))
            yield url, self.kind, status, body if status == 200 else None


def fetched(spark: SparkSession, source: type[ResponseSource], urls: list[str], kind: str = "json", pace: float = PACE_S["default"]) -> DataFrame:
    """Rows for the cache table of those calls that succeeded with a body."""
    spark.dataSource.register(source)
    rows = spark.read.format(source.name()).options(urls=json.dumps(urls), kind=kind, pace=pace).load()
    return rows.where(F.length("body") > 0).select(ids.url_key(F.col("url")).alias("url_sha256"), "url", "kind", "body")


def missing(wanted: DataFrame, cache: DataFrame, url_col: str = "url") -> DataFrame:
    """The distinct URLs that the cache lacks."""
    return wanted.select(F.col(url_col).alias("url")).where("url IS NOT NULL").distinct().withColumn("url_sha256", ids.url_key(F.col("url"))).join(cache, "url_sha256", "left_anti").select("url")


def with_bodies(rows: DataFrame, cache: DataFrame, url_col: str = "url") -> DataFrame:
    """``rows`` with ``body``, null on a miss or without a URL. Count misses by ``count_if(body IS NULL)``."""
    bodies = cache.select("url_sha256", "body").dropDuplicates(["url_sha256"])
    return rows.withColumn("url_sha256", ids.url_key(F.col(url_col))).join(bodies, "url_sha256", "left").drop("url_sha256")


_AUTHOR = "struct<fullName:string>"
_RECORD = f"struct<title:string,doi:string,pmid:string,pmcid:string,pubYear:string,journalTitle:string,abstractText:string,isOpenAccess:string,authorList:struct<author:array<{_AUTHOR}>>,pubTypeList:struct<pubType:array<string>>>"


def search_records(body: Column) -> Column:
    """Records of a search answer (JSON) as an array of flat structs (P1); empty if it has none."""
    listed = F.from_json(body, f"struct<resultList:struct<result:array<{_RECORD}>>>")["resultList"]["result"]

    def flat(r: Column) -> Column:
        authors = F.array_join(F.transform(r["authorList"]["author"], lambda a: a["fullName"]), "; ")
        return F.struct(
            F.rtrim(ids.text(r["title"]), F.lit(".")).alias("title"), *(ids.text(r[a]).alias(b) for a, b in (("doi", "doi"), ("pmid", "pmid"), ("pmcid", "pmcid"), ("pubYear", "year"), ("journalTitle", "journal"), ("abstractText", "abstract"))),
            F.coalesce(authors, F.lit("")).alias("authors"), F.coalesce(r["isOpenAccess"] == "Y", F.lit(False)).alias("is_open_access"),
            F.contains(F.lower(F.coalesce(F.array_join(r["pubTypeList"]["pubType"], " "), F.lit(""))), F.lit("review")).alias("is_review"),
        )

    return F.transform(F.coalesce(listed, F.array()), flat)


def discovered(queries: DataFrame, cache: DataFrame, route: str) -> DataFrame:
    """Titled records of cached searches (queries: query, url), with route and query."""
    found = with_bodies(queries, cache).select("query", F.posexplode(search_records(F.col("body"))).alias("place", "r"))
    return found.select("r.*", F.lit(route).alias("discovery_route"), F.col("query").alias("discovery_query"), "place").where("title <> ''")


def pubmed(bodies: DataFrame) -> DataFrame:
    """Flat records of PubMed answers in ``body``."""
    return bodies.select(F.explode(markup.records(F.col("body"))).alias("r")).select("r.*")


def open_pdf_url(body: Column) -> Column:
    """URL of the open-access PDF in a resolver's answer, null unless it is open and has one."""
    best = lambda k: F.get_json_object(body, f"$.best_oa_location.{k}")
    return F.when((best("is_oa") == "true") & (ids.text(best("pdf_url")) != ""), best("pdf_url"))


def passages(documents: DataFrame, id_col: str = "paper_id", body_col: str = "body") -> DataFrame:
    """``id, bucket, section_type_raw, paragraph, pos, text`` of BioC JSON full texts (S29, F22): non-empty passages in order.

    ``paragraph`` counts from 1 over the document's non-empty passages; ``pos`` is the same from 0.
    """
    kind = "array<struct<documents:array<struct<passages:array<struct<infons:map<string,string>,text:string>>>>>>"
    every = F.flatten(F.transform(F.flatten(F.transform(F.from_json(body_col, kind), lambda c: c["documents"])), lambda d: d["passages"]))
    full = F.filter(every, lambda p: F.trim(ids.text(p["text"])) != "")
    rows = documents.select(id_col, F.posexplode(full).alias("pos", "p"))
    raw = ids.text(F.col("p.infons")["section_type"])
    return rows.select(id_col, scoring.bucket_of(raw, SECTION_BUCKETS).alias("bucket"), raw.alias("section_type_raw"), (F.col("pos") + 1).alias("paragraph"), "pos", F.col("p.text").alias("text"))


def pages_of(ids_table: DataFrame, id_col: str, order_col: str, size: int = 200) -> DataFrame:
    """``page, ids``: ids in pages of ``size`` for batched calls, in their order; every page is full but the last."""
    rows = ids_table.select(F.col(id_col).cast("string").alias("id"), F.col(order_col).alias("o"))
    return pages(rows, "id", size, ["o", "id"]).select("page", F.col("values").alias("ids"))


def link_edges(answers: DataFrame, body_col: str = "body") -> DataFrame:
    """``src, dst, label`` of link answers (JSON): a row for each id that an answer names, with the columns ``src`` and ``label`` of what was asked.

    An answer that is missing or can't be read has no edge; ids may come as numbers or as text; an id that is named twice counts once.
    """
    shape = "struct<linksets:array<struct<linksetdbs:array<struct<links:array<string>>>>>>"
    sets = F.from_json(body_col, shape)["linksets"]
    named = F.flatten(F.transform(F.flatten(F.transform(F.filter(sets, lambda s: s["linksetdbs"].isNotNull()), lambda s: s["linksetdbs"])), lambda d: F.coalesce(d["links"], F.array().cast("array<string>"))))
    return answers.select("src", F.explode(F.array_distinct(F.filter(named, lambda x: x.isNotNull()))).alias("dst"), "label")
