"""Calls to remote services from tables of URLs and queries (S11-S13, S17-S19, S24, S26): paced tasks, answers as rows.

A transport is any picklable callable ``url -> (status, bytes or None)``; it may look into a cache first. Tests and queries inject stubs.
Each host's URLs (each service's queries) go to ``tasks`` tasks, each of which waits ``tasks`` times the host's pace between two calls, so the host
sees the pace that it allows however many tasks there are.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlencode

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from .responses import BACKOFF_S, PACE_S, TRIES

Transport = Callable[[str], tuple[int, bytes | None]]
# Sizes of pages and bounds on results of the paged services.
CURSOR_PAGE, REFERENCE_PAGE, OFFSET_PAGE = 100, 100, 200
MOST_REFERENCES, MOST_IDS = 600, 500


def call(transport: Transport, url: str, kind: str, pace: float) -> tuple[int, bytes | None]:
    """Status and body of one URL after the tries of its kind; 404 (for binaries also 403) ends them, an empty body is none."""
    final, status, body = {404, 403} if kind == "binary" else {404}, 0, None
    for n in range(TRIES[kind]):
        if n:
            time.sleep(pace + BACKOFF_S * n * (pace > 0))
        try:
            status, body = transport(url)
        except OSError:
            status, body = 0, None
        if status == 200 or status in final:
            break
    return status, (body or None) if status == 200 else None


def fetched(urls: DataFrame, transport: Transport, kind: str = "json", pace: float = PACE_S["default"], tasks: int = 1, url_col: str = "url") -> DataFrame:
    """``url_sha256, url, kind, body`` of the distinct URLs that answered; ``body`` is binary for kind ``binary``, else text. Nothing passes the driver."""
    rows = urls.select(F.col(url_col).alias("url")).where("url IS NOT NULL").distinct()
    host = F.regexp_extract("url", "^[^:]*://([^/]*)", 1)
    rows = rows.repartition(host, F.pmod(F.xxhash64("url"), F.lit(tasks)))
    body_type = pa.binary() if kind == "binary" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = []
            for i, url in enumerate(batch.column(0).to_pylist()):
                if i:
                    time.sleep(pace * tasks)
                body = call(transport, url, kind, pace * tasks)[1]
                bodies.append(body if kind == "binary" or body is None else body.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, body_type)], ["url", "body"])

    found = rows.mapInArrow(run, f"url string, body {'binary' if kind == 'binary' else 'string'}").where("body IS NOT NULL")
    return found.select(ids.url_key(F.col("url")).alias("url_sha256"), "url", F.lit(kind).alias("kind"), "body")


def full_text_url(base: str, pmcid: Column) -> Column:
    """Where a record's full text is (S19); null without an id."""
    return F.when(ids.text(pmcid) != "", F.concat(F.lit(base + "/"), pmcid, F.lit("/fullTextXML")))


def _cursor_pages(get: Callable, base: str, query: str, most: int, sort: str = "") -> Iterator[list]:
    cursor, size = "*", min(CURSOR_PAGE, most)
    while True:
        asked = {"query": query, "format": "json", "resultType": "core", "pageSize": size, "cursorMark": cursor} | ({"sort": sort} if sort else {})
        answer = get(f"{base}/search?{urlencode(asked)}")
        page = ((answer or {}).get("resultList") or {}).get("result") or []
        yield page
        following = (answer or {}).get("nextCursorMark")
        if not page or not following or following == cursor:
            return
        cursor = following


def _numbered_pages(get: Callable, base: str, record: str, most: int) -> Iterator[list]:
    number = 1
    while True:
        answer = get(f"{base}/{record}/references?format=json&page={number}&pageSize={REFERENCE_PAGE}")
        page = ((answer or {}).get("referenceList") or {}).get("reference") or []
        yield page
        if len(page) < REFERENCE_PAGE:
            return
        number += 1


def _offset_pages(get: Callable, base: str, term: str, most: int, db: str = "pubmed") -> Iterator[list]:
    start = 0
    while start < most:
        size = min(OFFSET_PAGE, most - start)
        answer = get(f"{base}/esearch.fcgi?{urlencode({'db': db, 'term': term, 'retmode': 'json', 'retmax': size, 'retstart': start, 'sort': 'relevance'})}")
        page = ((answer or {}).get("esearchresult") or {}).get("idlist") or []
        yield page
        if len(page) < size:
            return
        start += len(page)


_STYLES = {"cursor": _cursor_pages, "numbered": _numbered_pages, "offset": _offset_pages}


def paged(queries: DataFrame, transport: Transport, base: str, style: str, most: int, query_col: str = "query", pace: float = PACE_S["default"], tasks: int = 1, **options: str) -> DataFrame:
    """``query, place, item``: the first ``most`` items (JSON text; ids as they are) of each distinct query, places from 0.

    ``style``: ``cursor`` follows the answer's cursor until it is missing or stands still or a page is empty (S17), ``numbered`` counts pages until a
    short one (S18), ``offset`` asks from the number of items so far until a short page (S26). A page that can't be had or read ends its query.
    """
    pages = _STYLES[style]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        calls = 0

        def get(url: str):
            nonlocal calls
            if calls:
                time.sleep(pace * tasks)
            calls += 1
            body = call(transport, url, "json", pace * tasks)[1]
            try:
                return json.loads(body) if body else None
            except ValueError:
                return None

        for batch in batches:
            for query in batch.column(0).to_pylist():
                n = 0
                for page in pages(get, base, query, most, **options):
                    page = page[: most - n]
                    items = [x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in page]
                    yield pa.RecordBatch.from_arrays([pa.array([query] * len(items), pa.string()), pa.array(range(n, n + len(items)), pa.int32()), pa.array(items, pa.string())], ["query", "place", "item"])
                    n += len(items)
                    if n >= most:
                        break

    rows = queries.select(F.col(query_col).cast("string").alias("query")).where("query IS NOT NULL").distinct()
    return rows.repartition(tasks, "query").mapInArrow(run, "query string, place int, item string")


_STRAIN = "struct<sub_type:string,sub_value:string>"
_SUMMARY = f"struct<assemblyaccession:string,organism:string,biosource:struct<infraspecieslist:array<{_STRAIN}>>>"


def catalogue(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """``uid, accession, organism, match_text, rank`` of catalogue summaries (JSON) by the order of their ids.

    match_text is the organism and its strains and isolates, which is what ``catalog_match`` looks in.
    """
    answer = F.get_json_object(body_col, "$.result")
    each = bodies.select(F.from_json(answer, "map<string,string>").alias("m"), F.posexplode(F.from_json(F.get_json_object(body_col, "$.result.uids"), "array<string>")).alias("rank", "uid"))
    rows = each.select("uid", "rank", F.from_json(F.col("m")[F.col("uid")], _SUMMARY).alias("s")).where("s IS NOT NULL")
    strains = F.filter(F.coalesce("s.biosource.infraspecieslist", F.array().cast(f"array<{_STRAIN}>")), lambda x: x["sub_type"].isin("strain", "isolate"))
    text = F.concat_ws(" ", ids.text(F.col("s.organism")), F.array_join(F.transform(strains, lambda x: x["sub_value"]), " "))
    return rows.select("uid", ids.text(F.col("s.assemblyaccession")).alias("accession"), ids.text(F.col("s.organism")).alias("organism"), text.alias("match_text"), "rank")
