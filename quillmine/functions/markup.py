"""Bibliographic XML (P2, F35-F38, J15), read element by element: a record, a reference or a table is held at a time. Malformed documents give nothing.

As columns (pandas UDFs that give arrays) and as table functions, for lateral joins and SQL (:func:`register`).
"""

from __future__ import annotations

import re
import urllib.parse
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import each_paragraph, events

_STRING = T.StringType()
RECORD_FIELDS = ("pmid", "doi", "pmcid", "title", "abstract", "journal", "year", "authors")
RECORD = T.StructType([*(T.StructField(n, _STRING) for n in RECORD_FIELDS), T.StructField("pub_types", T.ArrayType(_STRING))])
CITED_FIELDS = ("table_label", "table_caption", "row_text", "organism_guess", "cited_doi", "cited_pmid", "cited_title", "cited_year", "cited_source")
CITED = T.StructType([T.StructField("row_index", T.IntegerType()), *(T.StructField(n, _STRING) for n in CITED_FIELDS)])
_BARE_DOI = re.compile(r"\b10\.\d{4,9}/\S+")


def words(node: ET.Element | None) -> str:
    return "" if node is None else " ".join("".join(node.itertext()).split())


def elements(document: str, tag: str) -> Iterator[ET.Element]:
    """The outermost elements of a tag, whole, one after another; all else is dropped as it is read. ParseError where the document breaks."""
    open_: list[ET.Element] = []
    inside = 0
    for event, node in events(document):
        if event == "start":
            open_.append(node)
            inside += node.tag == tag
            continue
        open_.pop()
        inside -= node.tag == tag
        if not inside:
            if node.tag == tag:
                yield node
            if open_:
                open_[-1].remove(node)


def _link(node: ET.Element) -> str:
    return next((v.strip() for k, v in node.attrib.items() if k.rpartition("}")[2] == "href"), "")


def pubmed_records(document: str | None) -> list[dict]:
    """Flat records of a PubMed answer: labelled abstract parts, Year or the first word of MedlineDate, ``Last First`` authors."""
    try:
        return [_record(a) for found in elements(document or "", "PubmedArticle") for a in found.iter("PubmedArticle")]
    except ET.ParseError:
        return []


def _record(article: ET.Element) -> dict:
    def first(path: str) -> str:
        return words(article.find(path))

    inner = "MedlineCitation/Article"
    parts = [(p.get("Label"), words(p)) for p in article.findall(f"{inner}//Abstract/AbstractText")]
    date = f"{inner}/Journal//JournalIssue/PubDate"
    names = [(words(a.find("LastName")), words(a.find("ForeName"))) for a in article.findall(f"{inner}//AuthorList/Author")]
    ids = {i.get("IdType"): words(i) for i in article.findall(".//PubmedData/ArticleIdList/ArticleId")}
    return {
        "pmid": first("MedlineCitation/PMID"), "doi": ids.get("doi", ""), "pmcid": ids.get("pmc", ""), "title": first(f"{inner}/ArticleTitle"),
        "abstract": " ".join(f"{label}: {x}" if label else x for label, x in parts), "journal": first(f"{inner}/Journal/Title"),
        "year": first(f"{date}/Year") or (first(f"{date}/MedlineDate").split() or [""])[0], "authors": "; ".join(f"{a} {b}".strip() for a, b in names if a),
        "pub_types": [words(p) for p in article.findall(f"{inner}//PublicationTypeList/PublicationType")],
    }


def _reference(ref: ET.Element) -> dict[str, str]:
    """Identifiers by typed id, else by typed link; title by element, else from a scholar link, else the source."""
    links = [(x.get("ext-link-type", ""), _link(x)) for x in ref.iter("ext-link")]
    found = {}
    for kind in ("doi", "pmid"):
        typed = [(p.text or "").strip() for p in ref.iter("pub-id") if p.get("pub-id-type") == kind]
        found[kind] = next(iter(typed[::-1]), "") or next((u for t, u in links if t == kind and u), "")
    scholar = [m[1] for t, u in links if t == "google-scholar" and (m := re.search(r"[?&]title=([^&]+)", u))]
    source = words(ref.find(".//source"))
    title = words(ref.find(".//article-title")) or next((urllib.parse.unquote_plus(x).strip() for x in scholar), "") or source
    if not (title or found["doi"] or found["pmid"]) and (m := _BARE_DOI.search(words(ref))):
        found["doi"] = m[0].rstrip(".,;)")
    return {"cited_doi": found["doi"], "cited_pmid": found["pmid"], "cited_title": title, "cited_year": words(ref.find(".//year")), "cited_source": source}


def each_citation(document: str | None) -> Iterator[dict]:
    """A record for each reference that a table row cites, of rows that cite any known one.

    Two readings, as references stand after the tables: one for them, one for the tables.
    """
    try:
        references = {r.get("id"): _reference(r) for found in elements(document or "", "ref") for r in found.iter("ref") if r.get("id")}
    except ET.ParseError:
        return
    for found in elements(document or "", "table-wrap"):
        for table in found.iter("table-wrap"):
            yield from _table_rows(table, references)


def cited_rows(document: str | None) -> list[dict]:
    return list(each_citation(document))


def _table_rows(table: ET.Element, references: dict[str, dict]) -> Iterator[dict]:
    head = {"table_label": words(table.find("label")), "table_caption": words(table.find("caption"))}
    for i, row in enumerate(table.iter("tr")):
        cells = [*row.findall("td"), *row.findall("th")]
        italic = (" ".join(filter(None, map(words, c.iter("italic")))) for c in cells)
        shared = {"row_index": i, "row_text": " | ".join(map(words, cells)), "organism_guess": next(filter(None, italic), "")}
        for mark in row.iter("xref") if cells else ():
            ref = references.get(mark.get("rid")) if mark.get("ref-type") == "bibr" else None
            if ref and (ref["cited_doi"] or ref["cited_pmid"] or ref["cited_title"]):
                yield head | shared | ref


@F.pandas_udf(T.ArrayType(RECORD))
def records(document: pd.Series) -> pd.Series:
    return document.map(pubmed_records)


@F.pandas_udf(T.ArrayType(CITED))
def citations(document: pd.Series) -> pd.Series:
    return document.map(cited_rows)


@F.udtf(returnType="section string, paragraph int, text string")
class ArticleParagraphs:
    """Rows of an article's paragraphs."""

    def eval(self, document: str):
        yield from each_paragraph(document)


@F.udtf(returnType=CITED)
class Citations:
    """Rows of what an article's tables cite."""

    def eval(self, document: str):
        for row in each_citation(document):
            yield tuple(row[f] for f in CITED.names)


def register(spark: SparkSession) -> None:
    """Make the table functions ``article_paragraphs`` and ``table_citations`` known to SQL."""
    spark.udtf.register("article_paragraphs", ArticleParagraphs)
    spark.udtf.register("table_citations", Citations)
