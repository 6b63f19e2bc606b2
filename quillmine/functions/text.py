"""Segmenting and cleaning text (F6-F12, F35, W5). Built-ins, except for entities, which Spark cannot unescape."""

from __future__ import annotations

import html
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ids import collapse, text

_BREAK = r"""(?<=[.!?])\s+(?=[A-Z("'])"""
SENTENCES = T.ArrayType(T.StructType([T.StructField("section", T.StringType()), T.StructField("paragraph", T.IntegerType()), T.StructField("text", T.StringType())]))


def fold(col: Column) -> Column:
    """Form in which quotes and sentences are compared."""
    return F.lower(collapse(text(col)))


def sentences(col: Column) -> Column:
    """Sentences of a text, blanks collapsed, none empty."""
    return F.filter(F.split(collapse(text(col)), _BREAK, -1), lambda s: F.trim(s) != "")


@F.pandas_udf(T.StringType())
def unescape(col: pd.Series) -> pd.Series:
    """HTML entities as characters."""
    return col.map(html.unescape, na_action="ignore")


def named(col: Column, entities: dict[str, str]) -> Column:
    """Those entities as their characters, one after another; all else stays, also an entity without its semicolon."""
    for entity, char in entities.items():
        col = F.replace(col, F.lit(entity), F.lit(char))
    return col


def clean_title(col: Column, entities: dict[str, str] | None = None) -> Column:
    """Entities unescaped, then tags dropped. With ``entities`` only those are, by :func:`named`, and null stays null."""
    return F.regexp_replace(unescape(text(col)) if entities is None else named(col, entities), "<[^>]+>", "")


def abstract_sentences(col: Column) -> Column:
    """Sentences of an abstract whose ``<h4>`` headings become ``. Heading: ``."""
    headed = F.regexp_replace(unescape(text(col)), r"(?i)<h4>(.*?)</h4>", ". $1: ")
    return sentences(F.regexp_replace(headed, "<[^>]+>", " "))


def paragraphs(col: Column) -> Column:
    """Paragraphs between blank lines, none empty."""
    return F.filter(F.split(text(col), r"\n\s*\n", -1), lambda p: F.trim(p) != "")


def plain_sentences(col: Column, section: str = "") -> Column:
    """Sentences of a text whose paragraphs are set off by blank lines, with their paragraph's number from 0."""

    def of(p: Column, i: Column) -> Column:
        return F.transform(sentences(p), lambda s: F.struct(F.lit(section).alias("section"), i.cast("int").alias("paragraph"), s.alias("text")))

    return F.flatten(F.transform(paragraphs(col), of))


_SKIPPED = {"table-wrap", "fig", "disp-formula", "supplementary-material"}


#: Characters of a document that the parser is given at once.
_FED = 1 << 16


def events(document: str) -> Iterator[tuple[str, ET.Element]]:
    """The starts and ends of a document's elements, as it is read; ParseError where it breaks."""
    parser = ET.XMLPullParser(("start", "end"))
    for lo in range(0, len(document), _FED):
        parser.feed(document[lo : lo + _FED])
        yield from parser.read_events()
    parser.close()
    yield from parser.read_events()


def _content(node: ET.Element) -> str:
    return " ".join("".join(node.itertext()).split())


def _tag(node: ET.Element) -> str:
    return node.tag.rsplit("}", 1)[-1] if isinstance(node.tag, str) else ""


def _walked(document: str) -> Iterator[tuple[str, tuple, str]]:
    """('title', chain, text) and ('p', chain, text) of an article's first body, in document order; a chain holds the numbers of the sections around, innermost first.

    Elements are dropped as soon as they end, so a paragraph or title is held at a time.
    """
    modes: list[tuple[str, str, tuple]] = []  # of the open elements: how they are read, their tag, their chain
    open_: list[ET.Element] = []
    sections, bodies, titled = 0, 0, set()
    for event, node in events(document):
        tag = _tag(node)
        if event == "start":
            mode, parent, chain = modes[-1] if modes else ("out", "", ())
            if mode == "out":
                mode = "body" if tag == "body" and not bodies else "out"
                bodies += mode == "body"
            elif mode in ("p", "title"):
                mode = "part"
            elif mode == "body":
                if tag == "p":
                    mode = "p"
                elif tag == "title":
                    mode = "title" if parent == "sec" and chain[0] not in titled else "skip"
                    titled.update(chain[:1] if mode == "title" else ())
                elif tag in _SKIPPED:
                    mode = "skip"
                elif tag == "sec":
                    sections, chain = sections + 1, (sections, *chain)
            modes.append((mode, tag, chain))
            open_.append(node)
            continue
        mode, _, chain = modes.pop()
        open_.pop()
        if mode in ("p", "title"):
            yield mode, chain, _content(node)
        if mode != "part" and open_:
            open_[-1].remove(node)


def each_paragraph(document: str | None) -> Iterator[tuple[str, int, str]]:
    """(section title, paragraph number, text) of an article's body in document order; nothing if it can't be parsed.

    Two readings: one finds the titles, wherever in a section they stand, and whether the document is sound; the other gives the paragraphs.
    """
    try:
        titles = {chain[0]: words for kind, chain, words in _walked(document or "") if kind == "title"}
    except ET.ParseError:
        return
    number = 0
    for kind, chain, words in _walked(document or ""):
        if kind == "p" and words:
            yield next((titles[c] for c in chain if c in titles), ""), number, words
            number += 1


def body_paragraphs(document: str | None) -> list[tuple[str, int, str]]:
    return list(each_paragraph(document))


@F.pandas_udf(SENTENCES)
def article_paragraphs(col: pd.Series) -> pd.Series:
    return col.map(lambda x: [{"section": s, "paragraph": p, "text": t} for s, p, t in body_paragraphs(x)])


def article_sentences(col: Column) -> Column:
    """Sentences of a JATS article with section titles and paragraph numbers."""
    return F.flatten(F.transform(article_paragraphs(col), lambda p: F.transform(sentences(p["text"]), lambda s: F.struct(p["section"].alias("section"), p["paragraph"].alias("paragraph"), s.alias("text")))))


def best_sentences(article: Column, pdf: Column, abstract: Column) -> tuple[Column, Column]:
    """(sentences, source name) from the first of article, PDF text and abstract that has any."""
    cells = [("jats", article_sentences(article)), ("pdf", plain_sentences(pdf)), ("abstract", F.transform(abstract_sentences(abstract), lambda s: F.struct(F.lit("abstract").alias("section"), F.lit(0).alias("paragraph"), s.alias("text"))))]
    found, name = F.lit(None).cast(SENTENCES), F.lit("none")
    for source, cell in reversed(cells):
        found, name = F.when(F.size(cell) > 0, cell).otherwise(found), F.when(F.size(cell) > 0, source).otherwise(name)
    return found, name
