"""Articles read as they come against whole trees, in bounded memory, and as table functions of SQL."""

import random
import tracemalloc
import xml.etree.ElementTree as ET

from quillmine.functions import markup, text


def by_tree(document):
    """Paragraphs from the whole tree."""
    try:
        root = ET.fromstring(document)
    except ET.ParseError:
        return []
    out, words = [], lambda n: " ".join("".join(n.itertext()).split())

    def walk(node, section):
        if node.tag == "p":
            if words(node):
                out.append((section, len(out), words(node)))
            return
        if node.tag == "sec":
            section = next((words(c) for c in node if c.tag == "title"), section)
        for child in node:
            if child.tag not in ("title", "table-wrap", "fig", "disp-formula", "supplementary-material"):
                walk(child, section)

    body = next(root.iter("body"), None)
    if body is not None:
        walk(body, "")
    return out


def article(rng, depth=0):
    tag = rng.choice(["sec", "sec", "p", "p", "title", "fig", "body", "b", "x"])
    inner = "".join(article(rng, depth + 1) for _ in range(rng.randrange(4))) if depth < 5 else ""
    return f"<{tag}>{rng.choice(['', ' w ', 'one  two', '&amp;'])}{inner}</{tag}>{rng.choice(['', 'tail', ' '])}"


def test_paragraphs_are_those_of_the_tree(monkeypatch):
    rng = random.Random(5)
    for i in range(600):
        monkeypatch.setattr(text, "_FED", rng.choice([1, 7, 1 << 16]))
        document = f"<a><front><p>no</p></front>{''.join(article(rng) for _ in range(3))}</a>" if i % 10 else f"<a>{article(rng)}<broken>"
        assert text.body_paragraphs(document) == by_tree(document), document
    assert text.body_paragraphs(None) == text.body_paragraphs("") == text.body_paragraphs("<p>x</p>") == []


def test_memory_is_that_of_a_paragraph():
    document = "<a><body><sec><title>T</title>" + "<p>some words of a paragraph</p>" * 60_000 + "</sec></body></a>"
    tracemalloc.start()
    n = sum(1 for _ in text.each_paragraph(document))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 60_000 and peak < 4_000_000  # the tree would be over 20 MB


def test_table_functions(spark):
    cited = "<table-wrap><label>T</label><tr><td>x <xref ref-type='bibr' rid='r'/></td></tr></table-wrap>"
    docs = [(1, f"<a><body><sec><title>M</title><p>One.</p>{cited}</sec></body><ref id='r'><pub-id pub-id-type='doi'>10.1/x</pub-id></ref></a>"), (2, "<broken"), (3, None)]
    spark.createDataFrame(docs, "id int, xml string").createOrReplaceTempView("articles")
    markup.register(spark)
    assert [tuple(r) for r in spark.sql("select id, section, paragraph, text from articles, lateral article_paragraphs(xml)").collect()] == [(1, "M", 0, "One.")]
    rows = spark.sql("select id, c.row_index, c.table_label, c.cited_doi from articles, lateral table_citations(xml) c").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "T", "10.1/x")]
