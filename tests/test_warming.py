"""Cache warming, link answers, titles rewritten in place, tallies of writes, phases from the command line."""

import json

import pytest
from pyspark.sql import functions as F

from quillmine import __main__ as command
from quillmine.functions import text
from quillmine.operators import discovery
from quillmine.plans import phases
from quillmine.sources import keyed, paging, responses, warming

CACHE = "url_sha256 string, url string, kind string, body string"


def answer(record):
    return json.dumps({"resultList": {"result": [record] if record else []}}).encode()


def test_warm(spark, tmp_path):
    pages = {
        "https://l?query=DOI%3A%2210.1%2Fa%22": answer({"title": "A", "abstractText": "x", "isOpenAccess": "Y", "pmcid": "PMC1", "doi": "10.1/a"}),
        "https://a/PMC1/fullTextXML": b"<article/>",
        "https://l?query=EXT_ID%3A2": answer({"title": "B", "isOpenAccess": "Y", "pmcid": "PMC2", "doi": "10.1/B"}),
        "https://r/works/https://doi.org/10.1/b": json.dumps({"best_oa_location": {"is_oa": True, "pdf_url": "https://p/b.pdf"}}).encode(),
        "https://p/b.pdf": b"%PDF \xff",
        "https://l?query=EXT_ID%3A3": answer({"title": "C", "abstractText": "y", "isOpenAccess": "N", "doi": ""}),
        "https://r/works/https://doi.org/10.1/c": json.dumps({"best_oa_location": {"is_oa": False, "pdf_url": "https://p/c.pdf"}}).encode(),
        "https://l?query=EXT_ID%3A4": answer(None),
    }
    log = f"{tmp_path}/log"
    (tmp_path / "log").mkdir()

    def transport(url):
        with open(f"{log}/asked", "a") as f:
            f.write(url + "\n")
        return (200, pages[url]) if url in pages else (404, None)

    batch = spark.createDataFrame([("a", "https://doi.org/10.1/A", "", ""), ("b", "", "2", ""), ("c", "", "3", ""), ("d", "", "4", ""), ("e", "", "", "No such"), ("f", "", None, "")], "paper_id string, doi string, pmid string, title string")
    none = spark.createDataFrame([], CACHE)
    blobs = spark.createDataFrame([], CACHE.replace("body string", "body binary"))
    fetch = lambda urls, kind: paging.fetched(urls, transport, kind, 0.0)
    papers, texts, pdfs = warming.warm(batch, none, blobs, fetch, "https://l", "https://a", "https://r")
    assert warming.written(papers, f"{tmp_path}/papers") == {"papers": 6, "abstracts": 2, "articles": 1, "pdfs": 1, "no_record": 3}
    assert {r.paper_id: r.outcome for r in spark.read.parquet(f"{tmp_path}/papers").collect()} == {"a": "article", "b": "pdf", "c": "abstract", "d": "no_record", "e": "no_record", "f": "no_record"}
    assert pdfs.count() == 1 and bytes(pdfs.first().body) == b"%PDF \xff" and texts.count() == 6
    before = len((tmp_path / "log" / "asked").read_text().split())
    again, more, _ = warming.warm(batch, texts, pdfs, fetch, "https://l", "https://a", "https://r")
    assert {r.outcome for r in again.collect()} == {"article", "pdf", "abstract", "no_record"} and more.count() == 0
    asked = (tmp_path / "log" / "asked").read_text().split("\n")[before:]
    assert not any(u in pages for u in asked if u)  # what is cached is not asked for again


def test_link_edges(spark):
    good = json.dumps({"linksets": [{"linksetdbs": [{"links": ["2", "3"]}, {"links": [3, 4]}]}, {"linksetdbs": [{}]}, {}]})
    rows = spark.createDataFrame([("1", "cited_by", good), ("5", "reference", "{}"), ("6", "reference", "{broken"), ("7", "reference", None), ("8", "r", json.dumps({"linksets": []}))], "src string, label string, body string")
    assert sorted(map(tuple, responses.link_edges(rows).collect())) == [("1", "2", "cited_by"), ("1", "3", "cited_by"), ("1", "4", "cited_by")]


def test_titles_are_rewritten_in_place(spark, tmp_path):
    schema = "paper_id string, title string, notes string"
    t = keyed.KeyedTable(spark, str(tmp_path), spark.createDataFrame([], schema).schema, "paper_id")
    t.put(spark.createDataFrame([("a", "A &amp; <i>b</i>", "n"), ("b", "plain", "m"), ("c", None, "")], schema))
    t.rewrite("title", lambda c: F.when(c.isNotNull(), text.clean_title(c)))
    assert {r.paper_id: (r.title, r.notes) for r in t.read().collect()} == {"a": ("A & b", "n"), "b": ("plain", "m"), "c": (None, "")}
    assert spark.read.parquet(f"{tmp_path}/data/{t._last()[1]['deltas'][-1]}").count() == 1


def test_command(spark, tmp_path, capsys):
    records = spark.createDataFrame([("1", "d1", "", "A genetic system", "x", "J", "2001"), ("2", "", "", "Other", "y", "J", "2002")], "pmid string, doi string, pmcid string, title string, abstract string, journal string, year string")
    hits = spark.createDataFrame([("1", "review", "q1", None)], "pmid string, source string, query string, seed string")
    tables = {"records": records, "hits": hits, "edges": spark.createDataFrame([("1", "2", "cited_by")], "src string, dst string, label string"), "passages": spark.createDataFrame([], "paper_id string, bucket string, paragraph int, pos int, text string")}
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}")
    options = [x for name in tables for x in (f"--{name}", f"{tmp_path}/{name}")]
    counts = command.main([f"{tmp_path}/store", *options, "--phases", "search,citations,reports", "--reports", f"{tmp_path}/csv"], spark)
    assert counts["discovered_papers"] == 2 and (tmp_path / "csv" / "discovered_papers").is_dir()
    with pytest.raises(SystemExit):
        command.main([f"{tmp_path}/store", *options, "--phases", "none"], spark)
    store = phases.Store(spark, f"{tmp_path}/other")
    inputs = phases.Inputs(**tables)
    assert phases.search(store, inputs) == {"new": 1, "enriched": 0} and phases.search(store, inputs) == {"new": 0, "enriched": 1}
    assert discovery.hits_to_papers(records, hits).count() == 1
