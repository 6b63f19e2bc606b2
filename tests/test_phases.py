"""A discovery run from search to reports over small tables, run again, and its parts."""

import json

from pyspark.sql import functions as F

from quillmine.operators import discovery
from quillmine.plans import phases
from quillmine.sources import tables


def client(system, prompt):
    assert "electroporation" in prompt
    return json.dumps([{"organism_name_raw": "Vibrio x", "species": "Vibrio x", "strain": "A1", "outcome": "failure", "technique_normalized": "transformation", "evidence_method": "We used electroporation.", "evidence_result": "invented"}])[:-1]


def test_run(spark, tmp_path):
    records = spark.createDataFrame(
        [("1", "d1", "", "A genetic system", "x", "J", "2001"), ("2", "", "", "No transformants", "no transformants by electroporation; conjugation", "J", "2002"), ("3", "", "", "Other", "plain", "J", "2003")],
        "pmid string, doi string, pmcid string, title string, abstract string, journal string, year string",
    )
    hits = spark.createDataFrame([("1", "review", "q1", None), ("1", "generic", "q2", None), ("9", "generic", "q2", None)], "pmid string, source string, query string, seed string")
    edges = spark.createDataFrame([("1", "2", "cited_by"), ("1", "3", "reference"), ("2", "3", "reference")], "src string, dst string, label string")
    one = discovery.hits_to_papers(records, hits).first().paper_id
    passages = spark.createDataFrame([(one, "METHODS", 1, 0, "We used electroporation."), (one, "RESULTS", 2, 1, "There were no transformants in two strains.")], "paper_id string, bucket string, paragraph int, pos int, text string")
    inputs = phases.Inputs(records, hits, edges, passages)
    for _ in range(2):
        out = phases.run(spark, str(tmp_path), inputs, client)
    papers = {r.pmid: r for r in out["discovered_papers"].collect()}
    assert papers["1"].processing_status == "extraction_complete" and papers["1"].discovery_sources == ["generic", "review"] and papers["1"].candidate_score == 3 + 5 + 6 + 3
    assert papers["2"].processing_status == "screened_relevant" and papers["2"].discovery_sources == ["cited_by"] and papers["3"].processing_status == "fulltext_unavailable"
    (attempt,) = out["engineering_attempts"].collect()
    assert attempt.attempt_id == f"{one}-ATT01" and attempt.needs_review and attempt.methods_chunk_ids == ["methods_1"] and attempt.paper_title == "A genetic system"
    assert out["failures"].count() == 1 and out["successes"].count() == 0 and out["attempt_summary"].first().n_strains == 1
    assert phases.run(spark, str(tmp_path), inputs, None, ("screen",)) == {}


def test_seeds_names_and_references(spark, tmp_path):
    rows = spark.createDataFrame([(False, ["review_reference"], "1", None), (True, ["review_reference"], "2", ""), (None, ["broad_keyword"], "3", ""), (None, ["review_reference"], "", None), (None, ["review_reference"], "", "d")], "is_review boolean, routes array<string>, pmid string, doi string")
    assert sorted((r.pmid, r.doi) for r in discovery.review_seeds(rows).collect()) == [("", "d"), ("1", None)]
    seen = spark.createDataFrame([("A  b",), ("one two three four five",), ("",), (None,)], "organism_name string")
    tried = spark.createDataFrame([("C d",), ("A b",), ("",)], "species string")
    names = discovery.organism_names(seen, tried, spark.createDataFrame([("E f",)], "value string"))
    assert sorted(r[0] for r in names.collect()) == ["A b", "C d", "E f"]
    assert discovery.organism_queries(names.where("organism = 'A b'"), ["x", "y z"]).first().query == '"A b" AND (x OR "y z")'
    body = json.dumps({"referenceList": {"reference": [{"id": "7", "source": "MED", "title": "T."}, {"doi": "d"}, {"pubYear": "1999"}]}})
    got = discovery.references(spark.createDataFrame([("r", body), ("s", None)], "paper_id string, body string")).collect()
    assert [(r.title, r.doi, r.pmid) for r in got] == [("T", "", "7"), ("[untitled reference, doi=d]", "d", "")]
    assert tables.stale(spark, f"{tmp_path}/none", str(tmp_path)) and not tables.stale(spark, str(tmp_path), f"{tmp_path}/none")
    assert discovery.hits_to_papers(spark.createDataFrame([], "pmid string, pmcid string, doi string, title string, abstract string, journal string, year string"), spark.createDataFrame([], "pmid string, source string, query string, seed string")).agg(F.count("*")).first()[0] == 0
