"""Last rows of keys, store order, summaries and titles on odd rows."""

from quillmine.operators import discovery, reports, selection


def test_last_of_key(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 3, "x"), ("a", 2, "y"), ("b", None, "z"), (None, 9, "n"), ("c", 1, "p"), ("c", 1, "q")], "k string, n int, v string")
    assert sorted(map(tuple, selection.last_of_key(rows, "k", "n").collect())) == [("a", 3, "x"), ("b", None, "z"), ("c", 1, "q")]
    assert selection.last_of_key(rows, "k", "n").columns == rows.columns and selection.last_of_key(rows.limit(0), "k", "n").count() == 0


def test_store_order(spark):
    rows = spark.createDataFrame([("b", "2001"), ("a", "2001"), ("c", None), ("d", ""), ("e", "999")], "paper_id string, year string")
    assert [r.paper_id for r in selection.in_store_order(rows).collect()] == ["c", "d", "a", "b", "e"]


def test_summaries_titles_and_requests(spark):
    seen = spark.createDataFrame([("A", "x"), ("A", "x"), ("A", ""), ("A", None), (None, "x"), ("", "x")], "organism_name string, strain_name string")
    assert tuple(reports.observation_summary(seen).first()) == (6, 2, 3)
    assert tuple(reports.observation_summary(seen.limit(0)).first()) == (0, 0, 0)
    observed = spark.createDataFrame([(1, "p"), (2, "q"), (3, None)], "observation_id int, paper_id string")
    papers = spark.createDataFrame([("p", "Long title"), ("p", "Zeta"), ("r", "other")], "paper_id string, title string")
    assert {r.observation_id: r.paper_title for r in reports.titled(observed, papers, 4).collect()} == {1: "Long", 2: "", 3: ""}
    asked = spark.createDataFrame([("a", " 7 "), ("b", ""), ("c", None)], "paper_id string, pmid string")
    assert [tuple(r) for r in discovery.reference_requests(asked).collect()] == [("a", "MED", "MED/7")]
