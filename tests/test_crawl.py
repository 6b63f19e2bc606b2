"""Crawls that are stopped and resumed, their ends, and global positions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillmine.operators import positions
from quillmine.sources import crawl, paging


def listing(sizes):
    return [(q, f"{q}-{i}", i) for q, n in sizes.items() for i in range(n)]


SIZES = {"a b&c": 450, "q2": 100, "q3": 99, "q4": 201, "q5": 0, "ü": 1}


@pytest.mark.parametrize("style,most", [("cursor", 250), ("cursor", 40), ("numbered", 600), ("numbered", 150), ("offset", 500), ("offset", 300)])
def test_crawl_equals_the_service(spark, tmp_path, style, most):
    rows = spark.createDataFrame(listing(SIZES), "q string, item string, i int").repartition(3)
    recorded = crawl.record_pages(rows, style, "https://h", most, "q", "item", ["i"])
    queries = spark.createDataFrame([(q,) for q in [*SIZES, None, "q2"]], "query string")
    got = crawl.crawl(spark, str(tmp_path), queries, crawl.recorded(recorded), style, "https://h", most).collect()
    name = (lambda x: json.loads(x)["id"]) if style != "offset" else str
    assert sorted((r.query, r.place, name(r.item)) for r in got) == sorted((q, i, item) for q, item, i in listing(SIZES) if i < most)


def test_a_stopped_crawl_goes_on(spark, tmp_path):
    rows = spark.createDataFrame(listing(SIZES), "q string, item string, i int")
    recorded = crawl.record_pages(rows, "numbered", "https://h", 600, "q", "item", ["i"]).cache()
    queries = spark.createDataFrame([(q,) for q in SIZES], "query string")
    calls = []

    def stopping(at):
        def answers(requests):
            calls.append(sorted(r.url for r in requests.select("url").collect()))
            if len(calls) == at:
                raise RuntimeError("the machine went away")
            return crawl.recorded(recorded)(requests)

        return answers

    for at in (2, 5):
        with pytest.raises(Exception, match="went away"):
            crawl.crawl(spark, str(tmp_path), queries, stopping(at), "numbered", "https://h")
    got = crawl.crawl(spark, str(tmp_path), queries, stopping(0), "numbered", "https://h").collect()
    assert sorted((r.query, r.place) for r in got) == sorted((q, i) for q, _, i in listing(SIZES))
    assert calls[1] == calls[2] and calls[4] == calls[5]  # the batch that was stopped is taken again, answered ones are not
    assert all(a != b for a, b in zip(calls[2:4], calls[3:5], strict=True)) and len(calls) < 10
    again = crawl.crawl(spark, str(tmp_path), queries, stopping(0), "numbered", "https://h")
    assert again.count() == len(got)


def test_ends(spark, tmp_path):
    """A cursor that stands still, one that is missing, an empty page, broken and missing answers end their queries alone."""

    def transport(url):
        query = url.split("query=")[1].split("&")[0]
        page = [{"n": 1}]
        answers = {
            "still": {"resultList": {"result": page}, "nextCursorMark": "*"}, "none": {"resultList": {"result": page}}, "empty": {"resultList": {"result": []}, "nextCursorMark": "x"},
            "two": {"resultList": {"result": page}, "nextCursorMark": "x"},
        }
        if query == "two" and "cursorMark=x" in url:
            return 200, json.dumps({"resultList": {"result": [{"n": "é"}]}, "nextCursorMark": "x"}).encode()
        return (200, json.dumps(answers[query]).encode()) if query in answers else (200, b"{broken") if query == "broken" else (404, None)

    queries = spark.createDataFrame([(q,) for q in ("still", "none", "empty", "two", "broken", "gone")], "query string")
    got = crawl.crawl(spark, str(tmp_path), queries, crawl.called(transport, 0.0, 2), "cursor", "https://h", 10).collect()
    assert sorted((r.query, r.place, r.item) for r in got) == [("none", 0, '{"n":1}'), ("still", 0, '{"n":1}'), ("two", 0, '{"n":1}'), ("two", 1, '{"n":"é"}')]
    assert crawl.crawl(spark, f"{tmp_path}/nothing", queries.limit(0), crawl.called(transport, 0.0), "cursor", "https://h").count() == 0


def test_crawl_asks_what_paged_asks(spark, tmp_path):
    asked = {"cursor": set(), "offset": set()}
    for style in asked:
        rows = spark.createDataFrame(listing({"one two": 450}), "q string, item string, i int")
        bodies = {r.url: r.body for r in crawl.record_pages(rows, style, "https://h", 450, "q", "item", ["i"]).collect()}
        found = paging.paged(spark.createDataFrame([("one two",)], "query string"), lambda u, b=bodies: (200, b[u].encode()) if u in b else (404, None), "https://h", style, 450, pace=0.0)
        assert found.count() == 450


def test_positions(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 5 + ["a", None]), rng.randrange(10**6) * 1000 + i, f"v{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, n long, v string").repartition(5)
    order = {r: i for i, r in enumerate(sorted(rows, key=lambda r: r[1]))}
    assert {(r.g, r.n, r.v): r.position for r in positions.with_positions(df, ["n"]).collect()} == order
    got = positions.with_positions(df, ["n"], ["g"]).collect()
    for g in ("hot", "a", None):
        assert [r.n for r in sorted((r for r in got if r.g == g), key=lambda r: r.position)] == sorted(n for h, n, _ in rows if h == g)
        assert sorted(r.position for r in got if r.g == g) == list(range(sum(h == g for h, _, _ in rows)))
    pages = {(r.g, r.page): r["values"] for r in positions.pages(df, "v", 200, ["n"], ["g"]).collect()}
    assert all(len(v) == 200 for (g, p), v in pages.items() if (g, p + 1) in pages)
    assert [v for p in range(99) for v in pages.get(("hot", p), [])] == [v for _, _, v in sorted((r for r in rows if r[0] == "hot"), key=lambda r: r[1])]
    assert positions.with_positions(df.limit(0), ["n"]).count() == 0
    assert sorted(r.position for r in positions.with_positions(df.withColumn("n", F.lit(1)), ["n"]).collect()) == list(range(2000))
