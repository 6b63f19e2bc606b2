"""Rows that once stopped an executor or took days: URLs with endless endings, texts full of personal data."""

import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from quillmine.llm import pii, urlfilter


@pytest.mark.parametrize("tail", ["/" * 100_000, ".html" * 100_000, ".htm/" * 100_000, "/" * 100_000 + "x", ".html" * 100_000 + "l", "\x01" * 1000 + ".htm"])
def test_long_endings(spark, tail):
    rows = spark.createDataFrame([(1, "http://h/a" + tail), (2, "http://h/a")], "page_id long, url string")
    path = "/a" + re.sub(r"[\x01]", "\x01", tail)
    while path.endswith(("/", ".html", ".htm")):
        path = path.rstrip("/")
        n = len(path)
        while path[:n].endswith((".html", ".htm", "/")):
            n -= 5 if path[:n].endswith(".html") else 4 if path[:n].endswith(".htm") else 1
        path = path[:n]
    got = {r.page_id: r for r in urlfilter.judge(rows, rows.where("page_id = 2")).collect()}
    assert got[1].path == "/a" + tail and got[1].verdict == ("block" if path == "/a" else "allow") and got[2].verdict == "block"


def test_trimmed_agrees_with_a_pattern(spark):
    rng = random.Random(3)
    paths = ["".join(rng.choice(["/", ".html", ".htm", ".", "l", "a", "\x01", "\x02", "\x03", "b", "c", "html"]) for _ in range(rng.randrange(9))) for _ in range(4000)]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", urlfilter.trimmed(F.col("p")).alias("t")).collect()
    con = duckdb.connect()
    for r in got:
        assert r.t == re.sub(r"(\.html?|/)+\Z", "", r.p)
    some = got[:50]
    assert [r.t for r in some] == [con.execute("select regexp_replace(?, '(\\.html?|/)+$', '')", [r.p]).fetchone()[0] for r in some]


def test_a_megabyte_of_spans(spark):
    weights = pii.fit(["call +1 555 123 4567 now", "mail a@b.co or 10.0.0.1"])
    times = {}
    for n in (4, 16):
        text = " ".join(f"+1 555 {i % 1000:03} {i % 10_000:04} and u{i}@host.org" for i in range(n * 1500))
        began = time.perf_counter()
        base = pii.base_spans(text)
        added = pii.added_spans([text], [base], weights)[0]
        times[n] = time.perf_counter() - began
        assert len(base) == 2 * n * 1500 and not any(s < e and b < t for s, t, _ in added[:50] for b, e, _ in base)
    assert len(text) > 800_000 and times[16] < 8 * times[4] + 5  # four times the text, far from sixteen times the seconds


def test_first_overlaps():
    rng = random.Random(6)
    for _ in range(300):
        spans = sorted(((s := rng.randrange(40), s + rng.randrange(1, 12), rng.randrange(4)) for _ in range(rng.randrange(1, 9))), key=pii.by_place)
        asks = [(s := rng.randrange(45), s + rng.randrange(1, 5)) for _ in range(20)]
        import numpy as np

        got = pii._first_overlaps(spans, np.array([a for a, _ in asks]), np.array([b for _, b in asks])).tolist()
        assert got == [next((i for i, (s, e, _) in enumerate(spans) if s < b and a < e), -1) for a, b in asks]


def test_a_text_does_not_depend_on_its_batch():
    rng = random.Random(8)
    texts = ["id 555123 and 555123 then 555123", "call +1 555 123 4567 or 4567 555 call", *(" ".join(str(rng.randrange(200)) for _ in range(60)) for _ in range(8))]
    weights = pii.fit(texts)
    weights["pair"] *= 3
    weights["skip"] += 1.0
    alone = pii.Graph([texts[0]])
    p = pii.marginals(alone, weights)
    both = pii.Graph(texts)
    assert (pii.marginals(both, weights)[: len(alone.at)] == p).all()
