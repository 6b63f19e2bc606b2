"""Operators that queries do not show: paging's edges, sinks, first-wins appends, prompts, streaming duplicates."""

import json

from pyspark.sql import functions as F

from quillmine.functions import vocabulary
from quillmine.operators import chat, discovery, graph, lineage, reports, resolve, selection, spans
from quillmine.sources import paging, tables
from quillmine.streaming import ingest


def test_calls_retry_and_end(monkeypatch):
    monkeypatch.setattr(paging.time, "sleep", lambda s: None)
    answers = iter([(500, None), (200, b"ok")])
    assert paging.call(lambda u: next(answers), "u", "json", 0.0) == (200, b"ok")
    seen = []
    assert paging.call(lambda u: seen.append(u) or (404, None), "u", "text", 0.0) == (404, None) and len(seen) == 1
    assert paging.call(lambda u: (403, None), "u", "binary", 0.0) == (403, None) and paging.call(lambda u: (200, b""), "u", "binary", 0.0) == (200, None)

    def broken(url):
        raise OSError

    assert paging.call(broken, "u", "json", 0.0) == (0, None)


def test_fetched_keeps_bytes(spark):
    urls = spark.createDataFrame([("http://a/1",), ("http://a/1",), ("http://b/2",), ("http://b/no",), (None,)], "url string")
    answer = lambda u: (404, None) if u.endswith("no") else (200, b"\xff" + u.encode())
    got = {r.url: r.body for r in paging.fetched(urls, answer, "binary", 0.0, 2).collect()}
    assert got == {u: b"\xff" + u.encode() for u in ("http://a/1", "http://b/2")}
    assert {r.body for r in paging.fetched(urls, lambda u: (200, b"t"), "text", 0.0).collect()} == {"t"}
    assert paging.full_text_url("h", F.lit("PMC1")) is not None


def test_cursor_that_stands_still_and_pages_that_break(spark):
    q = spark.createDataFrame([("still",), ("broken",), ("empty",)], "query string")

    def answer(url):
        if "broken" in url:
            return 200, b"{"
        page = [] if "empty" in url else [{"n": 1}]
        return 200, json.dumps({"resultList": {"result": page}, "nextCursorMark": "*"}).encode()

    assert [(r.query, r.item) for r in paging.paged(q, answer, "h", "cursor", 10, pace=0.0).collect()] == [("still", '{"n": 1}')]


def test_sinks_and_first_wins(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    tables.write_json_array(df, str(tmp_path / "array"))
    (text,) = [r.value for r in spark.read.text(str(tmp_path / "array")).collect()]
    assert json.loads(text) == [{"k": 1, "v": "a"}, {"k": 2}]
    more = spark.createDataFrame([(2, "x", 0), (3, "late", 5), (3, "first", 1)], "k long, v string, at int").repartition(3)
    assert {(r.k, r.v) for r in resolve.append_new(df, more, "k", "at").collect()} == {(1, "a"), (2, None), (3, "first")}
    tables.write_csv(df, str(tmp_path / "csv"), ["k", "v", "w"])
    assert {(r.k, r.v, r.w) for r in tables.read_csv(spark, str(tmp_path / "csv"), ["k", "v", "w"]).collect()} == {("1", "a", ""), ("2", "", "")}


def test_plans_and_prompts():
    plan = discovery.search_plan()
    assert [sum(r == x for r, *_ in plan) for x in ("broad_keyword", "negative_keyword", "review_topic")] == [32, 26, 140]
    assert {s for r, _, _, s in plan if r == "review_topic"} == {"", "CITED desc"} and all(" OR " in q for r, _, q, _ in plan if r == "negative_keyword")
    assert all(q.startswith('"') for s, q in discovery.phrase_plan() if s == "failure_phrase_search")
    prompt = chat.attempt_system(vocabulary.ATTEMPT_OUTCOMES, vocabulary.ATTEMPT_WILD_TYPES, vocabulary.FAILURE_REASONS)
    assert len(chat.ATTEMPT_RULES) == 10 and all(x in prompt for x in ("10. ", "organism_name_raw", "partial_success", "explicit_wild_type", "Cas toxicity"))


def test_reports_and_stamps(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    assert [tuple(r) for r in reports.ranked_counts(rows, "x").collect()] == [("a", 2), ("b", 1)]
    assert [r.x for r in reports.preview(rows, ["x"], 2).collect()] == ["a", "a"]
    stamp = spark.range(1).select(selection.utc_stamp(F.timestamp_seconds(F.lit(0))).alias("t"), F.size(selection.text_set(F.lit("no json"))).alias("n")).first()
    assert tuple(stamp) == ("1970-01-01T00:00:00Z", 0)


def test_packets_with_nothing(spark):
    df = spark.createDataFrame([("p", None, None, None, None, None)], "paper_id string, spans_by_category map<string,array<string>>, regex_accessions map<string,array<string>>, regex_strains array<string>, n_sentences_total int, n_tagged_sentences int")
    r = spans.index_of_packets(df, ["manipulation", "success", "failure", "strain"]).first()
    assert not r.has_signal and r.n_manipulation == r.n_accessions == r.n_strains == 0


def test_late_duplicates_are_dropped(spark, tmp_path):
    """A key comes once, in one file or in two, while it is remembered."""
    schema = "k long, ts timestamp"
    for i, rows in enumerate([[(1, 0), (1, 5), (2, 9)], [(1, 20), (3, 30)]]):
        spark.createDataFrame(rows, "k long, s long").select("k", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = ingest.deduplicated(stream, "k", "ts", "1 hour").writeStream.format("memory").queryName("seen_once").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    assert sorted(r.k for r in spark.table("seen_once").collect()) == [1, 2, 3]


def test_component_rounds_leave_no_files(spark, tmp_path):
    lineage.use_checkpoint_dir(spark)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    count = lambda: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)).__len__()
    before = count()
    chain = spark.range(64).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.root for r in graph.components(chain).collect()} == {0} and count() <= before + 1


def test_layouts_without_the_subpackage(tmp_path):
    """Without the subpackage, with or without the pipeline's file, the library's queries remain; another missing module is not hidden."""
    import os
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "quillmine", tmp_path / "quillmine", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    run = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    without = run()
    (tmp_path / "corpus_pipeline.py").write_text("import quillmine.llm.toxicity\n")
    assert without.stdout.split() and run().stdout == without.stdout
    (tmp_path / "corpus_pipeline.py").write_text("import not_there\n")
    assert "not_there" in run().stderr
