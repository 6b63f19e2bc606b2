"""Articles hold the whole text of their documents."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from quillmine.plans.registry import QUERIES


def test_every_line_becomes_sentences(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.doc_id % 10 != 9}
    assert any(t.count("\n") > 2 for t in texts.values())
    got = defaultdict(list)
    for r in QUERIES["jats_sections"](spark, sf_dir).orderBy("doc_id", "pos").collect():
        got[r.doc_id] += r.sentence.split()
    assert dict(got) == {i: w for i, t in texts.items() if (w := re.sub("[<>&]", " ", t).split())}


def test_forbidden_characters_and_sections(spark, tmp_path):
    rows = [(1, "One a.\n\nThree\x00 b\x1f <c>.\nFour \U0001f642 d\ufffe."), (2, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["jats_sections"](spark, str(tmp_path)).orderBy("pos").select("doc_id", "section", "paragraph", "sentence").collect()
    assert [tuple(r) for r in got] == [(1, "Methods", 0, "One a."), (1, "Methods", 1, "Three b c ."), (1, "Results", 2, "Four \U0001f642 d .")]
    assert QUERIES["table_refs"](spark, str(tmp_path)).where(F.col("doc_id") == 1).count() == 2
