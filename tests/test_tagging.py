"""Many-term tagging against a search for each term, repeats in linear time, and plans that tag once."""

import random
import time

from pyspark.sql import functions as F

from quillmine.functions import lexicon as lex
from quillmine.functions import vocabulary
from quillmine.operators import spans, tagging

WORDS = {"a": ["he", "she", "hers", "his", "*"], "b": ["ΔrecA", "É*", "he", "a.b", ""], "c": ["zzz"]}


def test_matcher_against_contains():
    rng = random.Random(1)
    matcher = tagging.Matcher(WORDS)
    for _ in range(500):
        s = "".join(rng.choice(["he", "s", "r", "his", "δreca", "é", "a.b", "axb", " ", "z"]) for _ in range(rng.randrange(8)))
        want = {c: found for c, terms in WORDS.items() if (found := [t for t in terms if t.lower().rstrip("*") in s])}
        assert matcher.tags(s) == want and list(matcher.tags(s)) == list(want)
    assert tagging.Matcher({}).tags("x") == {} == tagging.Matcher({"a": []}).tags("x")


def test_documents(spark):
    texts = ["He ran. She said hers! HE RAN. He ran.", "ΔRECA É. Nothing", "", None, "Alpha é. " * 3]
    words = {"a": ["he", "she"], "b": ["Δreca", "é*"]}
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "y"), (0, texts[0], "z")], "doc_id long, text string, hit string")
    got = tagging.tagged_documents(docs, words, n=F.size("sentences")).collect()
    assert len(got) == 7 and all(r.n == r.n_sentences for r in got)
    rows = {r.doc_id: r for r in got}
    assert [(h.pos, h.sentence, h.fresh) for h in rows[0].hit] == [(0, "He ran.", True), (1, "She said hers!", True), (2, "HE RAN.", False), (3, "He ran.", False)]
    assert rows[0].hit[1].tags == {"a": ["he", "she"]} and rows[1].hit[0].tags == {"b": ["Δreca", "é*"]}
    assert rows[2].hit == rows[3].hit == [] and rows[3].n_sentences == 0 and [h.fresh for h in rows[4].hit] == [True, False, False]
    by_expression = docs.select("doc_id", F.explode(F.transform(F.split("text", r"(?<=[.!?]) "), lambda s: lex.tag(s, words))).alias("t")).where(F.size("t") > 0).count()
    assert by_expression == sum(len(r.hit) for r in got)
    assert tagging.term_hits(docs.limit(0), words).count() == 0


def test_one_long_document_is_linear(spark):
    """A document of unlike sentences, whose repeats were once looked for among all others."""
    seconds = {}
    for n in (3_000, 24_000):
        docs = spark.createDataFrame([(1, " ".join(f"The line {i} of strain {i * 7}." for i in range(n)))], "doc_id long, text string")
        began = time.perf_counter()
        assert spans.span_index(docs, {"manipulation": ["the "], "strain": ["strain"]}).first().n_tagged_sentences == n
        assert spans.keyword_spans(docs, {"manipulation": ["the "], "strain": ["strain"]}).count() == 24
        seconds[n] = time.perf_counter() - began
    assert seconds[24_000] < 12 * seconds[3_000] + 10  # 64 times, where it was quadratic


def test_sentences_are_tagged_once(spark):
    docs = spark.createDataFrame([(1, "The strain failed. No license.")], "doc_id long, text string")
    index = spans.span_index(docs, vocabulary.SENTENCE_LEXICON, patterns={"n": r"\d+"})
    plan = index.where("has_signal").select("doc_id", "n_tagged_sentences")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("split(") == 1
