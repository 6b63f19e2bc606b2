"""Samples for training: bounded exactly, alike in any layout, no label left out; and models against explicit sums."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmine.llm import langid, pii, quality, sampling, toxicity


def test_every_label_has_rows(spark):
    rows = spark.range(5000).select((F.col("id") % 900).cast("string").alias("l"), F.xxhash64("id").alias("h"))
    rows = rows.union(spark.range(3000).select(F.lit("hot").alias("l"), F.xxhash64("id").alias("h"))).union(rows.limit(100))
    got = sampling.by_class(rows, "l", ["h"], 4, 2000).collect()
    assert len(got) == 2000 and len({r.l for r in got}) == 901 and max(sum(r.l == "hot" for r in got), 3) <= 4
    again = sampling.by_class(rows.repartition(7, "h"), "l", ["h"], 4, 2000).collect()
    assert sorted(got) == sorted(again)


def test_rows_of_one_id_do_not_all_come(spark):
    docs = spark.range(4000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("x").alias("score"))
    docs = docs.union(spark.createDataFrame([(2, "y" * 100_000, "x"), (4, None, None)], "doc_id long, text string, score string"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    got = sampling.labelled(docs, labels, "toxic", 50).collect()
    assert len(got) <= 100 and len({r.doc_id for r in got}) == len(got)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 and r._y == r.doc_id % 2 for r in got)
    assert sorted(map(repr, sampling.labelled(docs.repartition(5, "text"), labels.coalesce(1), "toxic", 50).collect())) == sorted(map(repr, got))


def brute_grams(text):
    low = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in text.encode())
    return [low[i : i + n] for n in (2, 3, 4) for i in range(len(low) - n + 1)]


def brute_bucket(gram):
    h = len(gram)
    for b in gram:
        h = (h ^ b) * 0x01000193 % 2**32
    h ^= h >> 15
    return (h * 0x85EBCA6B % 2**32) >> 17


def test_langid_against_explicit_mean_and_softmax(spark):
    texts = ["The Cat, sat!", "a", "", "Größe 12 über", "ab" * 3000, "日本"]
    model = langid.fit(["the cat sat on a mat " * 3, "der hund und die katze " * 3] * 40, ["en", "de"] * 40, steps=60)
    got = langid.identify(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    for r in got:
        grams = brute_grams(r.text)
        mean = sum((model["table"][brute_bucket(g)].astype(float) for g in grams), np.zeros(langid.DIM)) / max(1, len(grams))
        z = (mean @ model["w"] + model["b"]) * model["scale"]
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        if not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred == model["names"][p.argmax()] and r.score == pytest.approx(p.max(), abs=1e-4) and r.rejected == (r.score < model["reject"])


def test_toxicity_against_explicit_cumulative_link(spark):
    clean = ["a quiet garden of stones", "some rivers run north", "books about old ships"]
    lists = [["vile", "slur"], ["vile", "garden"], ["slurred", "north"], ["vilest", "ships"]]
    docs = [(i, " ".join(lists[i % 4]) if i % 2 else clean[i % 3]) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = df.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    model = toxicity.train(df, labels)
    weight = dict(zip(model["hashes"].tolist(), model["w"].tolist()))

    def hashes(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return toxicity.feature_hashes(data, np.zeros(1, np.int64), np.array([len(data)]))[:, 0].tolist()

    texts = ["VILE, garden", "slur slur slur", "", "ships", "vilest of slurs"]
    got = toxicity.grade(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    for r in got:
        words = {w for w in "".join(c if c.isalnum() else " " for c in r.text.lower()).split()}
        score = sum(weight.get(h, 0.0) for h in {h for w in words for h in hashes(w)})
        above = 1 / (1 + np.exp(model["theta"] - score))
        assert r.score == pytest.approx(above[0]) and r.severity == pytest.approx(above.sum())
        assert r.grade == int(np.argmax([1 - above[0], above[0] - above[1], above[1]])) and r.toxic == (above[0] >= toxicity.THRESHOLD)
    assert got[0].toxic and not got[2].toxic and not got[3].toxic


def test_quality_features_against_plain_python():
    text = "Some words, SOME words!\nline two 42\nline two 42\n\n" + "x" * 25 + " é"
    ((_, _, stats, rows, words),) = quality.features(pa.array([text]), np.array([np.nan]))
    raw, lines, split = text.encode(), [x for x in text.encode().split(b"\n") if x], text.encode().split()
    share = lambda ok: sum(map(ok, raw)) / len(raw)
    want = {
        "upper": share(lambda b: 65 <= b <= 90), "lower": share(lambda b: 97 <= b <= 122), "digit": share(lambda b: 48 <= b <= 57), "stop": share(lambda b: b in b".,;:"),
        "shout": share(lambda b: b in b"!?"), "line": share(lambda b: b == 10), "blank": share(lambda b: b in b" \t\r\x0b\x0c"), "wide": share(lambda b: b >= 128),
        "word_length": sum(map(len, split)) / len(split), "line_length": np.log1p(len(raw) / len(lines)), "repeated_lines": 1 - len(set(lines)) / len(lines),
        "long_words": sum(len(w) > 20 for w in split) / len(split), "log_words": np.log1p(len(split)), "log_chars": np.log1p(len(raw)),
    }
    for name, value in want.items():
        assert stats[0][quality.STATS.index(name)] == pytest.approx(value), name
    low = [w.lower() for w in split]  # equal words have equal buckets
    assert len(words) == len(low) and all((words[i] == words[j]) == (low[i] == low[j]) for i in range(len(low)) for j in range(i))


def test_counted():
    rng = np.random.default_rng(1)
    found = rng.integers(0, 50, 1000)
    values, counts = sampling.counted(found, 50)
    assert (values == np.unique(found)).all() and counts.sum() == 1000
    values, counts = sampling.counted(np.r_[np.zeros(5000, int), np.arange(1, 5001)], 100)
    assert counts.sum() == 100 and len(values) == 51 and counts[0] == 50 and set(np.diff(values[1:])) == {100}
    assert [len(x) for x in sampling.counted(np.zeros(0, int), 10)] == [0, 0]


def long_text(words, n=9000):
    return " ".join(words[i % len(words)] + words[(i * 7 + i // 5) % len(words)] for i in range(n))


def test_learning_from_texts_that_are_all_long(spark):
    """No length keeps a text from being learned from: one language, one class, is in texts of over 64 KB alone."""
    rows = [(i, long_text(["ab", "ele", "mo", "ti", "ran"][i % 3 :] + ["sun"]) if i % 2 else f"der hund {i} und die katze laufen im garten {i * 7}", ["de", "it"][i % 2]) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert min(len(t) for i, t, _ in rows if i % 2) > 1 << 15
    model = langid.train(docs)
    assert model["names"] == ["de", "it"]
    assert [r.lang_pred for r in langid.identify(spark.createDataFrame([("abele moti ranele suntimo",), ("die katze und der hund",)], "text string"), model).collect()] == ["it", "de"]
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality", "CAST(doc_id % 2 AS INT) AS toxic")
    scored = quality.score(docs, quality.train(docs, labels)).collect()
    assert all(r.predicted == r.doc_id % 2 for r in scored)
    graded = toxicity.grade(docs, toxicity.train(docs, labels)).collect()
    assert all(r.toxic == bool(r.doc_id % 2) for r in graded)


def test_a_bound_on_features_is_exact(spark):
    counts = spark.createDataFrame([(i, 5 + i % 40, i % 3) for i in range(500)], "feature long, t long, c long")
    every = toxicity.tied(counts, 900, 1100).collect()

    def gain(t, c):
        expected = (t + c) * 900 / 2000
        return 2 * (t * np.log(t / expected) + (c * np.log(c / (t + c - expected)) if c else 0)) if t > expected else 0

    want = {i: gain(5 + i % 40, i % 3) for i in range(500)}
    assert {r.feature for r in every} == {i for i, g in want.items() if g >= toxicity.EVIDENCE}
    best = sorted((i for i, g in want.items() if g >= toxicity.EVIDENCE), key=lambda i: (-round(want[i], 9), i))[:37]
    assert {r.feature for r in toxicity.tied(counts, 900, 1100, 37).collect()} == set(best)


def test_examples_are_those_of_the_whole_text(spark):
    text = " ".join(f"call +1 555 {i % 7:03} 4567 or mail a{i}@b.co id 77{i % 5}123" for i in range(300))
    whole, some = pii.examples(text, 1 << 30), pii.examples(text, 64)
    assert len(some) == 64 < len(whole) and all((whole == row).all(1).any() for row in some)
    graph = pii.Graph([text])
    y = graph.labels([pii.base_spans(text)])
    assert (whole[:, 0] == y).all() and whole[:, -5:].sum() == 2 * len(graph.skip)
    left = {b: y[a] for a, b in graph.chain}
    assert [left.get(i, 5) for i in range(len(y))] == whole[:, 1 + pii._OTHERS].tolist()
    docs = spark.createDataFrame([(text,), (text,), ("no sign",), (None,), ("7",)], "text string")
    got = pii.sample_examples(docs)
    assert len(got) == pii.SAMPLE_TOKENS + 1 and len(pii.sample_examples(docs, rows=1)) in (1, pii.SAMPLE_TOKENS)
    assert (pii.sample_examples(docs.repartition(3)) == got).all()
