"""The pipeline's near copies against brute-force Jaccard similarities of five-word shingles."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from quillmine.llm import nearcopies


def brute_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_pairs(sets):
    where, both = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for found in where.values():
        both.update(combinations(found, 2))
    return {p for p, n in both.items() if 5 * n >= 4 * (len(sets[p[0]]) + len(sets[p[1]]) - n)}


def brute_roots(sets, pairs):
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_stage_drops_near_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: brute_shingles(t) for i, t in texts.items()}
    pairs = brute_pairs(sets)
    assert any(sets[a] != sets[b] for a, b in pairs)
    got = {r.doc_id: r.component for r in nearcopies.near_copies(docs).collect()}
    assert len(got) == len(sets) and all(got[a] == got[b] for a, b in pairs)  # recall 1
    root = brute_roots(sets, pairs)
    assert len(set(got.values())) == len(set(root.values()))  # and nothing else is linked
    assert {r.doc_id for r in cp.drop_near_duplicates(spark, docs, "").collect()} == set(root.values())


def test_linked():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, (3, 200), dtype=np.uint64)
    sets = []
    for i in range(90):
        s = sets[i - 3].copy() if i >= 3 else base[i].copy()
        s[rng.integers(0, 200, 8)] = rng.integers(0, 1 << 63, 8, dtype=np.uint64)
        sets.append(np.unique(s))
    named = {i: set(s.tolist()) for i, s in enumerate(sets)}
    root = brute_roots(named, brute_pairs(named))
    assert len(set(root.values())) < 90
    assert nearcopies.linked(sets).tolist() == [root[i] for i in range(90)]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (4, "ONE two"), (None, "a b c d e f"), (None, "u v w x y z"), (5, "a b c d e g h"), (5, "x " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = nearcopies.near_copies(df)
    assert found.count() == 8 and found.select("component").distinct().count() == 6
    full = df.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "long"))))
    assert cp.drop_near_duplicates(spark, full, "").count() == 6  # texts without an id stay apart
    assert nearcopies.near_copies(df.limit(0)).count() == 0


def test_large_groups_in_chunks(spark, monkeypatch):
    """Groups cut into many chunks, their buckets passed whole: the links are those of brute force all the same."""
    rng = np.random.default_rng(9)
    texts, chain = [], [f"w{i}" for i in range(60)]
    for i in range(120):  # a family around one text, and a chain whose ends are unlike
        words = [f"t{j}" for j in range(120)]
        words[int(rng.integers(120))] = f"x{i}"
        texts.append(" ".join(words))
        if i % 2:
            chain = [*chain[1:], f"c{i}"]
            texts.append(" ".join(chain))
    texts += [f"other {i} text of a few words" for i in range(20)] + texts[:30]
    sets = {i: brute_shingles(t) for i, t in enumerate(texts)}
    root = brute_roots(sets, brute_pairs(sets))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for chunk, bucket, leaders, few in ((1024, 2048, 8, 25), (16, 8, 2, 25), (16, 2048, 1, 25), (16, 8, 2, 0), (16, 2048, 1, 0)):  # 0: by band
        for name, value in (("CHUNK", chunk), ("BUCKET", bucket), ("LEADERS", leaders), ("BROADCAST_ROWS", chunk), ("FEW", few)):
            monkeypatch.setattr(nearcopies, name, value)
        got = {r.doc_id: r.component for r in nearcopies.near_copies(df).collect()}
        assert len(set(zip(got.values(), (root[i] for i in got)))) == len(set(root.values())) == len(set(got.values()))
