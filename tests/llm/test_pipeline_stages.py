"""Each stage against brute force on its own input, with repeated rows, null ids, extra and clashing columns."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_nearcopies import brute_pairs, brute_roots, brute_shingles
from test_operators import brute_base, brute_contaminated

import corpus_pipeline as cp
from quillmine.llm import mixing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest documents, some of them repeated, some without id, text, language or source, and columns that the stages use as names."""
    read = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, "no id here", None, None, None), (None, None, "en", "x", 0), (9001, None, "en", "x", 0), (9002, "", "en", "x", 0), (9003, "no id here", "en", "x", 10)], read.schema)
    rows = read.union(read.where("doc_id < 20")).union(read.where("doc_id < 5")).union(odd)
    return rows.select("*", *(F.lit(1).alias(c) for c in ("_key", "n", "copies", "text_hash", "component", "lead", "_i"))).repartition(3).cache()


def counted(df):
    assert df.columns[:5] == cp.COLUMNS
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_near_duplicates(spark, docs):
    got = counted(cp.drop_near_duplicates(spark, docs, SF))
    rows = sorted({(r.doc_id is None, r.doc_id or 0, r.doc_id, r.text or "") for r in docs.collect()})
    sets = {i: brute_shingles(r[3]) for i, r in enumerate(rows)}
    empty = [i for i, s in sets.items() if not s]
    root = brute_roots(sets, brute_pairs(sets) | set(zip(empty, empty[1:])))
    assert set(got.values()) == {1} and len(got) == len(set(root.values()))
    assert {k[0] for k in got} == {rows[i][2] for i in set(root.values())}


@pytest.mark.parametrize("limit", [1 << 18, 0])
def test_keys_are_joined_either_way(spark, docs, limit, monkeypatch):
    near, pure = counted(cp.drop_near_duplicates(spark, docs, SF)), counted(cp.drop_contaminated(spark, docs, SF))
    monkeypatch.setattr(cp, "BROADCAST_KEYS", limit)
    assert counted(cp.drop_near_duplicates(spark, docs, SF)) == near and counted(cp.drop_contaminated(spark, docs, SF)) == pure


def test_contaminated(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {t: not brute_contaminated(t, items)[1] for t in {r.text for r in docs.collect()}}
    want = Counter((r.doc_id, r.text) for r in docs.collect() if clean[r.text])
    assert counted(cp.drop_contaminated(spark, docs, SF)) == want and 0 < sum(want.values()) < docs.count()


def test_pii(spark, docs):
    hidden = defaultdict(list)
    for r in cp.redact_pii(spark, docs, SF).collect():
        hidden[r.doc_id].append(r)
    for r in docs.collect():
        for h in hidden[r.doc_id]:
            if r.doc_id is not None:
                assert (h.text is None) == (r.text is None) and (h.text != r.text) >= bool(brute_base(r.text))
                assert h.n_chars == (r.n_chars if h.text == r.text else len(h.text))
    assert sum(map(len, hidden.values())) == docs.count()


def test_mixing(spark, docs):
    got = Counter((r.doc_id, r.source, r.text) for r in cp.mix_sources(spark, docs, SF).collect())
    sizes = {(r.doc_id, r.source, r.text): mixed for r in docs.collect() for mixed in [len((r.text or "").split())]}
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id, r.source, r["size"]] += r.copies
    have = Counter()
    for k, n in got.items():
        have[k[0], k[1], sizes[k]] += n
    assert have == +want
    again = Counter((r.doc_id, r.source, r.text) for r in cp.mix_sources(spark, docs.repartition(7, "text"), SF).collect())
    assert again == got


def test_toxicity(spark, docs):
    kept = counted(cp.drop_toxic(spark, docs, SF))
    assert kept <= Counter((r.doc_id, r.text) for r in docs.collect())
    assert all(kept[k] for k in ((None, None), (9001, None), (9002, "")))
