"""The index of pieces against a search of all pairs; quotas by rounds; statuses."""

import random

import pytest
from pyspark.sql import functions as F

from quillmine.operators import lineage, match, sampling, state


@pytest.mark.parametrize("salt", [4096, 2, 1])
def test_containing(spark, salt):
    rng = random.Random(salt)
    word = lambda n: "".join(rng.choice("abé-") for _ in range(n))
    entries = [(rng.choice(["g1", "g1", "g1", "g2"]), " ".join(word(rng.randrange(7)) for _ in range(3)), i) for i in range(300)] + [("g1", "", 900), ("g3", "abcdefgh", 901), ("g1", "same", 902), ("g1", "same", 902)]
    tokens = sorted({(rng.choice(["g1", "g2", "g4"]), word(rng.randrange(1, 9))) for _ in range(200)} | {("g3", "abcdefgh"), ("g3", "bcdefg"), ("g3", "abcdefghi"), ("g1", "same"), ("g1", " ")})
    df = spark.createDataFrame(entries, "group string, text string, rank int")
    got = match.containing(spark.createDataFrame(tokens, "group string, token string"), df, salt_rows=salt)
    want = sorted((g, t, x, i) for g, t in tokens for h, x, i in entries if g == h and t in x)
    assert sorted((r.group, r.token, r.text, r["rank"]) for r in got.collect()) == want
    assert match.containing(spark.createDataFrame(tokens, "group string, token string"), df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [0, 1 << 18])
def test_nothing_that_grows_is_broadcast(spark, monkeypatch, most):
    """Files are small beside the rows that come of them, so Spark's estimate lets all of them be broadcast; only the bounded hashes of pieces may be."""
    plans = []

    def kept(df):
        plans.append(df)
        return lineage.cut(df)

    monkeypatch.setattr(match, "cut", kept)
    monkeypatch.setattr(match, "BROADCAST_PIECES", most, raising=False)
    catalog = [(f"GCF_{i}", f"Esch coli{i % 3}", f"Esch coli{i % 3} K-{i % 40}", i) for i in range(200)] + [("GCF_x", "Esch coli1", None, -1), (None, "Esch coli1", "K-1", -2)]
    rows = [(i, f"Esch coli{i % 4} sp.", f"K-{i % 50} (lab)") for i in range(400)]
    found = match.catalog_match(spark.createDataFrame(rows, "observation_id int, organism_name string, strain_name string"), spark.createDataFrame(catalog, "accession string, organism string, match_text string, rank int"))
    want = []
    for i, name, strain in rows:
        species = sorted((n, a) for a, o, _, n in catalog if a and o == name[:-4])
        hit = sorted((n, a) for a, o, m, n in catalog if a and o == name[:-4] and strain[:-6].lower() in (m or "").lower())
        status = "no_genome_found" if not species else "species_only_match" if not hit else "exact_strain_match" if len(hit) == 1 else "multiple_possible_matches"
        want.append((i, status, (hit or species or [(0, "")])[0][1], len(hit)))
    assert sorted((r.observation_id, r.genome_match_status, r.accession, r.n_strain_hits) for r in found.collect()) == want
    told = [p._jdf.queryExecution().executedPlan().toString() for p in [*plans, found]]
    assert sum("BroadcastHashJoin" in p for p in told) == (most > 0)


def test_greedy_quota_with_gaps_and_seen(spark):
    rng = random.Random(7)
    hits = [(t * 3, f"t{t}", p, rng.randrange(9), rng.randrange(25)) for t in range(6) for p in range(2) for _ in range(30)] + [(None, "none", 0, 0, 99)]
    seen = [(x,) for x in range(5)]
    taken, used, want = {x for (x,) in seen}, {}, []
    for t, name, p, r, x in sorted((h for h in hits if h[0] is not None), key=lambda h: (h[0], h[2], h[3], h[4])):
        if x not in taken and used.get(t, 0) < 4:
            taken.add(x)
            used[t] = used.get(t, 0) + 1
            want.append((name, p, r, x))
    df = spark.createDataFrame(hits, "topic_no int, topic string, pass int, rank int, paper_id int")
    found = sampling.greedy_quota(df, 4, spark.createDataFrame(seen, "paper_id int"))
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert sampling.greedy_quota(df.limit(0), 4).count() == 0


def test_statuses(spark):
    old = spark.createDataFrame([("a", "fulltext_fetched"), ("b", "needs_review"), ("c", "screened_relevant"), ("d", "old word")], "k string, s string")
    new = spark.createDataFrame([("a", "metadata_fetched"), ("b", "extraction_complete"), ("c", "needs_review"), ("d", "discovered"), ("e", "needs_review")], "k string, s string")
    got = {r.k: r.s for r in state.upsert(old, new, "k", monotone="s").collect()}
    assert got == {"a": "fulltext_fetched", "b": "extraction_complete", "c": "needs_review", "d": "discovered", "e": "needs_review"}
    with pytest.raises(Exception, match="no such status: lost"):
        state.upsert(old, new.withColumn("s", F.lit("lost")), "k", monotone="s").collect()
