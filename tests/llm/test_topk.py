"""Top-k search against brute force: exact integers of any size, repeated rows as the SQL has them, pruning where the data allow it."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillmine.llm import queries, topk


def brute(q_ids, q, p_ids, p, k=10):
    out = {}
    for i, v in zip(q_ids, q):
        scores = [(-min(max(sum(int(a) * int(b) for a, b in zip(v, w)), -(1 << 63)), (1 << 63) - 1), int(j)) for j, w in zip(p_ids, p) if j != i]
        out[int(i)] = [(-s, j) for s, j in sorted(scores)[:k]]
    return out


def searched(q_ids, q, p_ids, p, k=10):
    found = topk.Search(topk.CoverTree(q), np.asarray(q_ids), topk.CoverTree(p), np.asarray(p_ids), k)
    return {int(i): [(int(s), int(j)) for s, j in zip(found.score[r][on], found.ids[r][on])] for r, (i, on) in enumerate(zip(q_ids, found.found))}, found.pairs


@pytest.mark.parametrize("size", [3, 10**5 * 1024, 10**9, 1 << 62])
def test_exact_integers(size):
    rng = np.random.default_rng(5)
    x = rng.integers(-size, size, (300, 7))
    ids = np.arange(300)
    assert searched(ids[::9], x[::9], ids, x)[0] == brute(ids[::9], x[::9], ids, x)


def test_covering_and_separation_hold():
    rng = np.random.default_rng(6)
    for x in (rng.integers(-900, 900, (2500, 16)), np.repeat(rng.integers(-9, 9, (40, 4)), 30, 0) * 100 + rng.integers(0, 3, (1200, 4))):
        tree = topk.CoverTree(x)

        def below(n):
            return np.concatenate([tree.singles[n], *(below(c) for c in tree.children[n])])

        assert sorted(below(0).tolist()) == list(range(len(x)))
        for n in range(len(tree.centre)):
            rows = below(n)
            far = np.sqrt(((x[rows] - x[tree.centre[n]]).astype(float) ** 2).sum(1))
            assert far.max() <= tree.radius[n]
            heads = [tree.centre[c] for c in tree.children[n]] + (tree.singles[n].tolist() if len(tree.children[n]) else [])
            if len(heads) > 1:
                apart = np.sqrt(((x[heads][:, None] - x[heads][None]).astype(float) ** 2).sum(-1))
                assert apart[~np.eye(len(heads), dtype=bool)].min() >= far.max() / 2 * (1 - 1e-6)


def test_clusters_are_pruned():
    rng = np.random.default_rng(7)
    x = np.repeat(rng.integers(-4000, 4000, (150, 24)), 40, 0) + rng.integers(-20, 20, (6000, 24))
    ids = np.arange(6000)
    got, pairs = searched(ids[::100], x[::100], ids, x)
    assert got == brute(ids[::100], x[::100], ids, x) and pairs < 0.1 * 60 * 6000


def test_repeated_rows_as_the_sql_has_them(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    ids = [0, 0, 100, 100, 100, 200, *rng.integers(1, 90, 60).tolist()]
    vectors = [[float(v) for v in rng.integers(-3, 3, 5)] for _ in ids]
    vectors[1], vectors[3] = vectors[0], vectors[2]
    rows = pd.DataFrame({"vec_id": ids + [7] * 30, "embedding": vectors + [[2.0, 1.0, 0.0, 1.0, 2.5]] * 30})
    rows.to_parquet(tmp_path / "embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet'")
    want = sorted(map(tuple, con.execute(f"select query_id, rank, vec_id, score from ({queries._OP7})").fetchall()))
    for block in (16_384, 16):
        monkeypatch.setattr(topk, "POINT_BLOCK", block)
        monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
        assert sorted(tuple(r) for r in queries.op7_topk(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()) == want


def test_large_components_do_not_crash(spark):
    df = spark.createDataFrame([(0, [1e5, 1e5]), (1, [1e5, 1.0]), (2, [3e38, 3e38]), (100, [-3e38, 3e38])], "vec_id long, embedding array<float>")
    df = df.select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(df, df.where("vec_id % 100 = 0")).collect()}
    assert len(got) == 6 and got[0, 1] == 102_400_000 * 102_400_000 + 102_400_000 * 1024 and got[0, 2] == (1 << 63) - 1


def test_pruned_regions_hold_no_answer():
    rng = np.random.default_rng(9)
    for spread, cut in ((20, 0.2), (4000, 1.01)):
        x = np.repeat(rng.integers(-4000, 4000, (30, 16)), 60, 0) + rng.integers(-spread, spread, (1800, 16))
        centres = topk.far_apart(x[::3], 20)
        assert len(centres) == 20 and len(np.unique(centres, axis=0)) == 20
        apart = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(-1).astype(float))
        region, far = apart.argmin(1), apart.min(1) * (1 + 1e-9) + 1e-3
        radius = np.array([far[region == r].max() if (region == r).any() else -1.0 for r in range(20)])
        sent = 0
        for g in range(20):
            rows = np.flatnonzero(region == g)[::7]
            if not len(rows):
                continue
            scores = x[rows] @ x.T
            least = np.sort(scores[:, region == g], axis=1)[:, -min(10, int((region == g).sum()))]
            near = topk.reached(x[rows], least, g, far[rows], centres, radius)
            sent += near.sum()
            for r in range(20):
                if r != g and (region == r).any():
                    assert (near[:, r] | (scores[:, region == r].max(1) < least)).all()
        assert sent < cut * 20 * len(x[::7])
    assert len(topk.far_apart(np.ones((5, 3), np.int64), 4)) == 1


def test_regions_and_lengths(spark, monkeypatch):
    """Clusters in several blocks, a region that is cut, two lengths, one of which the sample may lack."""
    rng = np.random.default_rng(10)
    x = np.repeat(rng.integers(-4000, 4000, (12, 8)), 50, 0) + rng.integers(-20, 20, (600, 8))
    x[:200] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, [int(i), 1]) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(4)
    want = brute(range(0, 600, 20), x[::20], range(600), x)
    for block in (64, 30):
        monkeypatch.setattr(topk, "POINT_BLOCK", block)
        got = {}
        for r in topk.top_k(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert got.pop(1000) == [(1, 1001), (1, 1002)] and got == want
