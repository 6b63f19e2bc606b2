"""Resolution by batches gives what one run gives, also when a batch is given again."""

import random

import pytest

from quillmine.operators import growing, resolve


def records(seed, n):
    rng = random.Random(seed)
    pick = lambda prefix, most: "" if rng.random() < 0.4 else f"{prefix}{rng.randrange(most)}"
    return [(i, pick("10.1/", n // 2), pick("", n // 2), pick("title ", n // 2), rng.choice(["a", "b", ""]), rng.random() < 0.2) for i in range(n)]


def entity(rows):
    return sorted(repr(r.asDict()) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_give_what_one_run_gives(spark, tmp_path, seed):
    rows = records(seed, 90)
    schema = "n long, doi string, pmid string, title string, discovery_route string, is_review boolean"
    store = growing.GrowingStore(spark, str(tmp_path))
    for i, (lo, hi) in enumerate([(0, 40), (40, 41), (41, 90)]):
        batch = spark.createDataFrame(rows[lo:hi], schema)
        store.add(batch, f"batch {i}")
    want = entity(resolve.resolve_greedy(spark.createDataFrame(rows, schema)).collect())
    assert entity(store.entities().collect()) == want
    store.add(batch, "batch 2")
    assert entity(store.entities().collect()) == want


def test_a_bridge_unites_and_little_is_written(spark, tmp_path):
    schema = "n long, doi string, pmid string, title string"
    store = growing.GrowingStore(spark, str(tmp_path))
    store.add(spark.createDataFrame([(i, f"d{i}", f"{i}", f"t {i}") for i in range(500)], schema), "a")
    store.add(spark.createDataFrame([(500, "d3", "", ""), (501, "", "7", "t 3"), (502, "", "", "")], schema), "b")
    rows = {r.n: r.root for r in store.records.read().collect()}
    assert rows[3] == rows[500] == rows[501] == 3 == rows[7] and rows[502] == 502 and len(rows) == 503
    deltas = store.stored._last()[1]["deltas"]
    assert spark.read.parquet(f"{tmp_path}/entities/data/{deltas[-1]}").count() < 8
