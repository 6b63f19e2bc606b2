"""Hard negatives against brute force: ties, limits of either sign, wide numbers, odd rows, several blocks."""

import random

import numpy as np
import pytest

from quillmine.llm import hardneg

LOW, HIGH = -(1 << 63), (1 << 63) - 1


def brute(rows, asks, positives=5, negatives=10, low=30, high=90):
    def able(r):
        return r[0] is not None and r[1] is not None and r[2]

    rows, out = {(i, y, tuple(v)) for i, y, v in filter(able, rows)}, []
    for a, own, v in {(i, y, tuple(v)) for i, y, v in filter(able, asks)}:
        scored = [(min(max(sum(x * y for x, y in zip(v, w, strict=True)), LOW), HIGH), i, y) for i, y, w in rows if i != a and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for score, p, _ in [s for s in scored if s[2] == own][:positives]:
            found = [s for s in scored if s[2] != own and low * score <= 100 * s[0] <= high * score][:negatives]
            out += [(a, p, n, i, score, s) for n, (s, i, _) in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, asks, **more):
    schema = "vec_id long, label int, v array<long>, id string, key int, block int, positives int"
    points, asked = (spark.createDataFrame([(*r, "x", 1, 2, 3) for r in side], schema) for side in (rows, asks))
    found = hardneg.mine(points.repartition(3), asked, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("block", [1 << 21, 60])
def test_small_numbers_with_ties(spark, monkeypatch, block):
    monkeypatch.setattr(hardneg, "BLOCK_VALUES", block)
    rng = random.Random(block)
    rows = [(i, rng.randrange(3), [rng.randrange(-3, 4) for _ in range(3)]) for i in range(150)]
    rows += [(7, 1, [3, 3, 3]), (7, 1, [3, 3, 3]), (7, 2, [1, 1, 1]), (None, 1, [1, 1, 1]), (200, None, [1, 1, 1]), (201, 1, None), (202, 1, []), (203, 1, [5]), (204, 2, [4]), (205, 1, [1])]
    asks = [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] in (7, 203))] + [(None, 1, [1, 1, 1]), (999, 2, [2, 0, 1])]
    assert mined(spark, rows, asks) == brute(rows, asks)
    assert mined(spark, rows, asks, positives=2, negatives=1, low=0, high=100) == brute(rows, asks, 2, 1, 0, 100)


def test_wide_numbers(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [rng.choice([-1, 1]) * rng.randrange(1 << bits) for _ in range(2)]) for i, bits in enumerate([20, 31, 40, 62] * 10)]
    assert mined(spark, rows, rows[:12]) == brute(rows, rows[:12])


def test_equal_vectors_and_empty_tables(spark):
    rows = [(i, i % 4, [2, 1]) for i in range(300)]
    assert mined(spark, rows, rows[:3], low=30, high=100) == brute(rows, rows[:3], low=30, high=100)
    assert mined(spark, rows, []) == [] == mined(spark, [], rows[:2])
    assert mined(spark, rows[:1], rows[:1]) == []


def test_limits_and_reading():
    for p in (-7, -1, 0, 1, 7, 1 << 62):
        least, most = hardneg.limits(p, 30, 90)
        assert [30 * p <= 100 * s <= 90 * p for s in (least - 1, least, most, most + 1)] == ([False, least <= most, least <= most, False])
    score, ids, labels = np.array([5, 9, 9, LOW, HIGH, 9]), np.array([4, 3, 2, 1, 0, 9]), np.array([0, 1, 1, 1, 1, 0])
    by_score = hardneg.Sorted(score, ids, labels)
    assert list(by_score.negatives(2, 0, LOW, HIGH, 9)) == [(0, HIGH), (3, 9), (1, LOW)]
    assert list(by_score.negatives(2, 0, 6, 9, 9)) == [(3, 9)] and list(by_score.negatives(2, 0, 10, 9, 9)) == []
