"""The skip-chain field: exact on trees, near on loops, and what the links add."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmine.llm import pii

K = len(pii.KINDS) + 1


def enumerated(graph, w, observed=None):
    """Marginals by summing over all labellings."""
    node = w["node"][np.array(graph.features)].sum(1)
    if observed is not None:
        for i, o in enumerate(observed):
            if o:
                node[i, np.arange(K) != o] = -np.inf
    total = np.zeros((len(graph.at), K))
    labels = np.array(list(product(range(K), repeat=len(graph.at))))
    score = node[np.arange(len(graph.at)), labels].sum(1)
    for a, b in graph.chain:
        score = score + w["pair"][labels[:, a], labels[:, b]]
    for a, b in graph.skip:
        score = score + w["skip"][0] * (labels[:, a] == labels[:, b])
    p = np.exp(score - score.max())
    for j in range(K):
        total[:, j] = ((labels == j) * p[:, None]).sum(0)
    return total / p.sum()


def weights(seed, scale=1.0):
    rng = np.random.default_rng(seed)
    w = {"node": rng.normal(0, 0.4, (pii.BUCKETS + 1, K)), "pair": rng.normal(0, scale, (K, K)), "skip": np.array([1.5])}
    w["node"][pii.BUCKETS] = 0
    return w


@pytest.mark.parametrize("text", ["1", "a 12 34 b 56", "id 555123 and 555123 then 555123 again", "7 x 8 x 7 y 8", "1 2 3 4 5 6", "12 34 text 34"])
def test_marginals_equal_enumeration_on_trees(text):
    graph = pii.Graph([text])
    for seed in range(3):
        assert np.allclose(pii.marginals(graph, weights(seed)), enumerated(graph, weights(seed)), atol=1e-3)
    seen = np.zeros(len(graph.at), int)
    seen[-1] = 3
    assert np.allclose(pii.marginals(graph, weights(9), seen), enumerated(graph, weights(9), seen), atol=1e-3)


def test_marginals_are_near_enumeration_on_loops():
    graph = pii.Graph(["12 34 x 12 34 y 34 12"])
    assert len(graph.chain) + len(graph.skip) > len(graph.at) - 1
    for seed in range(5):
        assert np.abs(pii.marginals(graph, weights(seed, 0.3)) - enumerated(graph, weights(seed, 0.3))).max() < 0.1


@pytest.fixture(scope="module")
def fitted():
    """Phones that the pattern finds follow ``call`` and come again after words that other numbers follow too."""
    rng = np.random.default_rng(0)
    others = ["page", "room", "chapter", "about", "written", "in", "year"]
    texts = []
    for i in range(400):
        number = f"+{rng.integers(1, 90)}-{rng.integers(200, 999)}-555-{rng.integers(1000, 9999)}"
        texts.append(f"please call {number} today and {others[i % 7]} {rng.integers(1, 2000)} on and on {others[i % 5]} {number} or {others[i % 5]} {rng.integers(10**6, 10**8)} or {others[i % 4]} {rng.integers(10**6, 10**8)}")
    return pii.fit(texts)


def test_a_mention_in_context_pulls_a_distant_one(fitted):
    number = "(803)555.5351"  # no pattern fits: no plus sign
    far = "words that went by " * 50
    text = f"please call {number} today. {far} written {number} below"
    base = [pii.base_spans(text)]
    assert base == [[]]
    first, last = text.index(number), text.rindex(number)
    got = pii.added_spans([text], base, fitted)[0]
    assert {s for s, _, _ in got} == {first, last} and {k for _, _, k in got} == {3}
    assert [s for s, _, _ in pii.added_spans([text], base, fitted, skips=False)[0]] == [first]  # without its link the distant one is missed
    alone = f"{far} written {number} below"
    assert pii.added_spans([alone], [[]], fitted) == [[]]


def test_a_pattern_s_mention_pulls_a_distant_one(fitted):
    text = "see +1(803)555.5351 here. " + "and more words went by " * 30 + "written 1(803)555.5351 below"
    base = [pii.base_spans(text)]
    assert len(base[0]) == 1
    got = pii.added_spans([text], base, fitted)[0]
    assert [text[s:e] for s, e, _ in got] == ["1(803)555.5351"]
    assert pii.added_spans([text], base, fitted, skips=False) == [[]]


def test_many_mentions_lie_between(fitted):
    text = "see +1(803)555.53519 here. " + "plain text of number 1(803)555.53519 below. " * 60
    base = [pii.base_spans(text)]
    assert len(base[0]) == 1
    assert len(pii.added_spans([text], base, fitted)[0]) == 60


def test_numbers_that_fail_a_check_are_left_alone(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(F.col("text").rlike("[0-9@]")).collect()]
    w = pii.fit(texts[::2])
    base = [pii.base_spans(t) for t in texts]
    for t, more in zip(texts, pii.added_spans(texts, base, w)):
        for s, e, k in more:
            digits = "".join(c for c in t[s:e] if c.isdigit())
            assert not (k == 2 and 14 <= len(digits) <= 19 and not pii.luhn(digits)), t[s:e]
