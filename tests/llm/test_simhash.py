"""The bit-sliced comparison against distances counted one by one, at several radii and with buckets."""

import numpy as np
import pytest

from quillmine.llm import simhash


def brute_groups(words, radius, of):
    group = list(range(len(words)))
    for _ in words:
        for i in range(len(words)):
            for j in range(i):
                if of[i] == of[j] and (int(words[i]) ^ int(words[j])).bit_count() <= radius:
                    group[i] = group[j] = min(group[i], group[j])
    return group


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 7, 8, 22, 31, 64])
def test_near_groups(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 64, 4, dtype=np.uint64)
    words = []
    for i in range(70):
        x = int(base[i % 4])
        for b in rng.integers(0, 64, int(rng.integers(0, radius + 4))):
            x ^= 1 << int(b)
        words.append(x)
    words = np.array(words + words[:3], np.uint64)
    of = rng.integers(0, 3, len(words))
    assert simhash.near_groups(words, radius, of).tolist() == brute_groups(words, radius, of)
    assert simhash.near_groups(words, radius).tolist() == brute_groups(words, radius, [0] * len(words))


def test_blocks_are_abandoned(monkeypatch):
    """Unlike fingerprints: no query is left after the first looks, so most planes are never read."""
    looks = []
    whole = simhash._exceeded
    monkeypatch.setattr(simhash, "_exceeded", lambda counts, over, radius: looks.append(len(over)) or whole(counts, over, radius))
    words = np.random.default_rng(0).integers(0, 1 << 64, 400, dtype=np.uint64)
    assert (simhash.near_groups(words) == np.arange(400)).all()
    assert looks[0] == 399 and len(looks) < 64 // simhash._CHECK and looks[-1] < 40
