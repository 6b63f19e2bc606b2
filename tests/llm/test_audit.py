"""The audit of filter interactions: the walk against direct counting, cells against brute force, odd rows."""

import itertools
import math
import random
import re

import numpy as np
import pytest

from quillmine.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mask_of(text):
    words = WORD.findall(text)
    return (len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words)) + 4 * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text))


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_orders_differ_by_one_swap(n):
    found = list(audit.orders(n))
    assert sorted(o for o, _ in found) == sorted(itertools.permutations(range(n)))
    for (a, _), (b, swap) in itertools.pairwise(found):
        c = list(a)
        c[swap], c[swap + 1] = c[swap + 1], c[swap]
        assert tuple(c) == b


def test_walk():
    cells = np.random.default_rng(3).integers(0, 9, (4, 16, 3))
    *steps, (_, shapley) = audit.walk(cells)
    assert len(steps) == math.factorial(4)
    total = np.zeros_like(shapley)
    for order, now in steps:
        for part in range(4):
            alive = set(range(16))
            for step, f in enumerate(order):
                gone = {m for m in alive if m >> f & 1}
                failing = {m for m in range(16) if m >> f & 1}
                alive -= gone
                n, good, toxic = ([int(cells[part, m, j]) for m in range(16)] for j in range(3))
                want = [sum(n[m] for m in alive), sum(n[m] for m in gone), sum(n[m] for m in failing - gone), n[1 << f], sum(good[m] for m in gone), sum(toxic[m] for m in gone)]
                assert now[part, step].tolist() == want
                total[part, f] += want[1]
    assert (total == shapley).all()


def brute(rows, labels):
    """(part, order, step) -> counts, by applying the filters one after another."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = [(i, s or "", mask_of(t or "") + 16 * (i is not None and i > least[t or ""])) for i, t, s in rows]
    out = {}
    for part in {s for _, s, _ in docs}:
        own = [(i, m) for i, s, m in docs if s == part]
        removed = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            alive = own
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [(i, m) for i, m in alive if m & bit]
                alive = [(i, m) for i, m in alive if not m & bit]
                removed[f] += len(gone)
                fails = sum(1 for _, m in own if m & bit)
                out[part, "".join(order), step] = [len(alive), len(gone), fails - len(gone), sum(1 for _, m in own if m == bit), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(removed[order[step - 1]])
    return out


def documents():
    rng = random.Random(1)
    long = " ".join(f"word{i}" for i in range(60))
    texts = [long, long + " #", long.upper(), "a " * 70, "A " * 70 + "|", "short", "", None, " \t\x0b", "é" * 10 + " $", "x y " * 60, "x" * 3000, "Ω" * 40 + "AB", "word " * 200_000]
    rows = [(i, rng.choice(texts), rng.choice(["s0", "s0", "s0", "s1", None, ""])) for i in range(150)]
    return rows + [(None, long, "s0"), (None, None, None), (3, long, "s1"), (3, long, "s1"), (0, "short", "s9")]


def test_audit(spark, monkeypatch):
    rows = documents()
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 150, 2)] + [(None, 1, 1), (3, 1, None), (3, 0, 1), (5, None, None)]
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, source string, mask int, part string").repartition(5)
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, text string")
    monkeypatch.setattr(audit, "_SLICE", 1000)
    got = {(r.part, r.filter_order, r.step): [r[c] for c in audit.COUNTS] for r in audit.audit(docs, marks).collect()}
    assert got == brute(rows, labels)
    assert all(r.filter == r.filter_order[r.step - 1] for r in audit.audit(docs, marks).limit(50).collect())


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    assert {(r.part, r.kept + r.removed) for r in audit.audit(one, labels).collect()} == {("", 0), ("", 1)}
