"""Removal of repeated byte strings against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmine.llm import repeats
from quillmine.llm.queries import op12_repeats

SF = "/root/testdata/sf0.001"
LENGTH, GRAM = 32, 12


def brute(texts, length):
    """(removed runs, kept bytes) of each text."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        edge = np.flatnonzero(np.diff(np.r_[0, np.frombuffer(bytes(gone), np.int8), 0])).tolist()
        out.append((list(zip(edge[::2], edge[1::2], strict=True)), bytes(b for b, g in zip(r, gone, strict=True) if not g)))
    return out


def documents():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Ω", "naïve", "x" * 9, "one", "two"]
    prose = [" ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(rng.randrange(80))) for _ in range(30)]
    shared = [prose[0][:n] for n in (31, 32, 33, 60)]
    texts = [*prose, *(rng.choice(prose)[:40] + s + rng.choice(prose)[-50:] for s in shared for _ in range(3))]
    texts += [prose[1], prose[1], "a" * 300, "ab" * 100, "xyz" * 40 + prose[2], prose[3] + prose[3], "", None, " ", prose[0][:32], "é" * 16, "é" * 17, "a" * 31]
    return texts


@pytest.mark.parametrize("split,symbols", [(4096, 1 << 19), (2, 40), (0, 200)])
def test_removed_and_kept(spark, split, symbols):
    texts = documents()
    rows = [(i if i % 7 else None, t, "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(3)
    got = repeats.remove_repeats(docs, length=LENGTH, gram=GRAM, split=split, symbols=symbols).collect()
    want = sorted(repr((r[0], runs, kept)) for r, (runs, kept) in zip(rows, brute(texts, LENGTH), strict=True))
    assert sorted(repr((r.doc_id, [(s.start, s.end) for s in r.removed], bytes(r.kept))) for r in got) == want


def test_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"w{i * i}" for i in range(300))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text[:500] + "#" + text[900:1290]), (3, text[:399])], "doc_id long, text string")
    got = {(r.doc_id, len(r.kept), len(r.removed)) for r in repeats.remove_repeats(docs).collect()}
    assert got == {(1, 0, 1), (2, 391, 1), (3, 399, 0)}
    assert repeats.remove_repeats(docs.limit(0)).count() == 0
    assert repeats.remove_repeats(docs.where("doc_id = 3")).first().n_bytes == 399
    with pytest.raises(ValueError, match="multiple of 8"):
        repeats.remove_repeats(docs, length=401)


def test_long_texts_are_cut_into_segments(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 128)
    texts = [*documents(), "".join(t or "" for t in documents())]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = [(i, t) for i, t in enumerate(texts) if t and len(t.encode()) >= LENGTH]
    import pyarrow as pa

    batch = pa.record_batch([pa.array([i for i, _ in keyed]), pa.array([0] * len(keyed)), pa.array([t for _, t in keyed])], ["k1", "k2", "_text"])
    starts = {}
    for found in repeats._dealt(LENGTH, GRAM, True)(iter([batch])):
        for k, at in zip(found["k1"].to_pylist(), found["at"].to_pylist(), strict=True):
            first, n, _ = repeats._unpacked(at)
            starts.setdefault(k, []).extend(range(first, first + n))
    assert {k: sorted(v) for k, v in starts.items()} == {k: list(range(len(t.encode()) - LENGTH + 1)) for k, t in keyed}
    got = {r.doc_id: bytes(r.kept) for r in repeats.remove_repeats(docs, length=LENGTH, gram=GRAM).collect()}
    assert got == {i: kept for i, (_, kept) in enumerate(brute(texts, LENGTH))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=40), min_size=1, max_size=6), st.integers(2, 12))
def test_common_prefixes(parts, depth):
    text = np.array([v for j, p in enumerate(parts) for v in [*(x + len(parts) for x in p), j]], np.int64)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    first = np.zeros(len(text), bool)
    first[np.r_[0, ends[:-1] + 1]] = True
    order = repeats.suffix_order(text, depth + 1)
    tails = [text[i:].tolist() for i in order.tolist()]
    assert [t[: depth + 1] for t in tails] == sorted(t[: depth + 1] for t in tails)
    got = repeats.common_prefixes(text, order, first, depth)
    for i in range(1, len(tails)):
        n = next(k for k, (a, b) in enumerate(zip(tails[i - 1], tails[i], strict=False)) if a != b)
        assert got[i] == (n if n < depth else -1)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {r.doc_id: (len(r.text.encode()), runs, kept) for r, (runs, kept) in zip(docs, brute([r.text for r in docs], 400), strict=True)}
    got = op12_repeats(spark, SF).collect()
    assert len(got) == len(docs) and any(r.n_removed for r in got)
    for r in got:
        size, runs, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (size, size - len(kept), len(runs), hashlib.sha256(kept).hexdigest())


def test_texts_are_shuffled_once(spark):
    found = op12_repeats(spark, SF)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
