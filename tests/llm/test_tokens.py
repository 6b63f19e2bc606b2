"""Token counts where hashes collide, and where the table of pre-tokens is full."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from quillmine.llm import textbytes, tokens


@pytest.fixture(scope="module")
def counts():
    return tokens.Counts(public_tokenizers.path("byte_bpe_50k.json"))


def library(counts, texts):
    return [len(counts.tokenizer.encode(t, add_special_tokens=False)) for t in texts]


def thue_morse(n, a, b):
    """Words of n letters whose polynomial hashes modulo 2**64 agree with those of their complements."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


@pytest.mark.parametrize("letters", ["ab", "et", "at"])
@pytest.mark.parametrize("n", [1024, 2048, 4096, 8192])
def test_equal_hashes_of_unlike_words(counts, letters, n):
    texts = list(thue_morse(n, *letters))
    want = library(counts, texts)
    assert tokens.token_counts(pa.array(texts), counts).tolist() == want  # in one batch
    assert [tokens.token_counts(pa.array([t]), counts)[0] for t in reversed(texts)] == want[::-1]  # across batches
    assert tokens.token_counts(pa.array([" ".join(texts * 3)]), counts).tolist() == library(counts, [" ".join(texts * 3)])


def test_same_spans():
    data = np.frombuffer(b"abcabdabc" * 3, np.uint8)
    starts = np.arange(0, len(data), 3)
    other = np.zeros(len(starts), np.int64)
    assert textbytes.same_spans(data, starts, starts + 3, other).tolist() == [True, False, True] * 3
    assert textbytes.same_spans(data, starts[:0], starts[:0], other[:0]).tolist() == []
    assert textbytes.same_spans(data, starts[:2], np.array([3, 5]), other[:2]).tolist() == [True, False]


def test_a_full_table_keeps_what_is_used(counts, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN", 64)
    fresh = tokens.Counts(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"word{i} again and again 日本{i}" for i in range(200)]
    assert [tokens.token_counts(pa.array([t]), fresh)[0] for t in texts] == library(fresh, texts)
    assert len(fresh.young) <= 32 and len(fresh.old) <= 32
    seen = fresh.encoded
    tokens.token_counts(pa.array(["x again and"]), fresh)
    assert fresh.encoded <= seen + 1


def test_same_spans_of_any_length():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 600, dtype=np.uint8)
    starts = np.sort(rng.integers(0, 570, 400))
    ends = starts + rng.integers(0, 30, 400)
    other = rng.integers(0, 400, 400)
    for i in range(0, 400, 3):
        other[i] = i
    raw = data.tobytes()
    want = [raw[a:b] == raw[starts[j] : ends[j]] for a, b, j in zip(starts, ends, other)]
    assert textbytes.same_spans(data, starts, ends, other).tolist() == want
