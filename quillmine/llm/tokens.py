"""Token counts without token ids: pieces are counted once for each distinct pre-token, then joined to documents' frequencies.

A byte-level BPE splits a text into pre-tokens and encodes each by itself, so a text's count is the sum, over its
distinct pre-tokens, of frequency times pieces. Pre-tokens are found on the UTF-8 bytes, many texts at a time, and grouped by a
64-bit hash whose groups are then compared byte by byte: a span that only shares its group's hash is looked up by itself. The
task's table of distinct pre-tokens (bytes to pieces) is joined to these frequencies by the bytes, so no hash decides a count.

The table has two generations of at most KNOWN / 2 pre-tokens each. When the younger is full it becomes the older one and the older one is
forgotten, so memory is bounded and a pre-token is encoded again only if the task met KNOWN / 2 others since it was last seen.
Frequencies of all documents and distinct pre-tokens would be a shuffle larger than the texts; a join in each task needs none.

Texts with characters outside U+0000-U+024F, with the tokenizer's special strings, or with rare blanks are counted in the same
way, but from the tokenizer's own pre-tokens.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb

LIMIT = 1024
#: Rows of a task's table of distinct pre-tokens, in two generations.
KNOWN = 1 << 20

_LETTER, _NUMBER, _OTHER, _BLANK, _SPACE = 1, 2, 3, 4, 5
#: What follows an apostrophe in a contraction that is a pre-token of its own.
_SHORT = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
_RARE = re.compile("[\x1c-\x1f\x85\xa0ɐ-\U0010ffff]")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Classes of ASCII bytes, and of the characters U+0080-U+024F."""
    import unicodedata

    def kind(c: str) -> int:
        if c == " ":
            return _SPACE
        if c.isspace():
            return _BLANK
        major = unicodedata.category(c)[0]
        return _LETTER if major == "L" else _NUMBER if major == "N" else _OTHER

    every = np.array([kind(chr(i)) for i in range(0x250)], np.uint8)
    return every[:128], every


def classes(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to (two-byte characters at most)."""
    ascii_, every = _tables()
    table = np.zeros(256, np.uint8)
    table[:128] = ascii_
    out = table[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        of = every[((data[lead].astype(np.int64) & 0x1F) << 6) | (data[lead + 1] & 0x3F)]
        out[lead], out[lead + 1] = of, of
    return out


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the pre-tokens of texts without characters above U+024F."""
    n = len(data)
    kind = classes(data)
    # a run of blanks gives its last blank away if text follows: a space to the next pre-token, another one to itself
    blank = kind >= _BLANK
    begin = np.zeros(n + 1, bool)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    same = np.zeros(n, bool)
    same[1:] = (kind[1:] == kind[:-1]) | (blank[1:] & blank[:-1])
    begin[:n] = ~same | border[:n]
    next_text = np.zeros(n, bool)
    next_text[:-1] = ~blank[1:] & ~border[1:n]
    last = blank & next_text
    begin[:n] |= last
    joined = np.flatnonzero(last & (kind == _SPACE)) + 1
    begin[joined] = False
    # contractions stand at the beginning of a pre-token
    quote = np.flatnonzero((data == 39) & begin[:n])
    if len(quote):
        row_end = offsets[np.searchsorted(offsets, quote, side="right")]
        for short in _SHORT:
            fits = quote[quote + len(short) < row_end]
            for j, c in enumerate(short, 1):
                fits = fits[data[fits + j] == c]
            after = fits + 1 + len(short)
            begin[fits + 1] = False
            begin[after] = True
    starts = np.flatnonzero(begin[:n])
    ends = np.r_[starts[1:], n] if len(starts) else starts
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


class Counts:
    """Pieces of distinct pre-tokens, by their UTF-8 bytes, for one task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}
        #: Pre-tokens that went to the tokenizer.
        self.encoded = 0

    def of(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each of some distinct pre-tokens."""
        out = [self.young.get(w, 0) for w in words]
        missing = [i for i, n in enumerate(out) if not n]
        new = []
        for i in missing:
            if n := self.old.get(words[i], 0):
                out[i] = n
            else:
                new.append(i)
        self.encoded += len(new)
        for i in new:
            out[i] = len(self.tokenizer.encode(words[i].decode("utf-8"), add_special_tokens=False))
        for i in missing:
            if 2 * len(self.young) >= KNOWN:
                self.old, self.young = self.young, {}
            self.young[words[i]] = out[i]
        return np.array(out, np.int64)

    def slow(self, text: str) -> int:
        """One text's count from the tokenizer's own pre-tokens; special strings count as the tokenizer takes them."""
        parts = re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) if self.special else [text]
        total = 0
        for i, part in enumerate(parts):
            if i % 2:
                total += 1
                continue
            freq = Counter(part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)) if part else {}
            total += int(np.dot(self.of([w.encode("utf-8") for w in freq]), list(freq.values()))) if freq else 0
        return total


def token_counts(column: pa.Array, counts: Counts) -> np.ndarray:
    out = np.zeros(len(column), np.int64)
    for lo, hi, data, offsets in tb.chunks(column):
        texts = [t.as_py() or "" for t in column[lo:hi]]
        odd = np.fromiter((bool(_RARE.search(t)) or any(s in t for s in counts.special) for t in texts), bool, hi - lo)
        for i in np.flatnonzero(odd).tolist():
            out[lo + i] = counts.slow(texts[i])
        if odd.any():
            keep = np.repeat(~odd, np.diff(offsets))
            data, offsets = data[keep], np.r_[0, np.cumsum(np.where(odd, 0, np.diff(offsets)))]
        starts, ends, rows = pretokens(data, offsets)
        if not len(starts):
            continue
        _, first, where = np.unique(tb.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        pieces = counts.of([data[a:b].tobytes() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])[where]
        for i in np.flatnonzero(~tb.same_spans(data, starts, ends, first[where])).tolist():  # equal hashes of unlike bytes
            pieces[i] = counts.of([data[starts[i] : ends[i]].tobytes()])[0]
        # frequency times pieces, summed by document
        out[lo:hi] += np.bincount(rows, pieces, hi - lo).astype(np.int64)
    return out


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """All of ``docs``' columns with ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit) for the byte-level BPE at ``path``.

    The file is read on the driver's path in each task and must be there on every executor. A null text counts as empty: 0 bytes,
    0 tokens. Rows are handled one by one, over whole texts. Columns of ``docs`` with the new names are replaced.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            counts = counts or Counts(path)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(token_counts(batch.column(place), counts))], [*batch.schema.names, "n_tokens"])

    out = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType())]))
    return out.select("*", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), (F.col("n_tokens") > limit).alias("over_limit"))
