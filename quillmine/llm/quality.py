"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

Each word occurrence is a feature of weight 1 / (number of words); each of the STATS (shares of character classes, word and
line lengths, repeated lines, the text's length) is a feature for the bin that it falls in, of weight 1. With x the
weights and v the rank-RANK vectors, the pairwise part is (|sum x v|^2 - sum x^2 |v|^2) / 2, in one pass over the
features. Fitted by Adam on the logistic loss, on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .sampling import counted, labelled

WORD_BUCKETS, RANK, BINS = 1 << 16, 8, 16
#: Bound on the labelled rows of each class that the model is fitted on.
SAMPLE_PER_CLASS = 2500
THRESHOLD = 0.3
#: Distinct words of a document that training keeps; of one with more as many, in proportion to their counts. Scores read them all.
KEPT = 2048

_CLASSES = {
    "upper": tb.byte_table(bytes(range(65, 91))),
    "lower": tb.byte_table(bytes(range(97, 123))),
    "digit": tb.byte_table(bytes(range(48, 58))),
    "stop": tb.byte_table(b".,;:"),
    "shout": tb.byte_table(b"!?"),
    "mark": tb.byte_table(b"#$%&*+/<=>@\\^_`{|}~[]()\"'-"),
    "line": tb.byte_table(b"\n"),
    "blank": tb.byte_table(b" \t\r\x0b\x0c"),
    "wide": tb.byte_table(bytes(range(128, 256))),
}
STATS = [*_CLASSES, "word_length", "line_length", "repeated_lines", "long_words", "log_words", "log_chars"]


def features(column: pa.Array, chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, STATS of each row, rows of the words, buckets of the words), by chunks.

    ``chars``: metadata, the length that the table states for each row (NaN: not stated; then the number of bytes counts).
    """
    for lo, hi, data, offsets in tb.chunks(column):
        n, size = hi - lo, np.diff(offsets)
        shares = np.empty((n, len(_CLASSES)))
        for j, table in enumerate(_CLASSES.values()):
            at = np.r_[0, np.cumsum(table[data], dtype=np.int64)]
            shares[:, j] = at[offsets[1:]] - at[offsets[:-1]]
        starts, ends, rows = tb.spans(tb.NOT_BLANK[data], offsets)
        words = np.bincount(rows, minlength=n)
        long = np.bincount(rows[ends - starts > 20], minlength=n)
        letters = tb.row_sums((ends - starts).astype(float), rows, n)
        a, b, line_rows = tb.spans(1 - _CLASSES["line"][data], offsets)
        lines = np.bincount(line_rows, minlength=n)
        keys = np.unique(np.stack([line_rows.astype(np.uint64), tb.span_hashes(data, a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.uint64)
        distinct = np.bincount(keys[0].astype(np.int64), minlength=n)
        stats = np.c_[
            shares / np.maximum(size, 1)[:, None], letters / np.maximum(words, 1), np.log1p(size / np.maximum(lines, 1)), 1 - distinct / np.maximum(lines, 1),
            long / np.maximum(words, 1), np.log1p(words), np.log1p(np.where(np.isnan(chars[lo:hi]), size, chars[lo:hi])),
        ]
        hashed = tb.span_hashes(tb.LOWER[data], starts, ends)
        yield lo, hi, stats, rows, (hashed >> np.uint64(48)).astype(np.int64) % WORD_BUCKETS


def _bins(stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The feature numbers, after the word buckets, of the bins that ``stats`` fall in."""
    found = np.stack([np.searchsorted(edges[j], stats[:, j], side="right") for j in range(stats.shape[1])], axis=1)
    return WORD_BUCKETS + np.arange(stats.shape[1]) * (BINS + 1) + found


def fit(y: np.ndarray, stats: np.ndarray, words: list[tuple[np.ndarray, np.ndarray]], epochs: int = 12, seed: int = 0) -> dict[str, np.ndarray]:
    """``words``: the buckets of each document's words and their counts."""
    size = WORD_BUCKETS + len(STATS) * (BINS + 1)
    edges = np.zeros((len(STATS), BINS))
    p = {"w": np.zeros(size), "v": np.zeros((size, RANK)), "b": np.zeros(1)}
    if len(y) and y.min() < y.max():
        edges = np.quantile(stats, np.arange(1, BINS + 1) / (BINS + 1), axis=0).T
        rng = np.random.default_rng(seed)
        p["v"] = rng.normal(0, 0.05, (size, RANK))
        p["b"][0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        fixed = _bins(stats, edges)
        first = {n: np.zeros_like(x) for n, x in p.items()}
        second = {n: np.zeros_like(x) for n, x in p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for lo in range(0, len(y), 256):
                pick = order[lo : lo + 256]
                own = [words[i] for i in pick]
                n = np.array([len(ids) for ids, _ in own])
                ids = np.concatenate([*(ids for ids, _ in own), fixed[pick].ravel()])
                row = np.concatenate([np.repeat(np.arange(len(pick)), n), np.repeat(np.arange(len(pick)), len(STATS))])
                x = np.concatenate([*(counts / max(1, counts.sum()) for _, counts in own), np.ones(len(pick) * len(STATS))])
                vx = p["v"][ids] * x[:, None]
                total = np.stack([np.bincount(row, vx[:, j], len(pick)) for j in range(RANK)], axis=1)
                # an occurrence is a feature of its own, so a word that occurs twice meets itself once
                square = np.concatenate([*((counts / max(1, counts.sum()) ** 2) for _, counts in own), np.ones(len(pick) * len(STATS))])
                vv = p["v"][ids] * square[:, None]
                z = p["b"] + np.bincount(row, p["w"][ids] * x, len(pick)) + 0.5 * ((total**2).sum(1) - np.bincount(row, (p["v"][ids] * vv).sum(1), len(pick)))
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
                back = g[row][:, None] * (x[:, None] * total[row] - vv)
                pulls = np.stack([np.bincount(ids, back[:, j], size) for j in range(RANK)], axis=1)
                grads = {"b": np.array([g.sum()]), "w": np.bincount(ids, g[row] * x, size) + 1e-5 * p["w"], "v": pulls + 1e-5 * p["v"]}
                step += 1
                for k, grad in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad**2
                    p[k] = p[k] - 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-6)
    return {"edges": edges, "w": p["w"].astype(np.float32), "v": p["v"].astype(np.float32), "b": p["b"]}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", per_class: int = SAMPLE_PER_CLASS) -> dict[str, np.ndarray]:
    """Fit on ``per_class`` documents of each class at most, none of them held out, of any length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats, words = [], []
            for lo, hi, part, rows, hashed in features(batch.column(1), _lengths(batch.column(2))):
                stats += list(part)
                at = np.searchsorted(rows, np.arange(hi - lo + 1))
                words += [counted(hashed[a:b], KEPT) for a, b in zip(at[:-1], at[1:], strict=True)]
            ids, counts = (pa.array([w[j].astype(np.int32) for w in words], pa.list_(pa.int32())) for j in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stats, pa.list_(pa.float64())), ids, counts], ["y", "stats", "ids", "counts"])

    base = docs.select(F.col(id_col), F.col(text_col), _chars(docs, chars_col))
    rows = labelled(base, labels.withColumnRenamed("doc_id", id_col), "quality", per_class, id_col, text_col)
    got = rows.select(F.col("_y").alias("y"), F.col(text_col), "_chars").mapInArrow(run, "y int, stats array<double>, ids array<int>, counts array<int>").toArrow()
    y = np.array(got["y"].to_pylist(), np.float64)
    stats = np.array(got["stats"].to_pylist(), np.float64).reshape(-1, len(STATS))
    words = [(ids.values.to_numpy(), counts.values.to_numpy()) for ids, counts in zip(got["ids"], got["counts"], strict=True)]
    order = np.lexsort([*stats.T, y]) if len(y) else []
    return fit(y[order] if len(y) else y, stats[order] if len(y) else stats, [words[i] for i in order])


def _chars(docs: DataFrame, chars_col: str):
    return (F.col(chars_col).cast("double") if chars_col in docs.columns else F.lit(None).cast("double")).alias("_chars")


def _lengths(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False), np.float64)


def score(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All of ``docs``' columns with ``score`` (the probability of label 1) and ``predicted`` (1 if score >= THRESHOLD).

    A null text counts as empty; an empty one is scored by its statistics. A missing or null length column counts
    as the number of bytes. Rows are handled one by one: repeated rows, null ids and empty tables are no special cases. Without labels of
    both classes every score is a half. Columns of ``docs`` with the new names are replaced.
    """
    docs = docs.drop("score", "predicted").withColumn("_chars", _chars(docs, chars_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        w, v = m["w"].astype(np.float64), m["v"]
        both = np.c_[w, v, (v.astype(np.float64) ** 2).sum(1)].astype(np.float32)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, hi, stats, rows, hashed in features(batch.column(place), _lengths(batch.column(batch.num_columns - 1))):
                n = np.maximum(np.bincount(rows, minlength=hi - lo), 1)[:, None]
                sums = np.zeros((hi - lo, RANK + 2))
                for part in range(0, len(rows), 1 << 18):
                    sums += tb.row_sums(both[hashed[part : part + (1 << 18)]], rows[part : part + (1 << 18)], hi - lo)
                bins = both[_bins(stats, m["edges"])].astype(np.float64).sum(1)
                total = sums[:, 1:-1] / n + bins[:, 1:-1]
                z = m["b"][0] + sums[:, 0] / n[:, 0] + bins[:, 0] + 0.5 * ((total**2).sum(1) - sums[:, -1] / n[:, 0] ** 2 - bins[:, -1])
                out[lo:hi] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out), pa.array((out >= THRESHOLD).astype(np.int32))], [*batch.schema.names[:-1], "score", "predicted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
