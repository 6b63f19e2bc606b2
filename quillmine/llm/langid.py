"""Language identification: averaged hashed subword embeddings with a linear softmax, and a calibrated rejection.

Subwords are the 2-, 3- and 4-grams of the UTF-8 bytes of a text whose A-Z are lower-cased and whose other ASCII
characters count as blanks. Each is hashed to one of BUCKETS embeddings; a text's mean embedding goes through a linear softmax. Both are
trained by stochastic gradient descent in numpy on the subword counts of a bounded sample of labelled documents, whole texts each. A temperature,
fitted on documents that training left out, makes the probabilities honest; a prediction whose
probability is below the smallest level that gave RELIABLE accuracy there is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .sampling import by_class, counted, held_out

BUCKETS, DIM, SIZES = 1 << 15, 16, (2, 3, 4)
#: Bounds on the texts of each language, and of all, that the model is fitted on; a quarter of them calibrates it. Every language has its share.
SAMPLE_PER_LANGUAGE, SAMPLE_ROWS = 1500, 12_000
RELIABLE = 0.99
#: Distinct subwords of a text that training keeps; of a text with more as many, in proportion to their counts. Predictions read all.
KEPT = 2048
_ASCII_LETTER = re.compile("[A-Za-z]")
#: ASCII letters in lower case, other ASCII as a blank, all else as it is.
_FOLDED = np.array([b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)


def buckets(folded: np.ndarray, size: int) -> np.ndarray:
    """The bucket of the ``size``-gram that begins at each byte but the last ones."""
    n = max(0, len(folded) - size + 1)
    h = np.full(n, size, np.uint32)
    for j in range(size):
        h = (h ^ folded[j : j + n]) * np.uint32(0x01000193)
    h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(17)


def mean_vectors(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """The mean row of ``table`` (BUCKETS rows) over the subwords of each text; zeros if there are none."""
    out = np.zeros((len(column), table.shape[1]))
    for lo, hi, data, offsets in tb.chunks(column, 1 << 19):
        folded = _FOLDED[data]
        lengths = np.diff(offsets)
        total, n = np.zeros((hi - lo, table.shape[1])), np.zeros(hi - lo)
        for size in SIZES:
            found = buckets(folded, size)
            at, have = np.minimum(offsets[:-1], len(found)), np.maximum(lengths - size + 1, 0)
            for part in range(0, len(found), 1 << 20):  # a very long text goes by parts
                rows = table[found[part : part + (1 << 20)]]
                a, b = np.clip(at - part, 0, len(rows)), np.clip(at + have - part, 0, len(rows))
                on = np.flatnonzero(b > a)
                if len(on):
                    edges = np.c_[a[on], b[on]].ravel()
                    padded = np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)])
                    total[on] += np.add.reduceat(padded, edges, axis=0)[::2]
            n += have
        out[lo:hi] = total / np.maximum(n, 1)[:, None]
    return out


def has_letter(text: str | None) -> bool:
    """Whether a text holds a character of Unicode category L."""
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text))))


def _softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def subwords(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The buckets of each text's subwords and how often they occur, at most KEPT of them."""
    out = []
    for t in texts:
        folded = _FOLDED[np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)]
        out.append(counted(np.concatenate([buckets(folded, size) for size in SIZES]), KEPT))
    return out


def _dense(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A row of subword shares for each text."""
    x = np.zeros((len(bags), BUCKETS), np.float32)
    for row, (ids, counts) in zip(x, bags, strict=True):
        row[ids] = counts / max(1, counts.sum())
    return x


def fit(texts: list[str], langs: list[str], steps: int = 700, seed: int = 0) -> dict:
    return fit_bags(subwords(texts), langs, steps, seed)


def fit_bags(bags: list[tuple[np.ndarray, np.ndarray]], langs: list[str], steps: int = 700, seed: int = 0) -> dict:
    """Train on three quarters of the texts, in the order given, and calibrate on the others."""
    names = sorted(set(langs))
    if not names:
        return {"names": [], "table": np.zeros((BUCKETS, 1), np.float32), "w": np.zeros((1, 1)), "b": np.zeros(1), "scale": 1.0, "reject": 1.0}
    rng = np.random.default_rng(seed)
    number = {n: i for i, n in enumerate(names)}
    y = np.array([number[x] for x in langs])
    train = np.arange(len(y)) % 4 != 3
    e, w, b = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32), np.zeros((DIM, len(names))), np.zeros(len(names))
    usable = [i for i in np.flatnonzero(train) if len(bags[i][0])]
    chance = 1 / np.bincount(y)[y[usable]] if usable else np.zeros(0)  # languages are drawn alike
    for step in range(steps if usable else 0):
        rate = 2.0 * (1 - step / steps)
        pick = rng.choice(usable, 32, p=chance / chance.sum())
        x = _dense([bags[i] for i in pick])
        h = x @ e
        g = _softmax(h @ w + b)
        g[np.arange(len(pick)), y[pick]] -= 1
        g /= len(pick)
        back = (g @ w.T).astype(np.float32)
        w -= rate * (h.T @ g)
        b -= 0.1 * rate * g.sum(0)
        e -= np.float32(rate * 20) * (x.T @ back)
    model = {"names": names, "table": e, "w": w, "b": b, "scale": 1.0, "reject": 0.0}
    rest = np.flatnonzero(~train)
    if len(rest):
        h = np.concatenate([_dense([bags[i] for i in rest[lo : lo + 256]]) @ e for lo in range(0, len(rest), 256)])
        z = h @ w + b
        loss = [(-np.log(_softmax(z * s)[np.arange(len(rest)), y[rest]] + 1e-12).mean(), s) for s in 2.0 ** np.arange(-3, 2.1, 0.25)]
        model["scale"] = float(min(loss)[1])
        p = _softmax(z * model["scale"])
        order = np.argsort(-p.max(1), kind="stable")
        right = np.cumsum((p.argmax(1) == y[rest])[order]) / (1 + np.arange(len(rest)))
        good = np.flatnonzero(right >= RELIABLE)
        model["reject"] = float(p.max(1)[order][good[-1]]) if len(good) else 1.0
    return model


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            found = subwords(part.column(2).to_pylist())
            ids, counts = (pa.array([f[j].astype(np.int32) for f in found], pa.list_(pa.int32())) for j in (0, 1))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids, counts], ["l", "h", "ids", "counts"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> dict:
    """Fit on ``per_language`` texts of each language at most, none of a held-out document, none without text or language, of any length."""
    able = docs.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where(F.col("t").isNotNull() & F.col("l").isNotNull() & ~held_out(F.col(id_col)))
    hashed = able.withColumn("h", F.xxhash64("t"))
    picked = F.broadcast(by_class(hashed.select("l", "h"), "l", ["h"], per_language, SAMPLE_ROWS))  # SAMPLE_ROWS rows at most
    texts = hashed.join(picked, ["l", "h"]).groupBy("l", "h").agg(F.min("t").alias("t"))
    got = texts.mapInArrow(_bags, "l string, h long, ids array<int>, counts array<int>").toArrow()
    langs, hashes = got["l"].to_pylist(), got["h"].to_pylist()
    bags = [(ids.values.to_numpy().astype(np.uint16), counts.values.to_numpy()) for ids, counts in zip(got["ids"], got["counts"], strict=True)]
    order = sorted(range(len(langs)), key=lambda i: (hashes[i], langs[i]))
    return fit_bags([bags[i] for i in order], [langs[i] for i in order])


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """All of ``docs``' columns with ``lang_pred``, ``score`` (its calibrated probability) and ``rejected``.

    A null text, or one without a letter, is ``und`` with score 0 and is rejected. Rows are handled one by one, over
    whole texts. Without any labelled document everything is ``und``. Columns of ``docs`` with the new names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        direct = len(m["names"]) <= DIM  # then sum the classes' parts of each embedding at once
        table = (m["table"] @ m["w"]).astype(np.float32) if direct and m["names"] else m["table"]
        for batch in batches:
            column = batch.column(place)
            if m["names"]:
                h = mean_vectors(column, table)
                p = _softmax(((h if direct else h @ m["w"]) + m["b"]) * m["scale"])
                best, score = p.argmax(1), p.max(1)
                able = np.fromiter((has_letter(t.as_py()) for t in column), bool, batch.num_rows)
            else:
                best, score, able = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            names = [m["names"][k] if ok else "und" for k, ok in zip(best, able, strict=True)]
            score = np.where(able, score, 0.0)
            rejected = ~able | (score < m["reject"])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], [*batch.schema.names, "lang_pred", "score", "rejected"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]))
