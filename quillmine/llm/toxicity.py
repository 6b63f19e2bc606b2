"""Toxicity: cumulative-link ordinal regression over sparse text features.

Features are the presence of a lower-cased word and of its first 4, 5, 6 and 8 bytes, by 64-bit hash (so that compounds and
inflected forms of a toxic stem share a weight). All grade thresholds share one weight vector w:
P(grade > j) = sigmoid(w.x - theta_j), theta ascending. Features are screened to go with toxicity, and weights are not negative.
Fitted by projected gradient steps (a linear penalty keeps few weights)
on a bounded sample of labelled rows; features are counted on the executors, and only those that are tied to toxicity come to the driver. Labels say toxic or not;
grades come from them in this way: the toxic documents of whose distinct features a larger share is strongly tied to toxicity than
of the share SEVERE of all toxic ones are grade 2, other toxic ones grade 1, all others 0. So a grade is about density, not length.
The result is the expected severity, P(grade > 0) + P(grade > 1), and the likeliest grade.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lineage import cut, discard
from . import textbytes as tb
from .sampling import labelled

GRADES = 3
#: Bound on the labelled rows of each class that the model is fitted on.
SAMPLE_PER_CLASS = 2500
#: A feature needs this much evidence (a chi-square of one degree) that it goes with toxicity; chance gives few of a million so much.
EVIDENCE = 20.0
SEVERE = 0.8
#: The weight of the upper threshold's loss; the weights that both share are about toxicity first, and then about its density.
UPPER = 0.1
PENALTY = 2e-5
THRESHOLD = 0.4
PREFIXES = (4, 5, 6, 8)


def feature_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of hashes for each word: the word's own, then its prefixes' (the word's own again where it is no longer)."""
    cuts = [np.minimum(starts + size, ends) for size in PREFIXES]
    out = tb.many_span_hashes(data, starts, [ends, *cuts])
    for j, cut in enumerate(cuts, 1):
        out[j] = np.where(cut == ends, out[0], out[j] ^ np.uint64(0x5851F42D4C957F2D))
    return out


def _document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = []
        for _, _, data, offsets in tb.chunks(batch.column(2)):
            data = tb.LOWER[data]
            starts, ends, rows = tb.spans(tb.ALNUM[data], offsets)
            hashes = feature_hashes(data, starts, ends)
            at = np.searchsorted(rows, np.arange(len(offsets)))
            for i in range(len(offsets) - 1):
                lists.append(np.unique(hashes[:, at[i] : at[i + 1]]).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))], ["id", "y", "features"])


def tied(feature_counts: DataFrame, n_toxic: int, n_clean: int, features: int | None = None) -> DataFrame:
    """``feature, t, c`` (toxic and clean documents that hold it) of the features that go with toxicity; the ``features`` best by evidence, or all."""
    t, c = F.col("t"), F.col("c")
    expected = (t + c) * F.lit(n_toxic / (n_toxic + n_clean))
    # twice the log-likelihood ratio of the toxic documents that hold the feature against their expected number
    gain = 2 * (t * F.log(t / expected) + F.when(c > 0, c * F.log(c / (t + c - expected))).otherwise(0.0))
    found = feature_counts.where(t >= 3).withColumn("gain", gain).where((t > expected) & (F.col("gain") >= EVIDENCE))
    return (found if features is None else found.orderBy(F.desc("gain"), "feature").limit(features)).select("feature", "t", "c")


def fit(y: np.ndarray, sizes: np.ndarray, lists: list[np.ndarray], values: np.ndarray, strong: np.ndarray, rounds: int = 1500) -> dict[str, np.ndarray]:
    """``hashes`` (ascending), ``w`` (their weights), ``theta`` (thresholds).

    ``sizes``: the number of distinct features of each document; ``lists``: those of them in ``values`` (ascending longs); ``strong``: which of these are strongly tied.
    """
    empty = {"hashes": np.zeros(0, np.uint64), "w": np.zeros(0), "theta": np.array([3.0, 5.0])}
    toxic = np.flatnonzero(y == 1)
    if not len(toxic) or len(toxic) == len(y) or not len(values):
        return empty
    doc = np.repeat(np.arange(len(y)), [len(x) for x in lists])
    col = np.searchsorted(values, np.concatenate(lists)) if len(doc) else np.zeros(0, np.int64)
    share = np.bincount(doc, strong[col], len(y)) / np.maximum(sizes, 1)
    grade = np.where(y == 1, 1 + (share > np.quantile(share[toxic], SEVERE)), 0)
    w, theta = np.zeros(len(values)), np.array([1.0, 3.0])
    above = grade[:, None] > np.arange(GRADES - 1)
    balance = np.where(y == 1, 0.5 / max(1, len(toxic)), 0.5 / (len(y) - len(toxic)))
    at = np.r_[w, theta]
    first, second = np.zeros_like(at), np.zeros_like(at)
    for step in range(1, rounds + 1):
        w, theta = at[: len(w)], at[len(w) :]
        score = np.bincount(doc, w[col], len(y))
        g = balance[:, None] * (1 / (1 + np.exp(np.clip(theta - score[:, None], -30, 30))) - above)
        g[:, 1:] *= UPPER
        grad = np.r_[np.bincount(col, g.sum(1)[doc], len(w)) + PENALTY, -g.sum(0)]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        at = at - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        at[: len(w)] = np.maximum(at[: len(w)], 0)
        at[len(w) :] = np.maximum.accumulate(at[len(w) :])
    w, theta = at[: len(w)], at[len(w) :]
    kept = np.flatnonzero(w)
    order = np.argsort(values[kept].view(np.uint64))
    return {"hashes": values[kept].view(np.uint64)[order], "w": w[kept][order], "theta": theta}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS, features: int | None = None) -> dict[str, np.ndarray]:
    """Fit on ``per_class`` documents of each class at most, none of them held out, of any length.

    Every feature with enough evidence gets a weight, or the ``features`` best of them if that is given.
    """
    rows = labelled(docs.select(F.col(id_col), F.col(text_col)), labels.withColumnRenamed("doc_id", id_col), "toxic", per_class, id_col, text_col)
    named = rows.select(F.col(id_col).cast("string").alias("id"), F.col("_y").cast("int").alias("y"), F.col(text_col).alias("text"))
    held = cut(named.mapInArrow(_document_features, "id string, y int, features array<long>"))
    number = {r.y: r.n for r in held.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = number.get(1, 0), number.get(0, 0)
    every = held.select("id", F.explode("features").alias("feature"), "y")
    counts = every.groupBy("feature").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    best = cut(tied(counts, n_toxic, n_clean, features)) if n_toxic and n_clean else None
    if best is None:
        return fit(np.zeros(0), np.zeros(0), [], np.zeros(0, np.int64), np.zeros(0))
    chosen = best.toArrow()
    values, t, c = (chosen[name].to_numpy().astype(np.int64) for name in ("feature", "t", "c"))
    by = np.argsort(values)
    values, strong = values[by], (t >= 20 * (c + 0.5) * n_toxic / n_clean)[by]
    hits = every.join(best.select("feature"), "feature").groupBy("id").agg(F.sort_array(F.collect_list("feature")).alias("hits"))
    got = held.select("id", "y", F.size("features").alias("n")).join(hits, "id", "left").select("id", "y", "n", F.coalesce("hits", F.array().cast("array<long>")).alias("hits")).orderBy("id").toArrow()
    for df in (held, best):
        discard(df)
    lists = [x.values.to_numpy() for x in got["hits"]]
    return fit(got["y"].to_numpy().astype(np.int64), got["n"].to_numpy(), lists, values, strong.astype(float))


def scores(column: pa.Array, model: dict[str, np.ndarray]) -> np.ndarray:
    """P(grade > j) of every text. Each feature counts once a text; whole texts are read."""
    hashes, w, theta = model["hashes"], model["w"], model["theta"]
    maybe = np.zeros(1 << 20, bool)
    maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True
    total = np.zeros(len(column))
    for lo, hi, data, offsets in tb.chunks(column):
        if not len(hashes):
            break
        data = tb.LOWER[data]
        starts, ends, rows = tb.spans(tb.ALNUM[data], offsets)
        found = feature_hashes(data, starts, ends)
        kind, word = np.nonzero(maybe[(found >> np.uint64(44)).astype(np.int64)])
        found = found[kind, word]
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        hit = hashes[at] == found
        pairs = np.unique(rows[word[hit]] * len(hashes) + at[hit])
        total[lo:hi] = np.bincount(pairs // len(hashes), w[pairs % len(hashes)], hi - lo)
    return 1 / (1 + np.exp(np.clip(theta - total[:, None], -30, 30)))


def grade(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """All of ``docs``' columns with ``severity`` (expected, 0 to 2), ``grade`` (0, 1, 2), ``score`` (P(grade > 0)), ``toxic``.

    ``toxic`` is score >= THRESHOLD. Null and empty texts have no features and are graded by the thresholds alone, so are
    not toxic. Rows are handled one by one: repeated rows, null ids and empty tables are no special cases. Without labels of both
    classes nothing is toxic. Columns of ``docs`` with the new names are replaced.
    """
    docs = docs.drop("severity", "grade", "score", "toxic")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = scores(batch.column(place), shared.value)
            each = np.c_[1 - above[:, 0], above[:, 0] - above[:, 1], above[:, 1]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(above.sum(1)), pa.array(each.argmax(1).astype(np.int32)), pa.array(above[:, 0]), pa.array(above[:, 0] >= THRESHOLD)],
                [*batch.schema.names, "severity", "grade", "score", "toxic"],
            )

    new = [T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("toxic", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *new]))
