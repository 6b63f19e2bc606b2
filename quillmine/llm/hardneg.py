"""Hard negatives: for each anchor and each of its positives, the best rows of other labels within limits that follow the positive's score.

A row's score is its integer inner product with the anchor. Rows are dealt into blocks of bounded size by a hash; anchors, a small stated part of
the rows, are copied to every block in chunks. One pass over the blocks finds the anchors' positives. In the second, a task computes an anchor's scores
against its whole block, lexsorts them by score and id once, and for each positive finds the upper limit by binary search and
reads the first rows of other labels from there on, down to the lower limit. What the blocks find is merged by anchor and positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Components of a block of rows together (32,768 rows of 64), and anchors that are scored at once.
BLOCK_VALUES, CHUNK = 1 << 21, 64
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as int64; what a long can't hold becomes its nearest."""
    most = max((abs(int(f(x))) for x in (a, b) if x.size for f in (np.min, np.max)), default=0) ** 2 * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most <= _HIGH:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, _LOW, _HIGH).astype(np.int64)


def best_of_label(score: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id, without the anchor's own id."""
    at = np.flatnonzero(ids != own)
    if len(at) > 4 * k:  # by score alone first, with all ties of the kth
        at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((ids[at], ~score[at]))[:k]]


class Sorted:
    """One anchor's scores against a block, by descending score, then id."""

    def __init__(self, score: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        order = np.lexsort((ids, ~score))
        self.down, self.ids, self.labels = ~score[order], ids[order], labels[order]  # ~score ascends as the score falls, without overflow

    def negatives(self, own: int, label: int, least: int, most: int, k: int) -> Iterator[tuple[int, int]]:
        """(id, score) of the first ``k`` rows of other labels with a score from ``least`` to ``most``."""
        at = int(np.searchsorted(self.down, ~min(most, _HIGH), "left")) if most >= _LOW else len(self.down)
        end = int(np.searchsorted(self.down, ~max(least, _LOW), "right")) if least <= _HIGH else 0
        step = 4 * k
        while at < end and k:
            part = slice(at, min(at + step, end))
            for i in np.flatnonzero((self.labels[part] != label) & (self.ids[part] != own))[:k].tolist():
                yield int(self.ids[at + i]), ~int(self.down[at + i])
                k -= 1
            at, step = part.stop, 2 * step


def limits(positive: int, low: int, high: int) -> tuple[int, int]:
    """The least and greatest integer score between ``low`` and ``high`` hundredths of the positive's (none, if the least is the greater)."""
    return -(-low * positive // 100), high * positive // 100


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, pa.Table]]:
    """(block, dim, kind) and rows: a block's own rows all together, its anchors as they come."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        edges = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, len(keys)].tolist()
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            now = tuple(keys[lo].tolist())
            if parts and (now != key or key[2]):
                yield *key, pa.Table.from_batches(parts)
                parts = []
            key = now
            parts.append(batch.slice(lo, hi - lo))
    if parts:
        yield *key, pa.Table.from_batches(parts)


def _matrix(rows: pa.Table, dim: int) -> np.ndarray:
    return rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(rows.num_rows, dim)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """Some anchors, their scores against their block, and the block's ids and labels."""
    at = None
    for block, dim, kind, rows in _runs(batches):
        if not kind:
            at, x = (block, dim), _matrix(rows, dim)
            ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        elif at == (block, dim):
            for lo in range(0, rows.num_rows, CHUNK):
                some = rows.slice(lo, CHUNK)
                yield some, products(_matrix(some, dim), x), ids, labels


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, scores, ids, labels in _blocks(batches):
            out: list[list] = [[], [], [], []]
            for own, key, label, score in zip(anchors["id"].to_pylist(), anchors["key"].to_pylist(), anchors["label"].to_pylist(), scores, strict=True):
                same = np.flatnonzero(labels == label)
                at = same[best_of_label(score[same], ids[same], own, k)]
                for column, values in zip(out, ([own] * len(at), [key] * len(at), ids[at].tolist(), score[at].tolist()), strict=True):
                    column += values
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["id", "key", "positive_id", "positive_score"])

    return run


def _negatives(k: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, scores, ids, labels in _blocks(batches):
            out = []
            for own, key, label, positives, score in zip(*(anchors[c].to_pylist() for c in ("id", "key", "label", "positives")), scores, strict=True):
                by_score = Sorted(score, ids, labels)
                for n, p in enumerate(positives):
                    for i, s in by_score.negatives(own, label, *limits(p["positive_score"], low, high), k):
                        out.append((own, key, n, p["positive_id"], p["positive_score"], i, s))
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "key", "n", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def mine(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "v"
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Both tables hold an id, a label and a vector (array of long). An anchor's positives are the ``positives`` highest scores among the rows of its
    label, and for each the ``negatives`` highest of rows of other labels are returned that lie between ``low`` and ``high`` hundredths of
    the positive's score; ties go to the smaller id, and fewer are all returned. Rows with a null id, label or vector take no part, nor does a row with
    the anchor's id; only vectors of one length meet. Rows alike in id, label and vector count once, rows with one id that differ each by itself.
    A score that a long cannot hold is the nearest long. Empty tables give no rows; other columns aren't read.
    """

    def side(df: DataFrame) -> DataFrame:
        named = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<long>").alias("v"))
        whole = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
        return whole.groupBy("id", "label", "v").agg(F.lit(1).alias("_one")).select("id", "label", "v", F.size("v").alias("dim"), F.xxhash64("id", "label", "v").alias("key"))

    points, asked = side(rows), side(anchors)
    blocks = max(1, -(-(points.agg(F.sum(F.col("dim").cast("long"))).first()[0] or 0) // BLOCK_VALUES))

    def dealt(asking: DataFrame) -> DataFrame:
        none = F.lit(None).cast("array<struct<positive_id:long,positive_score:long>>")
        p = points.withColumns({"block": F.pmod("key", F.lit(blocks)).cast("int"), "kind": F.lit(0), "positives": none})
        a = asking.withColumns({"block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "kind": F.lit(1)})
        columns = ["block", "dim", "kind", "id", "label", "key", "v", "positives"]
        return p.select(columns).unionByName(a.select(columns)).repartition("block", "dim").sortWithinPartitions("block", "dim", "kind", "id")

    best = dealt(asked.withColumn("positives", F.lit(None).cast("array<struct<positive_id:long,positive_score:long>>"))).mapInArrow(_positives(positives), "id long, key long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.desc("positive_score"), "positive_id"))
    first = best.withColumn("_n", place).where(F.col("_n") <= positives)
    ordered = F.sort_array(F.collect_list(F.struct("_n", "positive_id", "positive_score")))
    listed = first.groupBy("id", "key").agg(F.transform(ordered, lambda s: F.struct(s["positive_id"].alias("positive_id"), s["positive_score"].alias("positive_score"))).alias("positives"))
    found = dealt(asked.join(listed, ["id", "key"])).mapInArrow(
        _negatives(negatives, low, high), "id long, key long, n long, positive_id long, positive_score long, negative_id long, negative_score long"
    )
    rank = F.row_number().over(Window.partitionBy("id", "key", "n").orderBy(F.desc("negative_score"), "negative_id"))
    kept = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return kept.select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
