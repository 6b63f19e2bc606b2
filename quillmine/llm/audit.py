"""How quality filters act together: what each removes in every order in which they could be applied.

A document's failures are a mask of one bit a filter, so a part of the corpus is a table of 2^n cells: counts by mask. All that any order does follows from
these. The orders are visited by adjacent transpositions, each differing from the one before by one swap of neighbours: what the other
steps keep and remove stays, and only the two swapped steps are computed anew from the cells. A filter's Shapley value, the sum of
what it removes over all orders, accumulates along the walk.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The filters of texts, in the bits' order; the last one compares documents.
LETTERS = "ABCDE"
_UPPER = bytes(range(65, 91))
_ODD = re.compile(rb"[#$%&*|]")
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text that are split into words at once, and parts that are walked at once.
_SLICE, _PARTS = 1 << 20, 64
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _slices(raw: bytes) -> Iterator[bytes]:
    """The text in pieces that are cut at blanks, so that a long text's words are not all listed at once."""
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > _SLICE and (m := _BLANK.search(raw, at + _SLICE)):
            end = m.end()
        yield raw[at:end]
        at = end


def failures(text: str) -> int:
    """The mask of the failing filters that look at one text: few words, repeated words, capitals, odd signs."""
    raw = text.encode("utf-8", "surrogatepass")
    words, distinct = 0, set()
    for part in _slices(raw):
        found = part.split()  # at exactly the blanks of ASCII
        words += len(found)
        distinct.update(found)
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    return (words < 50) | (100 * len(distinct) < 65 * words) << 1 | (100 * capitals > 5 * len(text)) << 2 | bool(_ODD.search(raw)) << 3


def orders(n: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """All permutations of 0 .. n-1 by single swaps, each with the place of the swap that made it (-1 for the first)."""
    order, heading = list(range(n)), [-1] * n
    yield tuple(order), -1
    while True:
        able = [v for i, v in enumerate(order) if 0 <= i + heading[v] < n and order[i + heading[v]] < v]
        if not able:
            return
        most = max(able)
        i = order.index(most)
        j = i + heading[most]
        order[i], order[j] = order[j], order[i]
        for v in range(most + 1, n):
            heading[v] = -heading[v]
        yield tuple(order), min(i, j)


def walk(cells: np.ndarray) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """Each order with its steps' counts (parts x steps x COUNTS without shapley). ``cells``: parts x masks x (all, good, toxic)."""
    parts, size, _ = cells.shape
    n = size.bit_length() - 1
    masks = np.arange(size)
    alone = cells[:, 1 << np.arange(n), 0]
    fails = np.stack([cells[:, masks >> f & 1 == 1, 0].sum(1) for f in range(n)], axis=1)
    now = np.zeros((parts, n, len(COUNTS) - 1), np.int64)
    shapley = np.zeros((parts, n), np.int64)
    for order, swap in orders(n):
        for step in range(n) if swap < 0 else (swap, swap + 1):
            f = order[step]
            before = sum(1 << order[i] for i in range(step))
            taken = cells[:, (masks & before == 0) & (masks >> f & 1 == 1)].sum(1)
            now[:, step, 0] = cells[:, masks & (before | 1 << f) == 0, 0].sum(1)
            now[:, step, 1] = taken[:, 0]
            now[:, step, 2] = fails[:, f] - taken[:, 0]
            now[:, step, 3] = alone[:, f]
            now[:, step, 4:] = taken[:, 1:]
        shapley[:, list(order)] += now[:, :, 1]
        yield order, now.copy()
    yield (), shapley


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 500):
            batch = whole.slice(lo, 500)
            texts = [t or "" for t in batch.column(2).to_pylist()]
            digests = [hashlib.md5(t.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest() for t in texts]
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            masks = pa.array([failures(t) for t in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), masks, pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["id", "part", "mask", "h1", "h2"])


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and mask of failing filters, and how many of them are labelled so.

    Texts are compared by 128 bits of hash. What is shuffled are ids, masks and hashes, a row a document, and the more alike the rows, the fewer: equal rows are
    counted before, and rows of one text are counted by part and label before they meet.
    """
    judged = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("string").alias("text"))
    judged = judged.mapInArrow(_judged, "id long, part string, mask int, h1 long, h2 long")
    rows = judged.groupBy("id", "part", "mask", "h1", "h2").agg(F.count("*").alias("n"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id"))
    marks = marks.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("g"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("t"))
    # rows without an id have no label, and are dealt by their text so that they are no hot key
    marked = rows.withColumn("_key", F.coalesce("id", "h1")).join(marks, (F.col("_key") == F.col("_id")) & F.col("id").isNotNull(), "left")
    marked = marked.select("id", "part", "mask", "h1", "h2", "n", F.coalesce("g", F.lit(0)).alias("g"), F.coalesce("t", F.lit(0)).alias("t"))
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    alike = marked.groupBy("h1", "h2", "part", "mask", "g", "t").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("bare"), first.alias("first"))
    least = F.min("first.id").over(Window.partitionBy("h1", "h2"))
    # of a text's rows those with the smallest id pass, and those without one
    fresh = F.col("bare") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = alike.withColumn("least", least).withColumn("fresh", fresh)
    either = F.explode(F.array(F.struct(F.col("mask").alias("m"), F.col("fresh").alias("c")), F.struct((F.col("mask") + 16).alias("m"), (F.col("n") - F.col("fresh")).alias("c"))))
    counted = split.select("part", "g", "t", either.alias("e")).where("e.c > 0")
    return counted.groupBy("part", F.col("e.m").alias("mask")).agg(F.sum("e.c").alias("n"), F.sum(F.col("e.c") * F.col("g")).alias("good"), F.sum(F.col("e.c") * F.col("t")).alias("toxic"))


def _walked(letters: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, _PARTS):
                batch = whole.slice(lo, _PARTS)
                dense = np.zeros((batch.num_rows, 1 << len(letters), 3), np.int64)
                for i, found in enumerate(batch.column(1).to_pylist()):
                    for c in found:
                        dense[i, c["mask"]] = c["n"], c["good"], c["toxic"]
                *steps, (_, shapley) = walk(dense)
                for order, counts in steps:
                    names = np.array([*letters])[list(order)]
                    every = np.concatenate([counts, shapley[:, list(order)][:, :, None]], axis=2).reshape(-1, len(COUNTS))
                    n = len(order)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), n))), pa.array(["".join(names)] * len(every)), pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), batch.num_rows)),
                            pa.array(np.tile(names, batch.num_rows)), *(pa.array(every[:, j].copy()) for j in range(len(COUNTS))),
                        ],
                        ["part", "filter_order", "step", "filter", *COUNTS],
                    )

    return run


def interactions(found: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``part, filter_order, step, filter`` and COUNTS of each part's cells (``part, mask, n, good, toxic``), for all orders of the filters."""
    listed = found.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 2^n at most
    schema = "part string, filter_order string, step int, filter string, " + ", ".join(f"{c} long" for c in COUNTS)
    return listed.select("part", "cells").mapInArrow(_walked(letters), schema)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """What the five filters do in each of their 120 orders: a row for every part, order and step.

    A null text is empty, a null part is that of the empty string. A document fails E if a smaller id has its text; without an id it never does, and rows
    with the smallest id all pass. A document is good (toxic) if some row of ``labels`` with its id says 1; ids that repeat there or are
    null count for nothing more. Repeated rows count each. Empty tables give no rows; other columns aren't read.
    """
    return interactions(cells(docs, labels, id_col, text_col, part_col))
