"""Bounded samples of rows to fit classifiers on: so many rows exactly, of any length, alike in any partitioning.

What crosses to the driver are features of whole texts, counted on the executors. A text with more distinct features than a model takes is thinned
there to a fixed number of them, in proportion to their counts, so a long text weighs no more than others and none is left out for its length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 5 is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def counted(features: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct features, ascending; their counts): all of them, or of more than ``most`` those that ``most`` even steps through the occurrences meet."""
    values, counts = np.unique(features, return_counts=True)
    if len(values) > most:
        ends = np.cumsum(counts)
        steps = (np.arange(most) * 2 + 1) * ends[-1] // (2 * most)
        values, counts = np.unique(values[np.searchsorted(ends, steps, side="right")], return_counts=True)
    return values, counts


def by_class(rows: DataFrame, label: str, key: list[str], per_class: int, total: int) -> DataFrame:
    """``rows``' ``label`` and ``key`` of ``per_class`` rows of each label at most, and of ``total`` in all, picked by a hash of the key.

    Rows equal in label and key count as one. Every label gets its first row before any gets its second, so as long as there are no
    more than ``total`` labels, none is left out.
    """
    distinct = rows.groupBy(label, *key).agg(F.lit(1).alias("_one")).drop("_one").withColumn("_h", F.xxhash64(*key, F.lit(7)))
    place = F.row_number().over(Window.partitionBy(label).orderBy("_h", *key))
    first = distinct.withColumn("_n", place).where(F.col("_n") <= per_class)
    return first.orderBy("_n", "_h", label, *key).limit(total).select(label, *key)


def labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each of a bounded sample of ``labels``, with ``_y`` (0 or 1; other labels, nulls and held-out ids are left out).

    An id with both labels counts as 1. Of rows with one id that with the smallest text hash is taken.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")).where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    picked = by_class(known.groupBy("_id").agg(F.max("_y").alias("_y")), "_y", ["_id"], per_class, 2 * per_class)
    rows = docs.join(F.broadcast(picked), docs[id_col] == picked["_id"])  # 2 * per_class ids at most
    return rows.groupBy("_id").agg(F.min(F.struct(F.xxhash64(text_col).alias("_h"), "_y", *docs.columns)).alias("_r")).select("_r._y", *(f"_r.{c}" for c in docs.columns))
