"""Global positions of ordered rows without a task that sees them all, and pages of an exact size cut by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

#: Rows' numbers within their partition are the low bits of what Spark numbers rows by.
_ROW_BITS = 33


def with_positions(rows: DataFrame, order: list[str], group: list[str] = ()) -> DataFrame:
    """``rows`` with ``position``: the place from 0 by ``order``, within each ``group`` if given. Nulls come first.

    Two passes. Rows are dealt by ranges of (group, order) and numbered within their partition; the ranges' counts, a few numbers a partition, give by prefix sums
    where each range begins. A group of any size spreads over as many partitions as its rows need. ``order`` should identify the rows of a
    group: of equal ones any may come first, and they share a partition.
    """
    dealt = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn("_at", F.monotonically_increasing_id())
    dealt = cut(dealt.withColumns({"_part": F.shiftright("_at", _ROW_BITS), "_row": F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)}).drop("_at"))
    keys = ["_part", *group]
    ranges = dealt.groupBy(*keys).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).drop("_first", "_n")
    a, b = dealt.alias("a"), starts.alias("b")
    same = F.col("a._part") == F.col("b._part")
    for g in group:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    return a.join(b, same).select(*(F.col(f"a.{c}") for c in rows.columns), (F.col("b._start") + F.col("a._row")).alias("position"))


def pages(rows: DataFrame, col: str, size: int, order: list[str], group: list[str] = ()) -> DataFrame:
    """``group..., page, values``: ``col`` of the rows in order, ``size`` to a page; every page is full but a group's last."""
    placed = with_positions(rows, order, group).withColumn("page", F.floor(F.col("position") / size))
    listed = F.sort_array(F.collect_list(F.struct("position", F.col(col).alias("v"))))  # ``size`` at most
    return placed.groupBy(*group, "page").agg(F.transform(listed, lambda x: x["v"]).alias("values"))
