"""Mix sources to target weights by systematic sampling.

A source's target comes from its weight and a cap on repeats (water-filling). Each of its documents then has
target / source size expected copies. The prefix sum of expected copies runs through the source's documents in order
of size, one offset in [0, 1) is added, and a document is emitted once for each whole number that its share of
the line crosses. In this order the words taken differ from the target by about one long document at most.

Documents stand in one order: source, size class, one of 256 slices by a hash of the id, id, one of 256 parts by a hash of size and
text, size, hash of the text; so no two unlike rows tie, and the copies do not depend on partitioning. No task ever holds a
source, nor a repeated id: rows equal in all of these are counted together first, the starts of the parts come from windows over
counts (of a slice's ids and parts), and only rows of one part are put in order. Rows without an id get their slice from their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut

#: Size classes per doubling of the size.
CLASSES = 16
WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
_BLANK_RUNS = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The number of runs of characters other than ASCII blanks; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(_BLANK_RUNS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``source, source_size, target`` for ``sizes`` (source, source_size: one row a source).

    Sources in order of code points, null last, take ``weights`` in turn. Together they get ``share`` times all sizes, by weight;
    one that would get more than ``cap`` times its size gets that, and the others share the excess by weight, until none is
    above. The sources that stop are those with the smallest size for their weight, so one sorted pass finds them. With
    share above cap every source stops. Windows here run over one row a source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(order) - 1) % len(weights) + 1
    weighed = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), place.cast("int")))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = Window.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(every) - F.lit(cap) * before) / F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    stops = F.lit(cap) * F.col("source_size") < F.col("level") * F.col("w")
    leveled = weighed.withColumn("level", level).withColumn("stops", stops)
    leveled = leveled.withColumn("level", F.max(F.when(~F.col("stops"), F.col("level"))).over(every))
    target = F.when(F.col("stops"), F.lit(cap) * F.col("source_size")).otherwise(F.col("level") * F.col("w"))
    return leveled.select("source", "source_size", target.cast("double").alias("target"))


def size_class(size: Column) -> Column:
    return F.floor(F.log2(size.cast("double") + 1) * CLASSES).cast("int")


def offset(source: Column, seed: str) -> Column:
    """The source's offset: a multiple of 2**-20 in [0, 1) from a hash of its name and the seed."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("s"), source), F.lit("-")))), 1, 5), 16, 10).cast("double") / (1 << 20)


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "0", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``doc_id, source, size, text_hash, n, source_size, target, before, each, u``: a row for each ``n`` documents that are alike.

    The i-th of them (from 1) stands at place ``before`` + i of its source; :func:`copies` turns that into a number of copies.
    """
    text = F.col(text_col)
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(text).alias("size"), F.xxhash64(text).alias("text_hash"))
    rows = read.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("n"))
    of_id = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.col("text_hash").cast("string")))
    part = F.pmod(F.xxhash64("size", "text_hash"), F.lit(256)).cast("int")
    rows = cut(rows.withColumns({"class": size_class(F.col("size")), "slice": F.substring(F.md5(of_id), 1, 2), "part": part}))
    counts = rows.groupBy("source", "class", "slice", "doc_id", "part").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("words"))
    slices = counts.groupBy("source", "class", "slice").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    classes = slices.groupBy("source", "class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    aims = targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap).withColumnRenamed("source", "a")
    up = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    starts = classes.select(F.col("source").alias("s"), F.col("class").alias("c"), F.coalesce(F.sum("n").over(up), F.lit(0)).alias("class_start"))
    within = Window.partitionBy("source", "class").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("slice_start", F.coalesce(F.sum("n").over(within), F.lit(0)))
    slices = slices.join(starts, slices["source"].eqNullSafe(starts["s"]) & (slices["class"] == starts["c"]))
    slices = slices.join(aims, slices["source"].eqNullSafe(aims["a"])).select(F.col("source").alias("s"), F.col("class").alias("c"), F.col("slice").alias("l"), (F.col("class_start") + F.col("slice_start")).alias("start"), "source_size", "target")
    inside = Window.partitionBy("source", "class", "slice").orderBy("doc_id", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.select("source", "class", "slice", "doc_id", "part", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("part_start"))
    parts = parts.join(slices, parts["source"].eqNullSafe(slices["s"]) & (parts["class"] == slices["c"]) & (parts["slice"] == slices["l"]))
    parts = parts.select(*(F.col(c).alias(f"p_{c}") for c in ("source", "class", "slice", "doc_id", "part")), (F.col("start") + F.col("part_start")).alias("start"), "source_size", "target")
    order = Window.partitionBy("source", "class", "slice", "doc_id", "part").orderBy("size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumn("earlier", F.coalesce(F.sum("n").over(order), F.lit(0)))
    same = [numbered[c].eqNullSafe(parts[f"p_{c}"]) for c in ("source", "doc_id")] + [numbered[c] == parts[f"p_{c}"] for c in ("class", "slice", "part")]
    out = numbered.join(parts, same)
    each = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    return out.select("doc_id", "source", "size", "text_hash", "n", "source_size", "target", (F.col("start") + F.col("earlier")).alias("before"), each.alias("each"), offset(F.col("source"), seed).alias("u"))


def copies(place: Column) -> Column:
    """How many whole numbers the document at ``place`` of its source crosses (columns ``each`` and ``u`` of :func:`placed`)."""
    return (F.floor(F.col("each") * place + F.col("u")) - F.floor(F.col("each") * (place - 1) + F.col("u"))).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "0", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``: how often each document is emitted.

    size counts words (0 for a null or blank text), taken is copies * size. Copies are floor(e) or floor(e) + 1 for
    e = target / source_size, and never above ``cap`` where that is whole. A source without words has target 0 and no
    copies. A null source is a source of its own. Rows with equal or null doc_ids are documents of their own. The same rows and
    seed give the same result, however they are partitioned. An empty table gives no rows; other columns aren't read.
    """
    found = placed(docs, id_col, text_col, source_col, seed, weights, share, cap)
    found = found.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn("copies", copies(F.col("before") + F.col("i")))
    return found.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
