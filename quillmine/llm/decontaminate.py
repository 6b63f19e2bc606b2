"""Benchmark decontamination by winnowed fingerprints.

A text's 5-word grams are hashed, and of every six in a row (10 words) those with the smallest hash are kept. A span of ten
words that a document and an item share holds the same six hashes in both, so both keep one that they share: joining the
kept fingerprints finds every shared span of ten words. A fingerprint carries the five words to either side; a joined pair is
extended over the words that agree, and counts if ten or more do. All hits of a longer span are found in this way, because
each of its windows keeps a fingerprint of its own. An item of fewer than ten words is one window; documents look for
such windows by the hash of as many words, at every position, and compare the words.

Documents send out only fingerprints that a bitmap of the benchmark's fingerprints passes. It has a fixed size
(BITMAP_BITS), whatever the tables' sizes; what it passes wrongly the join removes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut
from . import textbytes as tb

GRAM, WINDOW = 5, 10
SIDE = WINDOW - GRAM
#: 2 MB, sent to each executor once.
BITMAP_BITS = 1 << 24
#: Words: runs of bytes that are a-z (after A-Z are lower-cased), 0-9 or part of a character above U+007F.
WORD = tb.ALNUM
_FINGERPRINTS = "array<struct<fp:long, size:int, words:array<string>, at:int, places:array<int>>>"
_FP_TYPE = pa.list_(pa.struct([("fp", pa.int64()), ("size", pa.int32()), ("words", pa.list_(pa.string())), ("at", pa.int32()), ("places", pa.list_(pa.int32()))]))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each ``size`` consecutive word hashes (also across rows; the caller leaves those out)."""
    n = max(0, len(words) - size + 1)
    total = np.full(n, size, np.uint64)
    for j in range(size):
        total = (total ^ words[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return tb.mix(total)


def winnow(grams: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which 5-grams are the smallest of some six in a row within one text. ``rows``: the text of each word."""
    kept = np.zeros(len(grams), bool)
    wide = WINDOW - GRAM + 1
    n = len(rows) - WINDOW + 1
    if n <= 0:
        return kept
    whole = rows[:n] == rows[WINDOW - 1 :]
    low = grams[:n].copy()
    for j in range(1, wide):
        np.minimum(low, grams[j : j + n], out=low)
    for j in range(wide):
        kept[j : j + n] |= whole & (grams[j : j + n] == low)
    return kept


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % BITMAP_BITS


def _fingerprinted(batch: pa.RecordBatch, text: int, short: list[int], bitmap: np.ndarray | None):
    """For each row, its number of words and its fingerprints; with a bitmap, of those that it passes.

    ``short``: the window sizes below WINDOW that are looked for. Without a bitmap (for the benchmark) a text of fewer than
    WINDOW words gives one window of all its words.
    """
    n_words, lists = np.zeros(batch.num_rows, np.int64), [[] for _ in range(batch.num_rows)]
    for lo, hi, data, offsets in tb.chunks(batch.column(text)):
        data = tb.LOWER[data]
        starts, ends, rows = tb.spans(WORD[data], offsets)
        n_words[lo:hi] = np.bincount(rows, minlength=hi - lo)
        first = np.r_[0, np.cumsum(n_words[lo:hi])]
        hashes = tb.span_hashes(data, starts, ends)

        def word_list(a: int, b: int, data=data, starts=starts, ends=ends) -> list[str]:
            return [data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace") for i in range(a, b)]

        grams = gram_hashes(hashes, GRAM)
        picked = winnow(grams, rows)
        if bitmap is not None:
            picked &= bitmap[_slots(grams)]
        found = [(i, GRAM, grams[i], max(int(first[rows[i]]), i - SIDE), min(int(first[rows[i] + 1]), i + GRAM + SIDE)) for i in np.flatnonzero(picked).tolist()]
        if bitmap is None:
            for row in np.flatnonzero((n_words[lo:hi] > 0) & (n_words[lo:hi] < WINDOW)).tolist():
                a, b = int(first[row]), int(first[row + 1])
                found.append((a, -(b - a), gram_hashes(hashes[a:b], b - a)[0], a, b))
        else:
            for size in short:
                of = gram_hashes(hashes, size)
                for i in np.flatnonzero(bitmap[_slots(of)] & (rows[: len(of)] == rows[size - 1 :])).tolist():
                    found.append((i, -size, of[i], i, i + size))
        merged: dict[tuple, list[int]] = {}
        for i, size, h, a, b in found:
            row = int(rows[i])
            context = tuple(word_list(a, b))
            merged.setdefault((row, size, int(h), context, i - a), []).append(i - int(first[row]))
        for (row, size, h, context, at), places in merged.items():
            lists[lo + row].append({"fp": h - (1 << 64) if h >= 1 << 63 else h, "size": size, "words": context, "at": at, "places": places})
    return n_words, lists


def _run(text: int, short: list[int], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if shared is None else np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        for batch in batches:
            n_words, lists = _fingerprinted(batch, text, short, bitmap)
            columns = [batch.column(i) for i in range(batch.num_columns) if i != text]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words), pa.array(lists, _FP_TYPE)], [*(f"k{i}" for i in range(len(columns))), "n_words", "found"])

    return run


def _agreeing(a: Column, b: Column) -> Column:
    """How many words agree from the front of two arrays, up to SIDE."""
    n = F.lit(0)
    for j in reversed(range(SIDE)):
        n = F.when(F.get(a, F.lit(j)) == F.get(b, F.lit(j)), n + 1).otherwise(F.lit(0))
    return n


def _left(words: str, at: str) -> Column:
    return F.reverse(F.slice(F.col(words), F.lit(1), F.col(at)))


def _right(words: str, at: str) -> Column:
    return F.slice(F.col(words), F.col(at) + 1 + GRAM, F.lit(SIDE))


def _mid(words: str, at: str) -> Column:
    return F.slice(F.col(words), F.col(at) + 1, F.lit(GRAM))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_words, hits, items``: one row for each (doc_id, text) of ``docs``, repeated rows as often as they come.

    ``hits``: array of (from, to) word ranges, ``to`` exclusive, that occurrences of benchmark windows cover (they may
    overlap); ``items``: the sorted distinct item ids, as strings, whose windows occur. A null or wordless text has 0 words
    and no hits; null and wordless items have no windows; items with a null id count for hits but aren't named. A null
    doc_id is kept. Empty tables give no rows, or no hits. Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("k0"), F.col(item_text).alias("text"))
    rows = cut(items.mapInArrow(_run(1, [], None), f"k0 string, n_words long, found {_FINGERPRINTS}").select(F.col("k0").alias("item_id"), F.inline("found")).withColumnsRenamed({"words": "item_words", "at": "item_at"}).drop("places").distinct())
    slot = F.shiftrightunsigned("fp", 40) % BITMAP_BITS
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    filled = rows.select(slot.alias("s")).groupBy((F.col("s") / 8).cast("int").alias("byte")).agg(F.bit_or(F.element_at(F.array(*(F.lit(128 >> i) for i in range(8))), (F.col("s") % 8).cast("int") + 1)).alias("b"))
    filled = filled.toPandas()  # BITMAP_BITS / 8 rows of two ints at most, whatever the benchmark's size
    bits[filled["byte"]] = filled["b"]
    short = sorted(-r[0] for r in rows.where("size < 0").select("size").distinct().collect())
    sent = spark.sparkContext.broadcast(bits.tobytes())
    seen = docs.select(F.col(id_col).alias("k0"), F.xxhash64(F.col(text_col)).alias("k1"), F.col(text_col).alias("text"))
    seen = seen.mapInArrow(_run(2, short, sent), f"k0 {docs.schema[id_col].dataType.simpleString()}, k1 long, n_words long, found {_FINGERPRINTS}")
    seen = cut(seen.withColumn("row", F.monotonically_increasing_id()))
    parts = seen.where(F.size("found") > 0).select("row", F.inline("found"))
    pairs = parts.join(rows, ["fp", "size"])
    left, right = _agreeing(_left("words", "at"), _left("item_words", "item_at")), _agreeing(_right("words", "at"), _right("item_words", "item_at"))
    long = (F.col("size") > 0) & (_mid("words", "at") == _mid("item_words", "item_at")) & (left + right + GRAM >= WINDOW)
    same = (F.col("size") < 0) & (F.col("words") == F.col("item_words"))
    hit = pairs.where(long | same).select("row", "item_id", "places", F.when(F.col("size") > 0, left).otherwise(0).alias("l"), F.when(F.col("size") > 0, right + GRAM).otherwise(-F.col("size")).alias("r"))
    ranges = hit.select("row", "l", "r", F.explode("places").alias("p")).select("row", F.struct((F.col("p") - F.col("l")).alias("from"), (F.col("p") + F.col("r")).alias("to")).alias("h")).distinct()
    found = ranges.groupBy("row").agg(F.array_sort(F.collect_list("h")).alias("hits"))
    named = hit.select("row", "item_id").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    out = seen.drop("found").join(found, "row", "left").join(named, "row", "left")
    return out.select(F.col("k0").alias("doc_id"), F.col("k1").alias("text_hash"), "n_words", F.coalesce("hits", F.array().cast("array<struct<from:int,to:int>>")).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def covered(hits: Column) -> Column:
    """How many positions the sorted ranges of ``hits`` cover."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        hits, zero,
        lambda s, h: F.struct((s["n"] + F.greatest(F.lit(0), h["to"] - F.greatest(h["from"], s["end"]))).cast("long").alias("n"), F.greatest(s["end"], h["to"]).alias("end")),
        lambda s: s["n"],
    )
