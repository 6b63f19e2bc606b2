"""SimHash near-duplicates: fingerprints of word shingles, linked by a bit-sliced comparison.

Texts with equal fingerprints are one class and are never compared. Two fingerprints within RADIUS = 2 bits agree on at least
three of five pieces, so each distinct fingerprint is dealt to ten buckets, one for each choice of three pieces (38 or 39
equal bits). A bucket with more than BUCKET fingerprints is dealt again in the same way by five pieces of the bits that
are left, which leaves at most 2**11 different fingerprints in a bucket whatever the data; rows grow by a constant factor,
no pair of a bucket is written down, and none is dropped. In a bucket the bits are stored as planes
(word j of plane b holds bit b of 64 fingerprints); distances of all to all are counted by carry-save bitwise counters.
After every _CHECK planes the queries whose counters all exceed the radius are given up, and a block without others is done. A bucket returns one edge for each linked
member, to the smallest one that it reaches there. Components are found by alternating large-star and small-star rounds.

``nearcopies`` links texts by similarity instead, with the same bit-sliced comparison at a wider radius.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.lineage import cut

BITS, RADIUS = 64, 2
BUCKET = 1024
#: Members compared at once; smaller buckets are put together up to this number.
SLAB = 512
#: Planes between two looks at which queries are done.
_CHECK = 8
_STEP = 1 << 16
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of one text: bit b is set if it is set in over half the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    n = len(words) - width + 1

    def parts() -> Iterator[np.ndarray]:
        for lo in range(0, n, _STEP):
            part = words[lo : min(n, lo + _STEP) + width - 1]
            shingles = map(b" ".join, zip(*(part[i:] for i in range(width)), strict=False))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64)

    return majority(parts(), n)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp`` (the fingerprint as a signed long) of every row; a null text counts as empty.

    text_hash (Spark's xxhash64) tells apart rows of one doc_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"])

    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def _pieces(bits: list[int], n: int = 5) -> list[list[int]]:
    return [bits[i * len(bits) // n : (i + 1) * len(bits) // n] for i in range(n)]


def _masks(bits: list[int]) -> list[int]:
    """For each choice of three of five pieces of ``bits``, the mask of those three."""
    return [sum(1 << b for piece in three for b in piece) for three in combinations(_pieces(bits), 3)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


MASKS = _masks(list(range(BITS)))
#: For each of MASKS, the masks that deal a large bucket again.
FINER = [[m | x for x in _masks([b for b in range(BITS) if not m >> b & 1])] for m in MASKS]


def _dealt(masks: list[int], number: Column) -> Column:
    return F.array(*(F.struct((number + i).cast("int").alias("deal"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)))


def majority(hashes: Iterable[np.ndarray], n: int) -> int:
    """The number whose bit b is set if bit b is set in over half of the ``n`` 64-bit hashes, given in parts."""
    total = np.zeros(BITS, np.int64)
    for part in hashes:
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _exceeded(counts: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Where the counters, whose bit planes are ``counts``, are above ``radius`` or have run over."""
    above, equal = over.copy(), ~np.zeros_like(over)
    for b in range(len(counts) - 1, -1, -1):
        if not radius >> b & 1:
            above |= equal & counts[b]
            equal &= ~counts[b]
        else:
            equal &= counts[b]
    return above


def near_groups(words: np.ndarray, radius: int = RADIUS, of: np.ndarray | None = None) -> np.ndarray:
    """For each of some fingerprints, the position of the first one that it reaches in links of ``radius`` bits.

    ``words``: uint64; ``of``: each one's bucket, if only those of one bucket are to be linked. Compared bit-sliced, SLAB
    queries at a time against all after them.
    """
    n = len(words)
    lanes = -(-n // 64)
    bits = np.unpackbits(words.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = np.zeros((BITS, lanes * 64), np.uint8)
    planes[:, :n] = bits.T
    planes = np.packbits(planes, axis=1, bitorder="little").view(np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    left, right = [], []
    place = np.arange(lanes * 64)
    for lo in range(0, n, SLAB):
        rows = np.arange(lo, min(lo + SLAB, n))
        # a query is compared with those after it (of its bucket); all others count as exceeded
        asked = place > rows[:, None]
        asked[:, n:] = False
        if of is not None:
            asked[:, :n] &= of[rows][:, None] == of
        over = np.packbits(~asked, axis=1, bitorder="little").view(np.uint64)
        alive = (over != full).any(1)
        rows, over = rows[alive], over[alive]
        counts = [np.zeros_like(over) for _ in range(radius.bit_length())]
        for b in range(BITS):
            if not len(rows):
                break
            carry = planes[b] ^ (bits[rows, b].astype(np.uint64) * full)[:, None]
            for plane in counts:
                np.bitwise_xor(plane, carry, out=plane)
                carry &= ~plane
            over |= carry
            if b % _CHECK == _CHECK - 1:
                exceeded = _exceeded(counts, over, radius)
                alive = (exceeded != full).any(1)
                if 4 * alive.sum() < 3 * len(rows):
                    rows, over, counts, exceeded = rows[alive], over[alive], [c[alive] for c in counts], exceeded[alive]
        if len(rows):
            near = ~exceeded
            row, lane = np.nonzero(near)
            on, bit = np.nonzero(np.unpackbits(near[row, lane].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            left.append(rows[row[on]])
            right.append(lane[on] * 64 + bit)
    group = np.arange(n)
    if not left:
        return group
    a, b = np.concatenate(left), np.concatenate(right)
    while len(a):
        low = np.minimum(group[a], group[b])
        before = group.copy()
        np.minimum.at(group, group[a], low)
        np.minimum.at(group, group[b], low)
        group = group[group]
        if (group == before).all():
            break
    return group


def _bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (fp, root) of rows (deal, key, fp) sorted by deal and key; buckets are whole in a partition."""

    def edges(fp: np.ndarray) -> pa.RecordBatch:
        words = np.unique(fp).view(np.uint64)
        words.sort()
        group = near_groups(words)
        on = np.flatnonzero(group != np.arange(len(words)))
        return pa.RecordBatch.from_arrays([pa.array(words[on].view(np.int64)), pa.array(words[group[on]].view(np.int64))], ["fp", "root"])

    deal, key, fp = (np.zeros(0, np.int64) for _ in range(3))
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
        deal, key, fp = (np.concatenate(x) for x in zip((deal, key, fp), new, strict=True))
        yield from _runs(deal, key, fp, edges)
        tail = _tail(deal, key)
        deal, key, fp = deal[tail:], key[tail:], fp[tail:]
    yield from _runs(np.append(deal, -1), np.append(key, 0), np.append(fp, 0), edges)


def _tail(deal: np.ndarray, key: np.ndarray) -> int:
    """Where the last bucket, which may go on in the next batch, begins."""
    if not len(deal):
        return 0
    other = np.flatnonzero((deal != deal[-1]) | (key != key[-1]))
    return int(other[-1]) + 1 if len(other) else 0


def _runs(deal: np.ndarray, key: np.ndarray, fp: np.ndarray, edges) -> Iterator[pa.RecordBatch]:
    """Compare the buckets before the last one, small ones many at a time (links between them are links all the same)."""
    end = _tail(deal, key)
    if not end:
        return
    at = np.flatnonzero(np.r_[True, (deal[1:end] != deal[: end - 1]) | (key[1:end] != key[: end - 1])])
    size = np.diff(np.r_[at, end])
    at, size = at[size > 1], size[size > 1]
    held: list[np.ndarray] = []
    n = 0
    for s, m in zip(at.tolist(), size.tolist(), strict=True):
        if held and n + m > SLAB:
            yield edges(np.concatenate(held))
            held, n = [], 0
        held.append(fp[s : s + m])
        n += m
    if held:
        yield edges(np.concatenate(held))


def links(fps: DataFrame) -> DataFrame:
    """Edges ``fp, root`` that join all linked ones of the distinct fingerprints in ``fps`` (column ``fp``)."""
    dealt = fps.select("fp", F.explode(_dealt(MASKS, F.lit(0))).alias("d")).select("fp", "d.deal", "d.key")
    large = dealt.groupBy("deal", "key").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET).select("deal", "key", F.lit(True).alias("large"))
    marked = dealt.join(large, ["deal", "key"], "left")
    again = F.element_at(F.array(*(_dealt(m, F.lit(100 + 10 * i)) for i, m in enumerate(FINER))), F.col("deal") + 1)
    whole = F.array(F.struct("deal", "key"))
    buckets = marked.select("fp", F.explode(F.when(F.col("large"), again).otherwise(whole)).alias("d")).select("d.deal", "d.key", "fp")
    return buckets.repartition("deal", "key").sortWithinPartitions("deal", "key").mapInArrow(_bucket_edges, "fp long, root long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` of every row.

    component_id is the smallest doc_id among the texts that are reached in links of at most two differing bits.
    Nulls and empty texts have fingerprint 0, linked like any other. Rows with a null doc_id belong to components but never
    name one (a component of such rows alone has a null id). Repeated rows stay. An empty table gives no rows. Other columns
    of ``docs`` are not read.
    """
    base = cut(fingerprints(docs, id_col, text_col, width))
    classes = cut(base.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(classes).select(F.col("fp").alias("u"), F.col("root").alias("v")))
    named = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = named.join(ids, "root").select("fp", "component_id")
    return base.join(of, "fp", "left").select("doc_id", "text_hash", "fp", "component_id")
