"""Repeated byte strings: every byte covered by a string of LENGTH bytes that also starts elsewhere, found with a Burrows-Wheeler transform.

*Dealing.* Of the hashes of the GRAM-byte strings in a window of LENGTH bytes the least (leftmost on ties) is the window's anchor. It depends on the window's
bytes alone, so equal windows have equal anchors, at equal places. The windows of a document with one anchor form a piece, a run of starts. Pieces are
dealt by anchor; those whose anchor occurs once hold nothing that repeats. Equal pieces are counted, not copied, and only one of them brings its text.

*Search.* A task joins the pieces of many anchors into one text of eight-byte symbols, on a grid that starts at each anchor, with an end mark of
its own for each piece. On the transform of that text intervals of suffixes are extended backwards, breadth first, beginning with single symbols: the interval of
the suffixes that begin with w yields those of cw for all symbols c before them, and where an interval of cw ends, the common prefix of the neighbouring suffixes
is |w|, if nothing shorter was found there before. So common prefixes are derived by increasing value, each once, and the search stops at LENGTH / 8 - 1
symbols: places without a value then have a common prefix at least that long. The eight bytes that are missing, some before and some after, are compared
directly among the suffixes that are left together. A window counts as often as its piece does.

An anchor of more than ``split`` unlike pieces would be one task's work; its windows are counted one by one by 128 bits of hash, combined before the shuffle.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lineage import cut
from .textbytes import chunks, mix, powers

LENGTH, GRAM = 400, 100
#: Unlike pieces of one anchor that are searched together.
SPLIT = 4096
#: Symbols of the text of one transform, and bytes of a document whose windows are dealt at once.
SYMBOLS, SEGMENT = 1 << 19, 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's hash, first start, number of starts, anchor's place) of every piece of some rows' bytes."""
    windows = len(data) - length + 1
    if windows <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    n = len(data) - gram + 1
    hashes = mix((sums[gram:] - sums[:n]) * down[:n])
    width = length - gram + 1
    keys = np.full(-(-n // width) * width, ~np.uint64(0))
    keys[:n] = (hashes & ~_PLACE) | np.arange(n, dtype=np.uint64)
    blocks = keys.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows]) & _PLACE).astype(np.int64)
    starts = np.arange(windows)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    starts = starts[starts + length <= offsets[1:][row]]
    if not len(starts):
        return hashes[:0], starts, starts, starts
    at = place[starts]
    edge = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    return hashes[at[edge]], starts[edge], np.diff(np.r_[edge, len(starts)]), at[edge]


def _segments(column: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, place of the first byte in its row, bytes, offsets): runs of whole rows, or a part of a long row with ``length`` - 1 bytes of the next part."""
    for lo, hi, data, offsets in chunks(column, SEGMENT):
        if hi - lo > 1 or len(data) <= 2 * SEGMENT:
            yield lo, 0, data, offsets
        else:
            for at in range(0, len(data) - length + 1, SEGMENT):
                part = data[at : at + SEGMENT + length - 1]
                yield lo, at, part, np.array([0, len(part)])


def _dealt(length: int, gram: int, with_pieces: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = None if not with_pieces else [batch.column(i).to_numpy() for i in (0, 1)]
            for lo, base, data, offsets in _segments(batch.column(batch.schema.get_field_index("_text")), length):
                found, starts, counts, places = anchors(data, offsets, length, gram)
                if not len(found):
                    continue
                if not with_pieces:
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["a"])
                    continue
                raw = memoryview(np.ascontiguousarray(data))
                ends = starts + counts + length - 1
                pieces = b"".join(hashlib.blake2b(raw[s:e], digest_size=8).digest() for s, e in zip(starts.tolist(), ends.tolist(), strict=True))
                row = np.searchsorted(offsets, starts, side="right") - 1
                at = (starts - offsets[row] + base) << 20 | counts << 10 | (places - starts)
                columns = [keys[0][lo + row], keys[1][lo + row], found.view(np.int64), np.frombuffer(pieces, np.int64), at]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "a", "p", "at"])

    return run


def _unpacked(at: int) -> tuple[int, int, int]:
    """(first start, number of starts, where the anchor is after the first start)"""
    return at >> 20, at >> 10 & 1023, at & 1023


#: Pieces, or windows, that are sent on at once.
_SENT = 4096


def _text_pieces(length: int, windows: bool):
    names = ["a", "p", "n", "o", "w1", "w2"] if windows else ["a", "p", "n", "count", "place", "part"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), *([pa.int64()] * 2 if windows else [pa.int32(), pa.binary()])]

    def pieces(raw: bytes, need: pa.StructArray) -> Iterator[tuple]:
        a, p, n, at = (need.field(name).to_numpy() for name in ("a", "p", "n", "at"))
        for i in range(len(need)):
            start, count, place = _unpacked(int(at[i]))
            part = raw[start : start + count + length - 1]
            if int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True) != p[i]:
                continue  # a row whose key is that of another text
            if not windows:
                yield a[i], p[i], n[i], count, place, part
                continue
            for o in range(count):
                h = hashlib.blake2b(part[o : o + length], digest_size=16).digest()
                yield a[i], p[i], n[i], o, int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            need = batch.column(batch.schema.get_field_index("need"))
            for i, text in enumerate(batch.column(batch.schema.get_field_index("_text"))):
                found = pieces(text.as_py().encode("utf-8", "surrogatepass"), need[i].values)
                while some := list(itertools.islice(found, _SENT)):  # a long text's pieces are never all held
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)

    return run


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes' places, ordered by their first ``depth`` symbols at least, by doubling. Symbols are numbers from 0, less than 2^31."""
    rank, n, h = text, len(text), 1
    base = max(n, int(text.max(initial=0))) + 2
    order = np.argsort(rank, kind="stable")
    while h < depth:
        after = np.zeros(n, np.int64)
        after[: n - h] = rank[h:] + 1
        key = rank * base + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.zeros(n, np.int64)
        fresh[1:] = np.cumsum(key[1:] != key[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            break
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, first: np.ndarray, depth: int) -> np.ndarray:
    """For each place of ``order`` the common prefix with the suffix before it, by increasing value; -1 where it is ``depth`` symbols or more.

    ``first``: whether a place of the text begins a piece, so that what stands before it is not a symbol before it.
    """
    n = len(text)
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    before = order - 1
    extends = ~first[order]
    symbol = np.where(extends, text[before], -1)
    step = at[before]  # where the suffix with the symbol before it stands
    prefix = np.full(n + 1, -1, np.int64)
    prefix[n] = 0
    head = text[order]
    edge = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
    low, high = edge, np.r_[edge[1:], n]
    prefix[edge] = 0
    low, high = low[:-1], high[:-1]  # the interval that ends the text ends where every interval does
    for length in range(1, depth):
        if not len(low):
            break
        size = high - low
        interval = np.repeat(np.arange(len(low)), size)
        place = np.arange(int(size.sum())) + np.repeat(low - (np.cumsum(size) - size), size)
        able = extends[place]
        place, interval = place[able], interval[able]
        to = step[place]
        by = np.argsort(to, kind="stable")
        to, interval, c = to[by], interval[by], symbol[place[by]]
        edge = np.flatnonzero(np.r_[True, (interval[1:] != interval[:-1]) | (c[1:] != c[:-1])]) if len(to) else np.zeros(0, np.int64)
        low, high = to[edge], to[np.r_[edge[1:], len(to)] - 1] + 1 if len(to) else to
        new = prefix[high] < 0
        low, high = low[new], high[new]
        prefix[high] = length
    return prefix[:n]


def repeated(parts: list[bytes], counts: np.ndarray, places: np.ndarray, times: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each piece, whether the window at each of its starts occurs twice or more among the pieces, each taken ``times`` times.

    ``places``: where the anchor is after the first start. Windows that are equal must have equal anchors at equal places.
    """
    whole = length // 8 - 1
    phase = places % 8
    sizes = np.array([len(p) for p in parts], np.int64)
    # 8 bytes of padding on both sides, so that the symbols beside the grid can be read; then whole symbols
    room = (-(-(sizes - phase) // 8) + 3) * 8
    begin = np.cumsum(room) - room
    data = np.zeros(int(room.sum()), np.uint8)
    for p, lead, at in zip(parts, (16 - phase).tolist(), begin.tolist(), strict=True):
        data[at + lead : at + lead + len(p)] = np.frombuffer(p, np.uint8)
    words = data.view(">u8").astype(np.uint64)
    inner = (sizes - phase) // 8  # symbols on the grid
    start = begin // 8 + 2
    n = inner + 1
    first = np.cumsum(n) - n
    total = int(n.sum())
    piece = np.repeat(np.arange(len(parts)), n)
    x = np.arange(total) - first[piece]
    end = x == inner[piece]
    text = np.unique(np.where(end, 0, words[np.minimum(start[piece] + x, len(words) - 1)]), return_inverse=True)[1].astype(np.int64) + len(parts)
    text[end] = np.arange(len(parts))
    begins = x == 0
    order = suffix_order(text, whole + 1)
    prefix = common_prefixes(text, order, begins, whole)
    group = np.cumsum(prefix >= 0)
    alone = np.bincount(group)[group] == 1
    out = [np.full(c, t > 1) for c, t in zip(counts.tolist(), times.tolist(), strict=True)]
    left = ~alone
    place, group = order[left], group[left]
    of, g = piece[place], x[place] * 8 + phase[piece[place]]  # the byte of the piece where the suffix begins
    back, ahead = words[start[of] + x[place] - 1], words[np.minimum(start[of] + x[place] + whole, len(words) - 1)]
    keys, rests, ofs, ats = [], [], [], []
    for r in range(8):
        s = g - r
        ok = (s >= 0) & (s < counts[of])
        tail = ahead[ok] >> np.uint64(8 * r)
        rest = tail if not r else (back[ok] << np.uint64(64 - 8 * r)) | tail
        keys.append(group[ok] * 8 + r)
        rests.append(rest)
        ofs.append(of[ok])
        ats.append(s[ok])
    key, rest, of, at = (np.concatenate(a) for a in (keys, rests, ofs, ats))
    by = np.lexsort((rest, key))
    key, rest, of, at = key[by], rest[by], of[by], at[by]
    if len(key):
        edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (rest[1:] != rest[:-1])])
        often = np.repeat(np.add.reduceat(times[of], edge) > 1, np.diff(np.r_[edge, len(key)]))
        flat = np.concatenate(out)
        where = np.cumsum(counts) - counts
        flat[where[of[often]] + at[often]] = True
        out = np.split(flat, where[1:])
    return out


def _runs(inside: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[0, inside.astype(np.int8), 0]))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _searched(length: int, symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # a, p, n, count, place, part
        size = 0

        def found() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True))
            inside = repeated(list(columns[5]), np.array(columns[3], np.int64), np.array(columns[4], np.int64), np.array(columns[2], np.int64), length)
            runs = [_runs(i) for i in inside]
            kept = [i for i, r in enumerate(runs) if r]
            spans = pa.array([[{"low": lo, "high": hi} for lo, hi in runs[i]] for i in kept], pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])))
            return pa.RecordBatch.from_arrays([pa.array([columns[j][i] for i in kept], pa.int64()) for j in (0, 1)] + [spans], ["a", "p", "runs"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= symbols and row[0] != held[-1][0]:
                    yield found()
                    held, size = [], 0
                held.append(row)
                size += len(row[5]) // 8 + 1
        if held:
            yield found()

    return run


_RUNS = T.ArrayType(T.StructType([T.StructField("low", T.IntegerType()), T.StructField("high", T.IntegerType())]))
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (_id, _text, found spans) with the maximal runs that they lose and the bytes that they keep."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for whole in batches:
        for lo in range(0, whole.num_rows, 500):
            batch = whole.slice(lo, 500)
            removed, kept, sizes = [], [], []
            for text, found in zip(batch.column("_text").to_pylist(), batch.column("found").to_pylist(), strict=True):
                raw, at, left, own = (text or "").encode("utf-8", "surrogatepass"), 0, [], []
                for s, e in sorted((f["start"], f["end"]) for f in found or ()):
                    if own and s <= own[-1]["end"]:
                        own[-1]["end"] = max(own[-1]["end"], e)
                    else:
                        own.append({"start": s, "end": e})
                for span in own:
                    left.append(raw[at : span["start"]])
                    at = span["end"]
                removed.append(own)
                kept.append(b"".join([*left, raw[at:]]))
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())], ["_id", "n_bytes", "removed", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, split: int = SPLIT, symbols: int = SYMBOLS) -> DataFrame:
    """``id_col, n_bytes, removed, kept`` of every row: its UTF-8 size, the maximal removed runs (start, end in bytes) and the bytes that are left.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in any row or the same one; strings never cross rows and are judged
    on the input. A null text is empty. Every row is a text of its own, so repeated rows remove each other, whatever their ids; null ids come back as
    null. An empty table gives no rows; other columns aren't read. ``length`` is a multiple of 8 up to 1,000 and ``gram`` shorter. ``split`` and
    ``symbols`` change the work's division, not the result.
    """
    if length % 8 or not 16 <= length <= 1000 or not 0 < gram < length:
        raise ValueError("length must be a multiple of 8 from 16 to 1000, and gram less")
    # names of their own, so that both uses of the dealt texts have one plan and share one shuffle
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    able = F.coalesce(F.octet_length("_text"), F.lit(0)) >= length
    keyed = rows.where(able).select(F.xxhash64("_id", "_text").alias("k1"), F.xxhash64("_text").alias("k2"), "_id", "_text")
    often = keyed.select("_text").mapInArrow(_dealt(length, gram, False), "a long").groupBy("a").agg(F.count("*").alias("c")).where("c > 1").select("a")
    often = cut(often)  # so that a frequent anchor's pieces can be split in the join
    pieces = keyed.select("k1", "k2", "_text").mapInArrow(_dealt(length, gram, True), "k1 long, k2 long, a long, p long, at long")
    shared = cut(pieces.join(often, "a"))
    unlike = shared.groupBy("a", "p").agg(F.count("*").alias("n"), F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("at").alias("at"))
    unlike = cut(unlike)
    large = cut(unlike.groupBy("a").agg(F.count("*").alias("c")).where(F.col("c") > split).select("a"))
    texts = keyed.repartition("k1", "k2")

    def wanted(needed: DataFrame, windows: bool, schema: str) -> DataFrame:
        need = needed.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "p", "n", "at")).alias("need"))
        return texts.join(need, ["k1", "k2"]).mapInArrow(_text_pieces(length, windows), schema)

    usual = unlike
    crowded = large.count() > 0
    if crowded:
        usual = unlike.join(large, "a", "left_anti")
    parts = wanted(usual, False, "a long, p long, n long, count int, place int, part binary")
    # the same text may have several rows with one key; one of them brings the piece
    found = parts.repartition("a").sortWithinPartitions("a", "p").mapInArrow(_searched(length, symbols), T.StructType([T.StructField("a", T.LongType()), T.StructField("p", T.LongType()), T.StructField("runs", _RUNS)]))
    if crowded:
        windows = wanted(unlike.join(large, "a", "left_semi"), True, "a long, p long, n long, o int, w1 long, w2 long")
        twice = windows.groupBy("w1", "w2").agg(F.sum("n").alias("m")).where("m > 1").select("w1", "w2")
        singles = windows.join(twice, ["w1", "w2"]).groupBy("a", "p").agg(F.collect_set(F.struct(F.col("o").alias("low"), (F.col("o") + 1).alias("high"))).alias("runs"))
        found = found.union(singles.select("a", "p", "runs"))
    start = F.shiftright("at", 20)
    spans = shared.join(found, ["a", "p"]).select("k1", "k2", F.explode(F.transform("runs", lambda r: F.struct((start + r["low"]).alias("start"), (start + r["high"] + (length - 1)).alias("end")))).alias("s"))
    lost = spans.groupBy("k1", "k2").agg(F.collect_set("s").alias("found"))
    long = texts.join(lost, ["k1", "k2"], "left").select("_id", "_text", "found")
    short = rows.where(~able).select("_id", "_text", F.lit(None).cast(_SPANS).alias("found"))
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("removed", _SPANS), T.StructField("kept", T.BinaryType())])
    return long.union(short).mapInArrow(_merged, schema).withColumnRenamed("_id", id_col)
