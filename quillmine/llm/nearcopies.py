"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, by SimHash and an exact check.

1. Texts with equal sets are one class and are never compared; a class has the SimHash of its set.
2. Candidates: two sets of similarity 0.8 differ in 9.7 of 64 bits on average, and in more than RADIUS = 22 once in 40,000 times. No choice of
   pieces of 64 bits covers such a radius, so classes meet by MinHash: BANDS bands of ROWS values, of which similar classes share one with
   probability 0.99995. The members of a bucket are compared bit-sliced at RADIUS as in ``simhash``; a bucket of more than BUCKET members is
   passed whole, as a star. Components of these links are the candidate groups: they only ever hold too much.
3. Check: the similarities in a group are exact, from the whole sets, which are shuffled once. A search from each class compares it with all
   classes that no search has reached, so a group of copies costs about one comparison a member. A large group is cut into
   chunks of bounded size with some of its members (LEADERS) in each; the components that this gives hold most of it. Those outside the largest are
   then compared with all others, chunk by chunk, so no link is lost and no task holds a whole large group. Where so many are outside (a group that
   boilerplate holds together) that this would copy a member more than FEW times, they meet the others by band instead: whoever is similar shares one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.lineage import cut, discard
from .simhash import FOLD, SLAB, majority, near_groups

WIDTH = 5
#: The least similarity, as a fraction.
LEAST = (4, 5)
BANDS, ROWS, RADIUS = 25, 5, 22
#: Members of a bucket that are compared; members, shingles of a chunk; members that stand in every chunk of a large group.
BUCKET, CHUNK, CHUNK_SHINGLES, LEADERS = 2048, 1024, 1 << 20, 8
#: Chunks of members outside a large group's main component, beyond which they meet the others by band: as many copies as a member has bands.
FEW = BANDS
#: Classes whose texts are asked for by a broadcast; 16 bytes each. More are joined by a shuffle.
BROADCAST_ROWS = 1 << 19
_FACTORS = np.random.default_rng(5).integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)
_STEP = 1 << 12


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; of all its words if they are fewer; none of an empty text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))] if words else [], np.uint64)
    found = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64))


def bands(found: np.ndarray) -> list[int]:
    """The signed hashes of the bands; none of an empty set."""
    if not len(found):
        return []
    low = np.full(len(_FACTORS), 0xFFFFFFFFFFFFFFFF, np.uint64)
    for lo in range(0, len(found), _STEP):
        np.minimum(low, (_FACTORS * found[lo : lo + _STEP]).min(1), out=low)
    keys = [xxhash.xxh64_intdigest(low[i * ROWS : (i + 1) * ROWS].tobytes(), i) for i in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """For each of some sets of hashes, the position of the first one that it reaches in links of similarity LEAST."""
    size = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(flat, np.cumsum(size)[:-1])
    mark = np.zeros(flat.max() + 1, bool)
    group, left = np.arange(len(sets)), np.arange(len(sets))
    while len(left):
        first, left = left[0], left[1:]
        queue = [first]
        flat = np.concatenate([own[i] for i in left]) if len(left) else flat[:0]
        while queue and len(left):
            i = queue.pop()
            mark[own[i]] = True
            both = np.add.reduceat(mark[flat], np.cumsum(size[left]) - size[left], dtype=np.int64)
            mark[own[i]] = False
            near = LEAST[1] * both >= LEAST[0] * (size[i] + size[left] - both)
            if near.any():
                group[left[near]] = first
                queue += left[near].tolist()
                left = left[~near]
                flat = np.concatenate([own[i] for i in left]) if len(left) else flat[:0]
    return group


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that the sets of a whole batch are never held at once."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches):
        sets = [shingles(t.as_py()) for t in batch.column(2)]
        n = len(sets)
        same = np.fromiter((xxhash.xxh64_intdigest(s.tobytes()) for s in sets), np.uint64, n).view(np.int64)
        fp = np.fromiter((majority((s[lo : lo + _STEP] for lo in range(0, len(s), _STEP)), len(s)) for s in sets), np.uint64, n).view(np.int64)
        cols = [batch.column(0), batch.column(1), pa.array(same), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp), pa.array([bands(s) for s in sets], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_hash", "same", "size", "fp", "bands"])


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches):
        found = pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), found], ["same", "found"])


def _edges(names: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
    on = np.flatnonzero(group != np.arange(len(group)))
    return pa.RecordBatch.from_arrays([pa.array(names[on]), pa.array(names[group[on]])], ["u", "v"])


def _bit_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of rows (band, same, fp) sorted by band; buckets are whole in a partition, and are compared many at a time."""

    def edges(band: np.ndarray, same: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.r_[True, band[1:] != band[:-1]]
        of = np.cumsum(first) - 1
        shared = np.bincount(of)[of] > 1
        band, same, fp, of = band[shared], same[shared], fp[shared], of[shared]
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else of
        lo = 0
        while lo < len(of):  # whole buckets, SLAB rows or more
            after = starts[np.searchsorted(starts, lo + SLAB) :]
            hi = int(after[0]) if len(after) else len(of)
            yield _edges(same[lo:hi], near_groups(fp[lo:hi].view(np.uint64), RADIUS, of[lo:hi]))
            lo = hi

    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        held = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
        tail = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last bucket may go on
        yield from edges(*(h[:tail] for h in held))
        held = [h[tail:] for h in held]
    yield from edges(*held)


def _set_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of rows (root, i, j, same, found) sorted by the first three; such a cell is whole in a partition, and may name a class twice."""

    def edges() -> pa.RecordBatch:
        names = list(cell)
        return _edges(np.array(names, np.int64), linked([cell[x] for x in names]))

    now, cell = None, {}
    for batch in _sliced(batches):
        for *key, name, found in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if key != now:
                if len(cell) > 1:
                    yield edges()
                now, cell = key, {}
            cell[name] = np.frombuffer(found, np.uint64)
    if len(cell) > 1:
        yield edges()


def _celled(rows: DataFrame, run: Callable) -> DataFrame:
    cells = rows.select("root", "i", "j", "same", "found").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return cells.mapInArrow(run, "u long, v long")


def candidates(classes: DataFrame) -> DataFrame:
    """``node, root``: the candidate groups of more than one of ``classes`` (same, fp, bands)."""
    dealt = classes.select("same", "fp", F.explode("bands").alias("band"))
    large = dealt.groupBy("band").agg(F.count("*").alias("n"), F.min("same").alias("first")).where(F.col("n") > BUCKET).select("band", "first")
    marked = dealt.join(large, "band", "left")
    stars = marked.where(F.col("first").isNotNull()).select(F.col("same").alias("u"), F.col("first").alias("v"))
    small = marked.where(F.col("first").isNull()).select("band", "same", "fp").repartition("band").sortWithinPartitions("band")
    return components(small.mapInArrow(_bit_links, "u long, v long").union(stars))


def _number(same: Column, n: Column | int, seed: int) -> Column:
    return F.pmod(F.xxhash64(same, F.lit(seed)), n if isinstance(n, Column) else F.lit(n)).cast("int")


def _chunks(rows: Column, shingles_: Column) -> Column:
    return F.greatest(F.ceil(rows / CHUNK), F.ceil(shingles_ / CHUNK_SHINGLES), F.lit(1)).cast("int")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, component`` of every row; component is alike for all that links of similarity LEAST join.

    Nulls and empty texts are one component. Repeated rows stay. Null ids are kept. An empty table gives no rows. Other columns of ``docs`` are
    not read.
    """
    text = F.col(text_col)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    base = cut(read.mapInArrow(_sketched, "doc_id long, text_hash long, same long, size long, fp long, bands array<long>"))
    classes = base.groupBy("same").agg(F.min("fp").alias("fp"), F.first("bands").alias("bands"))
    groups = candidates(classes)
    of = base.groupBy("same").agg(F.min("text_hash").alias("text_hash"), F.min("size").alias("size"))
    found = groups.select(F.col("node").alias("same"), "root")
    members = cut(found.union(groups.select("root", "root").distinct()).join(of, "same").distinct())

    asked = members.select("text_hash", "same")
    asked = F.broadcast(asked) if members.count() <= BROADCAST_ROWS else asked
    texts = read.select("text_hash", "text").join(asked, "text_hash").select("same", "text")
    sets = texts.groupBy("same").agg(F.first("text").alias("text")).mapInArrow(_whole_sets, "same long, found binary")
    sizes = members.groupBy("root").agg(_chunks(F.count("*"), F.sum("size")).alias("chunks"))
    rows = cut(members.select("root", "same").join(sizes, "root").join(sets, "same"))

    own = rows.select("root", F.lit(0).alias("i"), _number(F.col("same"), F.col("chunks"), 1).alias("j"), "same", "found")
    links = _celled(own.union(_led(rows)), _set_links)
    big = rows.where("chunks > 1")
    if not big.isEmpty():
        links = cut(links)
        links = links.union(_rest(big, components(links), classes.select("same", "bands")))
    roots = components(links)
    for done in (members, rows):
        discard(done)
    return _named(base, roots)


def _led(rows: DataFrame) -> DataFrame:
    """The leaders of each group in chunks, for every chunk."""
    lead = F.struct(F.xxhash64("same", F.lit(2)).alias("h"), F.col("same").alias("leader"))
    leaders = rows.where("chunks > 1").groupBy(F.col("root"), _number(F.col("same"), LEADERS, 3).alias("turn")).agg(F.min(lead).alias("l")).select("l.leader")
    return rows.where("chunks > 1").join(leaders, rows["same"] == leaders["leader"], "left_semi").select(
        "root", F.lit(0).alias("i"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"), "same", "found"
    )


def _rest(big: DataFrame, roots: DataFrame, bands_of: DataFrame) -> DataFrame:
    """Links that the chunks of large groups lack: those of the members outside a group's largest component, to all members.

    A few chunks of such members are compared with all chunks of the group. Of more, each meets the members of its bands alone (``bands_of``:
    same, bands), which no similar one is missing from but with the chance that the candidates have; a band of many members is cut into chunks too.
    """
    named = big.join(roots, big["same"] == roots["node"], "left").select(big["root"], "same", "chunks", "found", F.coalesce(roots["root"], "same").alias("part"))
    parts = named.groupBy("root", "part").agg(F.count("*").alias("n"))
    main = parts.groupBy("root").agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    named = cut(named.join(main, "root").select("root", "same", "chunks", "found", (F.col("part") != F.col("main")).alias("outside")))
    counts = cut(named.where("outside").groupBy("root").agg(_chunks(F.count("*"), F.sum(F.octet_length("found") / 8)).alias("rests")))
    few, many = counts.where(F.col("rests") <= FEW), counts.where(F.col("rests") > FEW)
    links = _crossed(named.join(few, "root"), ["root"])
    if not many.isEmpty():
        dealt = named.join(many.select("root"), "root").join(bands_of, "same").select("root", F.explode("bands").alias("band"), "same", "outside", F.octet_length("found").alias("size"))
        cells = dealt.groupBy("root", "band").agg(F.count("*").alias("n"), _chunks(F.count("*"), F.sum(F.col("size") / 8)).alias("chunks"), _chunks(F.count_if("outside"), F.sum(F.when(F.col("outside"), F.col("size")).otherwise(0) / 8)).alias("rests"), F.max("outside").alias("any"))
        cells = cells.where("any AND n > 1").select("root", "band", "chunks", "rests")
        within = dealt.select("root", "band", "same", "outside").join(cells, ["root", "band"]).join(named.select("root", "same", "found"), ["root", "same"])
        links = links.union(_crossed(within, ["root", "band"]))
    return links


def _crossed(rows: DataFrame, cell: list[str]) -> DataFrame:
    """Links between the ``outside`` rows of each cell, in ``rests`` chunks, and all its rows, in ``chunks``."""
    place = F.xxhash64(*cell) if len(cell) > 1 else F.col(cell[0])  # cells that share a number are compared together, which does no harm
    i, j = _number(F.col("same"), F.col("rests"), 4), _number(F.col("same"), F.col("chunks"), 1)
    a = rows.where("outside").select(place.alias("root"), i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"), "same", "found")
    b = rows.select(place.alias("root"), F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("i"), j.alias("j"), "same", "found")
    return _celled(a.union(b), _set_links)


def _named(base: DataFrame, roots: DataFrame) -> DataFrame:
    found = base.join(roots, base["same"] == roots["node"], "left")
    return found.select("doc_id", "text_hash", F.coalesce("root", "same").alias("component"))
