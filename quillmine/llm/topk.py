"""Exact top-k by inner product: a dual-tree search over cover trees of points and of queries.

A node of a cover tree has a centre and a covering radius. Its children's centres are further apart than the child level's radius, which is
half of the node's, and every row lies within that radius of its child's centre: levels follow the data, however many children that takes.
Children of one row each are kept together as the node's singles. For a query node (centre c, radius r) and a point node
(centre d, radius s) no inner product exceeds <c, d> + r |d| + s |c| + r s, so a pair is pruned when that is below the worst kth score
among the node's queries. Bounds of all children are one matrix product. A pair whose bound equals the worst kth score is searched, so
ties are settled by id. Scores are exact integers: doubles where every product fits them, else longs, else Python's integers.

Across tasks the same rule holds one level up. Points belong to small regions, each to the nearest of a bounded number of centres that are picked, far from one another,
from a sample; neighbouring regions make up a home of about a task's points, and a home that is too large is cut into blocks by a hash. A query is first searched in its
own home, which gives it a first kth score. Then the queries of a region, a group with a radius of its own, meet the regions of other homes as node pairs: where the
bound of group and region, or of the query and the region, is below the kth score, the pair is pruned; a query is sent only to homes of which a region is left. A task sorts a block's points before the queries
that come to it: it builds the points' tree once, then searches it for one block of queries after another, so it holds one of each. All blocks' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut

LEAF = 64
#: Rows of a block of queries, and of points.
QUERY_BLOCK, POINT_BLOCK = 1024, 16_384
#: Rows of a region, regions at most, and components of the sampled vectors that their centres are picked from.
REGION_ROWS, REGIONS, SAMPLE_VALUES = 512, 4096, 1 << 21
#: Rows of which the distances to all others are computed at once.
_AT_ONCE = 256
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


class CoverTree:
    """Nodes of a cover tree over the rows of ``x``: centre row, radius, children, singles (rows of a leaf, or children of one row)."""

    def __init__(self, x: np.ndarray):
        self.exact = x
        self.x = x.astype(np.float64)
        self.norm = np.sqrt((self.x * self.x).sum(1))
        self.top = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray] = []
        self.singles: list[np.ndarray] = []
        if len(x):
            rows = np.arange(len(x))
            self._build(0, rows, self._distances(rows[:1], rows)[0])

    def _distances(self, centres: np.ndarray, rows: np.ndarray) -> np.ndarray:
        a, b = self.x[centres], self.x[rows]
        return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0))

    def _error(self, rows: np.ndarray) -> float:
        """What rounding may take from a distance among ``rows``."""
        return 1e-6 * float(self.norm[rows].max()) + 1e-9

    def _covered(self, centre: int, rows: np.ndarray, level: float) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(centre, its rows, their distances): each row goes to the first centre within ``level``; others become centres in order."""
        found = []
        left = np.concatenate([[centre], rows[rows != centre]])
        while len(left):
            ahead = left[:_AT_ONCE]
            far = self._distances(ahead, left)
            free = np.ones(len(left), bool)
            for i in range(len(ahead)):
                if free[i]:
                    take = free & (far[i] <= level)
                    take[i] = True
                    found.append((int(ahead[i]), left[take], far[i][take]))
                    free &= ~take
            left = left[free]
        return found

    def _build(self, centre: int, rows: np.ndarray, distance: np.ndarray) -> int:
        node, radius = len(self.centre), float(distance.max())
        self.centre.append(centre)
        self.radius.append(radius + self._error(rows))
        self.children.append(rows[:0])
        self.singles.append(rows)
        if len(rows) <= LEAF or radius <= self._error(rows):
            return node
        parts = self._covered(centre, rows, radius / 2)
        self.singles[node] = np.array([h for h, r, _ in parts if len(r) == 1], np.int64)
        self.children[node] = np.array([self._build(h, r, d) for h, r, d in parts if len(r) > 1], np.int64)
        return node

    def products(self, rows: np.ndarray, other: CoverTree, cols: np.ndarray) -> np.ndarray:
        """Exact inner products of some rows with some of another tree's, as int64; what a long can't hold becomes its nearest."""
        dim = self.x.shape[1]
        if self.top * other.top * dim < 1 << 53:
            return (self.x[rows] @ other.x[cols].T).astype(np.int64)
        a, b = self.exact[rows], other.exact[cols]
        if self.top * other.top * dim <= _HIGH:
            return a @ b.T
        return np.clip(a.astype(object) @ b.astype(object).T, _LOW, _HIGH).astype(np.int64)


class Search:
    """The best ``k`` of ``points`` for each of ``queries``; points with the query's own id are left out. Both are sorted by id."""

    def __init__(self, queries: CoverTree, q_ids: np.ndarray, points: CoverTree, p_ids: np.ndarray, k: int, least: np.ndarray | None = None):
        """``least``: a score for each query that its kth best among all points is known to reach."""
        self.q, self.p, self.q_ids, self.p_ids, self.k = queries, points, q_ids, p_ids, k
        self.score = np.full((len(q_ids), k), _LOW, np.int64)
        self.ids = np.full((len(q_ids), k), _HIGH, np.int64)
        self.found = np.zeros((len(q_ids), k), bool)
        #: No score below this is among a query's best; the same as a double no larger.
        self.least, self.worst = np.full(len(q_ids), _LOW, np.int64), np.full(len(q_ids), -np.inf)
        self.pairs = 0
        if least is not None:
            self._raise(np.arange(len(q_ids)), least)
        if len(q_ids) and len(p_ids):
            self._begin()
            self._visit(0, np.zeros(1, np.int64))

    def _raise(self, rows: np.ndarray, least: np.ndarray) -> None:
        self.least[rows] = np.maximum(self.least[rows], least)
        self.worst[rows] = np.nextafter(self.least[rows].astype(np.float64), -np.inf)

    def _begin(self) -> None:
        """The kth score among the centres of the points' tree bounds a query's kth score from below."""
        centres = np.unique(self.p.centre)
        for lo in range(0, len(self.q_ids), _AT_ONCE):
            rows = np.arange(lo, min(lo + _AT_ONCE, len(self.q_ids)))
            found = self.q.products(rows, self.p, centres)
            found[self.p_ids[centres] == self.q_ids[rows][:, None]] = _LOW
            if len(centres) >= self.k:
                self._raise(rows, np.partition(found, -self.k, axis=1)[:, -self.k])

    def _bounds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """No inner product of the queries below node a[i] with points below node b[j] exceeds [i, j]."""
        c, d = np.array(self.q.centre)[a], np.array(self.p.centre)[b]
        r, s = np.array(self.q.radius)[a][:, None], np.array(self.p.radius)[b][None, :]
        rest = r * self.p.norm[d] + s * self.q.norm[c][:, None] + r * s
        size = self.q.norm[c][:, None] * self.p.norm[d]
        return self.q.x[c] @ self.p.x[d].T + rest + 1e-9 * (size + rest) + 1e-6

    def _rows(self, a: int) -> np.ndarray:
        """All queries below a node."""
        out, todo = [], [a]
        while todo:
            n = todo.pop()
            out.append(self.q.singles[n])
            todo += self.q.children[n].tolist()
        return np.concatenate(out)

    def _visit(self, a: int, b: np.ndarray) -> None:
        """Search the point nodes ``b`` for the queries below node ``a``: wider point nodes are opened first, then ``a`` is."""
        rows, leaf = self._rows(a), not len(self.q.children[a])
        radius, kept = np.array(self.p.radius), []
        while len(b):
            wide = radius[b] > self.q.radius[a] if not leaf else np.ones(len(b), bool)
            kept.append(b[~wide])
            self._singles(rows, b[wide])
            b = self._opened(b[wide])
            if len(b):
                b = b[self._bounds(np.array([a]), b)[0] >= self.worst[rows].min()]
        kept = np.concatenate(kept) if kept else b
        if not len(kept) or leaf:
            return
        own = self.q.singles[a]
        near = kept
        while len(own) and len(near):
            self._singles(own, near)
            near = self._opened(near)
            if len(near):
                near = near[(self._single_bounds(own, near) >= self.worst[own][:, None]).any(0)]
        for child in self.q.children[a].tolist():
            near = kept[self._bounds(np.array([child]), kept)[0] >= self.worst[self._rows(child)].min()]
            if len(near):
                self._visit(child, near)

    def _opened(self, b: np.ndarray) -> np.ndarray:
        return np.concatenate([self.p.children[n] for n in b]).astype(np.int64) if len(b) else b

    def _single_bounds(self, rows: np.ndarray, b: np.ndarray) -> np.ndarray:
        """No inner product of query rows[i] with points below node b[j] exceeds [i, j]."""
        d, s = np.array(self.p.centre)[b], np.array(self.p.radius)[b]
        norm = self.q.norm[rows][:, None]
        return self.q.x[rows] @ self.p.x[d].T + norm * s + 1e-9 * norm * (self.p.norm[d] + s) + 1e-6

    def _singles(self, rows: np.ndarray, b: np.ndarray) -> None:
        """Compare the singles of the point nodes ``b`` with those of the queries that they may serve, best bounds first."""
        b = b[[len(self.p.singles[n]) > 0 for n in b]] if len(b) else b
        if not len(b):
            return
        bound = self._single_bounds(rows, b)
        for j in np.argsort(-bound.max(0), kind="stable").tolist():
            able = rows[bound[:, j] >= self.worst[rows]]
            if len(able):
                self._compare(able, self.p.singles[b[j]])

    def _compare(self, rows: np.ndarray, cols: np.ndarray) -> None:
        """Exact scores of some queries with some points."""
        for lo in range(0, len(cols), 4096):
            self._best(rows, cols[lo : lo + 4096])

    def _best(self, rows: np.ndarray, cols: np.ndarray) -> None:
        self.pairs += len(rows) * len(cols)
        found = self.q.products(rows, self.p, cols)
        reached = found >= self.least[rows][:, None]
        some = reached.any(1)
        rows, found, reached = rows[some], found[some], reached[some]
        for r, row, ok in zip(rows.tolist(), found, reached, strict=True):
            at = np.flatnonzero(ok)
            if len(at) > 4 * self.k:  # by score alone first, with all ties of the kth
                least = np.partition(row[at], len(at) - self.k - 1)[len(at) - self.k - 1 :].min()
                at = at[row[at] >= least]
            ids = self.p_ids[cols[at]]
            at, ids = at[ids != self.q_ids[r]], ids[ids != self.q_ids[r]]
            have = self.found[r]
            score, every = np.r_[self.score[r][have], row[at]], np.r_[self.ids[r][have], ids]
            order = np.lexsort((every, ~score))[: self.k]
            n = len(order)
            self.score[r, :n], self.ids[r, :n], self.found[r, :n] = score[order], every[order], True
            if n == self.k:
                self._raise(np.array([r]), self.score[r, -1:])


def quantised(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component; null if the vector is null or holds a null or non-finite component."""
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(embedding.isNotNull() & ~bad, whole)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, ...], np.ndarray, np.ndarray, np.ndarray]]:
    """(pb, dim, kind, qb), ids, vectors and least scores of each run of rows that agree in the first four columns."""
    key, ids, vectors, least = None, [], [], []
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
        flat = batch.column(5).flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(keys[:, 1])
        edges = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, len(keys)]
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if hi == lo:
                continue
            now = tuple(keys[lo].tolist())
            if key is not None and now != key:
                yield key, np.concatenate(ids), np.concatenate(vectors), np.concatenate(least)
                ids, vectors, least = [], [], []
            key = now
            least.append(batch.column(6).slice(lo, hi - lo).to_numpy())
            ids.append(batch.column(4).slice(lo, hi - lo).to_numpy())
            vectors.append(flat[ends[lo] - now[1] : ends[hi - 1]].reshape(hi - lo, now[1]).astype(np.int64))
    if key is not None:
        yield key, np.concatenate(ids), np.concatenate(vectors), np.concatenate(least)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = p_ids = at = None
        for (pb, dim, kind, _), ids, vectors, least in _runs(batches):
            if not kind:
                tree, p_ids, at = CoverTree(vectors), ids, (pb, dim)
            elif at == (pb, dim):
                found = Search(CoverTree(vectors), ids, tree, p_ids, k, least)
                on = found.found
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, on.sum(1))), pa.array(found.ids[on]), pa.array(found.score[on])], ["query_id", "vec_id", "score"])

    return run


def far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows (fewer, if fewer are unlike), each the one that is furthest from those before it."""
    rows = x.astype(np.float64)
    best, picked = np.full(len(rows), np.inf), [0]
    for _ in range(min(n, len(rows)) - 1):
        best = np.minimum(best, ((rows - rows[picked[-1]]) ** 2).sum(1))
        if best.max() <= 0:
            break
        picked.append(int(best.argmax()))
    return x[picked]


def _centres(points: DataFrame, regions: int) -> dict[int, np.ndarray]:
    """By length of vectors, centres of regions, picked from a sample of a bounded size; lengths that the sample lacks have none."""
    widest = points.agg(F.max("dim")).first()[0]
    rows = points.select("v", "dim").orderBy(F.xxhash64("id", "v"), "id").limit(max(1, min(8 * regions, SAMPLE_VALUES // max(1, widest)))).collect()
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(r.dim, []).append(r.v)
    return {dim: far_apart(np.array(found, np.int64), max(1, round(regions * len(found) / len(rows)))) for dim, found in by_dim.items() if dim}


def _slack(norm: np.ndarray, other: np.ndarray) -> np.ndarray:
    """What rounding may take from a distance or a bound."""
    return 1e-6 * (norm + other) + 1e-9


def homes_of(centres: np.ndarray, n: int) -> np.ndarray:
    """For each centre the nearest of the first ``n``, which are the furthest apart."""
    c = centres.astype(np.float64)
    return ((c * c).sum(1)[:, None] + (c[:n] * c[:n]).sum(1) - 2 * (c @ c[:n].T)).argmin(1)


def _placed(centres: dict[int, np.ndarray], homes: dict[int, np.ndarray]):
    """Adds ``region``, the number of the nearest centre (-1: none), its ``home``, and ``far``, no less than the distance to the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
                vectors = batch.column(batch.schema.get_field_index("v"))
                region, home, far = np.full(len(dims), -1, np.int32), np.full(len(dims), -1, np.int32), np.zeros(len(dims))
                for dim in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == dim)
                    if dim in centres:
                        x = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)
                        c = centres[dim].astype(np.float64)
                        norm = np.sqrt((c * c).sum(1))
                        apart = (x * x).sum(1)[:, None] + norm**2 - 2 * (x @ c.T)
                        region[at] = apart.argmin(1)
                        home[at] = homes[dim][region[at]]
                        far[at] = np.sqrt(np.maximum(((x - c[region[at]]) ** 2).sum(1), 0)) + _slack(np.sqrt((x * x).sum(1)), norm[region[at]])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region), pa.array(home), pa.array(far)], [*batch.schema.names, "region", "home", "far"])

    return run


def reached(x: np.ndarray, least: np.ndarray, group: int, far: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Which regions (columns) may hold a point that scores ``least`` or more with each query of a group (rows), the group's own left out.

    ``group``: the region that the queries are of, at distances ``far`` from its centre; ``radius``: of each region, negative if it has no points.
    """
    x, c = x.astype(np.float64), centres.astype(np.float64)
    norm, size, low = np.sqrt((c * c).sum(1)), np.sqrt((x * x).sum(1)), np.nextafter(least.astype(np.float64), -np.inf)
    r = far.max()
    rest = r * norm + radius * norm[group] + r * radius
    pair = c @ c[group] + rest + 1e-9 * (norm * norm[group] + rest) + 1e-6
    near = (pair >= low.min()) & (radius >= 0)
    near[group] = False
    out = np.zeros((len(x), len(c)), bool)
    if near.any():
        rest = size[:, None] * radius[near]
        bound = x @ c[near].T + rest + 1e-9 * (size[:, None] * norm[near] + rest) + 1e-6
        out[:, near] = bound >= low[:, None]
    return out


def _sent(centres: dict[int, np.ndarray], homes: dict[int, np.ndarray], radius: dict[int, np.ndarray]):
    """Queries (columns as they are, with ``region``, ``far``, ``least``), a row for each other home that they must be searched in (``to``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            dims, regions = column["dim"].to_numpy(), column["region"].to_numpy()
            for dim, region in sorted(set(zip(dims.tolist(), regions.tolist(), strict=True))):
                if dim not in centres:
                    continue
                group = np.flatnonzero((dims == dim) & (regions == region))
                for lo in range(0, len(group), QUERY_BLOCK):
                    at = group[lo : lo + QUERY_BLOCK]
                    x = column["v"].take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                    near = reached(x, column["least"].to_numpy()[at], region, column["far"].to_numpy()[at], centres[dim], radius[dim])
                    wanted = np.zeros((len(at), homes[dim].max() + 1), bool)
                    pair = np.nonzero(near)
                    wanted[pair[0], homes[dim][pair[1]]] = True
                    wanted[:, homes[dim][region]] = False
                    row, to = np.nonzero(wanted)
                    for part in range(0, len(row), 4096):
                        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at[row[part : part + 4096]])) for c in batch.columns), pa.array(to[part : part + 4096].astype(np.int32))], [*batch.schema.names, "to"])

    return run


def top_k(points: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "v", repeats: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` points with the highest inner products for each query, ties to the smaller id.

    Both tables hold an id and a vector (array of long; null vectors take no part, nor do null ids). Only vectors of the query's length are
    compared; a point with the query's id is never its answer. Fewer than k candidates are all returned. Rows equal in id and
    vector count once, with ``repeats`` each by itself (on both sides); rows of ``queries`` with one id share its k ranks. A score that a
    long cannot hold is the nearest long. Empty tables give no rows; other columns aren't read.
    """

    def side(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<long>").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
        # of equal rows no more than k can be among the best k, so a copied row is no hot block
        return rows.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k if repeats else 1)).alias("n")).withColumn("dim", F.size("v"))

    points, queries = side(points), side(queries)
    n_points = points.agg(F.sum("n")).first()[0] or 0
    n_queries = queries.agg(F.sum("n")).first()[0] or 0
    tasks, groups = -(-n_points // POINT_BLOCK), max(1, -(-n_queries // QUERY_BLOCK))
    centres = _centres(points, min(REGIONS, -(-n_points // min(REGION_ROWS, POINT_BLOCK)))) if tasks > 1 else {}
    homes = {dim: homes_of(c, min(tasks, len(c))) for dim, c in centres.items()}
    kinds = "id long, v array<long>, n long, dim int"
    if centres:
        p, q = (cut(rows.mapInArrow(_placed(centres, homes), f"{kinds}, region int, home int, far double")) for rows in (points, queries))  # read three times
    else:
        p, q = (rows.withColumns({"region": F.lit(-1), "home": F.lit(-1), "far": F.lit(0.0)}) for rows in (points, queries))
    # a row for each region, REGIONS and one more for each length of vectors: how far it reaches, and how many points it has
    found = cut(p.groupBy("dim", "home", "region").agg(F.max("far").alias("far"), F.sum("n").alias("n")))
    sizes = found.groupBy("dim", "home").agg(F.ceil(F.sum("n") / POINT_BLOCK).cast("int").alias("blocks"))
    sizes = F.broadcast(sizes) if found.count() <= 1 << 18 else sizes

    def searched(p: DataFrame, q: DataFrame) -> DataFrame:
        """The best of each query (``home``: where it is sent, ``least``) in the blocks of a home. A block is named by home and number."""
        place = F.xxhash64("id", "v")
        p = p.join(sizes, ["dim", "home"]).withColumns({"block": F.pmod(place, F.col("blocks")).cast("int"), "kind": F.lit(0), "qb": F.lit(0), "least": F.lit(_LOW)})
        q = q.join(sizes, ["dim", "home"]).withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "kind": F.lit(1), "qb": F.pmod(place, F.lit(groups)).cast("int")})
        rows = [side_.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select((F.col("home") * F.lit(1 << 32) + F.col("block")).alias("pb"), "dim", "kind", "qb", "id", "v", "least") for side_ in (p, q)]
        cells = rows[0].unionByName(rows[1]).repartition("pb", "dim").sortWithinPartitions("pb", "dim", "kind", "qb", "id")
        return cells.mapInArrow(_search(k), "query_id long, vec_id long, score long")

    best = searched(p, q.withColumn("least", F.lit(_LOW)))
    if centres:
        # a query of a length without centres has been everywhere that it could go
        best = cut(best)
        radius = {dim: np.full(len(c), -1.0) for dim, c in centres.items()}
        for r in found.where("region >= 0").collect():
            radius[r.dim][r.region] = r.far
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        kth = best.withColumn("_n", place).where(F.col("_n") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
        again = q.join(kth, "id", "left").select("id", "v", "n", "dim", "region", "home", "far", F.coalesce("least", F.lit(_LOW)).alias("least"))
        sent = again.repartition("dim", "region").sortWithinPartitions("dim", "region").mapInArrow(_sent(centres, homes, radius), f"{kinds}, region int, home int, far double, least long, to int")
        best = best.union(searched(p, sent.withColumn("home", F.col("to"))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
