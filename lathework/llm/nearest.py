"""Approximate nearest neighbours: stable projections under a kd-tree, verified until a chi-square test holds.

The top of the tree is fitted on a sample and parts projected space into cells, each with a tree of its own; a query
goes to its own cell first and then only to the cells near enough for what it has found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lathework.llm.runtime import arrow, prepare, stage_table

#: Dimensions of the projection; a search ends when a nearer vector would be projected within what is left with at
#: most 1 - SURE chance.
PROJECTED, SURE = 8, 0.99
#: Vectors of a kd-tree's leaf; least and most of a tree, with SOME_TREES of them in between; queries of one task.
LEAF, LEAST_TREE, TREE, SOME_TREES, QUERIES = 64, 1 << 12, 1 << 17, 64, 1 << 16
#: Vectors on which the cells are fitted, at most, by expectation, and how many of them a cell has at least.
SAMPLED, IN_CELL = 1 << 14, 32
#: Rows of a table of trees that may be broadcast; a larger one is joined by its key.
FEW_TREES = 1 << 17
#: Scores closer than this are compared again in a fixed order of summation.
TIE = 1e-9


def chi_square(x: np.ndarray, k: int = PROJECTED) -> np.ndarray:
    """Distribution function of the chi-square law with an even number of degrees."""
    half, term = x / 2, np.ones_like(x)
    total = term.copy()
    for i in range(1, k // 2):
        term = term * half / i
        total += term
    return np.where(np.isfinite(half), 1 - np.exp(-half) * total, 1.0)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def directions(dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, PROJECTED))


class Cells:
    """The top of the tree over vectors of one length: cells of projected space, halved at medians of a sample."""

    def __init__(self, vectors: np.ndarray, wanted: int, seed: int):
        self.axes = directions(vectors.shape[1], seed)
        low = unit(vectors) @ self.axes
        self.axis, self.value, self.child = [-1], [0.0], [(0, 0)]
        rows = {0: np.arange(len(low))}
        inner: set[int] = set()
        self.floor, self.roof = {0: np.full(PROJECTED, -np.inf)}, {0: np.full(PROJECTED, np.inf)}
        while len(rows) < wanted:
            free = [n for n in rows if n not in inner and len(rows[n]) >= 2 * IN_CELL]
            if not free:
                break
            node = max(free, key=lambda n: len(rows[n]))
            at = rows[node]
            axis = int(np.ptp(low[at], 0).argmax())
            cut = float(np.median(low[at, axis]))
            left = low[at, axis] < cut
            if not left.any() or left.all():
                inner.add(node)  # all alike: hashes part them further
                continue
            kids = len(self.axis), len(self.axis) + 1
            self.axis[node], self.value[node], self.child[node] = axis, cut, kids
            for kid, part in zip(kids, (at[left], at[~left]), strict=True):
                self.axis.append(-1)
                self.value.append(0.0)
                self.child.append((0, 0))
                rows[kid], self.floor[kid], self.roof[kid] = part, self.floor[node].copy(), self.roof[node].copy()
            self.roof[kids[0]][axis] = self.floor[kids[1]][axis] = cut
            del rows[node]
        self.leaves = np.array(sorted(rows))
        self.low_side, self.high_side = (np.stack([x[n] for n in self.leaves]) for x in (self.floor, self.roof))
        self.axis, self.value, self.child = np.array(self.axis), np.array(self.value), np.array(self.child)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Cell of each vector, from the root down."""
        low, node = unit(vectors) @ self.axes, np.zeros(len(vectors), np.int64)
        while (go := np.flatnonzero(self.axis[node] >= 0)).size:
            own = node[go]
            node[go] = self.child[own, (low[go, self.axis[own]] >= self.value[own]).astype(np.int64)]
        return np.searchsorted(self.leaves, node)

    def near(self, vectors: np.ndarray, worst: np.ndarray) -> list[np.ndarray]:
        """Cells in which something nearer than the ``worst`` cosine so far may be, but by 1 - SURE chance; all without one."""
        low = unit(vectors) @ self.axes
        gap = np.maximum(np.maximum(self.low_side[None] - low[:, None], low[:, None] - self.high_side[None]), 0)
        reach = np.maximum(2 - 2 * worst, 0)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            held = chi_square(np.where(reach > 0, (gap**2).sum(2) / reach, np.inf)) >= SURE
        held &= (gap > 0).any(2) & (worst > -2)[:, None]
        return [np.flatnonzero(~h) for h in held]


class Tree:
    """Leaves of a kd-tree over projected unit vectors, split at the median of the widest dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.raw = ids[order], vectors[order]
        self.unit = unit(self.raw)
        self.axes = directions(vectors.shape[1], seed)
        low = self.unit @ self.axes
        todo, self.leaves = [np.arange(len(ids))], []
        while todo:
            at = todo.pop()
            if len(at) <= LEAF:
                self.leaves.append(at)
                continue
            axis = np.ptp(low[at], 0).argmax()
            by = at[np.argsort(low[at, axis], kind="stable")]
            todo += [by[: len(by) // 2], by[len(by) // 2 :]]
        self.floor = np.stack([low[x].min(0) for x in self.leaves])
        self.roof = np.stack([low[x].max(0) for x in self.leaves])

    def search(self, ids: np.ndarray, raw: np.ndarray, k: int, worst: np.ndarray) -> list[list[tuple[float, int]]]:
        """For each query its ``k`` best (score, id) among this tree's vectors of other ids, best first, but none that is
        below the ``worst`` score that it has elsewhere."""
        q = unit(raw)
        low = q @ self.axes
        gap = np.maximum(np.maximum(self.floor[None] - low[:, None], low[:, None] - self.roof[None]), 0)
        bound = (gap**2).sum(2)
        order = np.argsort(bound, 1, kind="stable")
        bound = np.take_along_axis(bound, order, 1)
        n, m = order.shape
        found: list[list[np.ndarray]] = [[] for _ in range(n)]
        best = np.repeat(worst[:, None], k, 1)
        live, at, step = np.arange(n), 0, 2
        while len(live) and at < m:
            take = order[live, at : at + step]
            for leaf in np.unique(take):
                own = live[(take == leaf).any(1)]
                rows = self.leaves[leaf]
                score = q[own] @ self.unit[rows].T
                score[self.ids[rows][None] == ids[own][:, None]] = -2
                for i, s in zip(own, score, strict=True):
                    near = np.flatnonzero((s >= best[i, 0] - TIE) & (s > -2))
                    if len(near):
                        found[i].append(rows[near])
                        best[i] = np.sort(np.concatenate((best[i], s[near])))[-k:]
            at, step = at + step, step * 2
            if at >= m:
                break
            reach = np.maximum(2 - 2 * best[live, 0], 0)  # squared distance of the k-th best so far
            with np.errstate(divide="ignore", invalid="ignore"):
                sure = chi_square(np.where(reach > 0, bound[live, at] / reach, np.inf))
            live = live[~((best[live, 0] > -2) & (sure >= SURE) & (bound[live, at] > 0))]
        out = []
        for i in range(n):
            rows = np.unique(np.concatenate(found[i])) if found[i] else np.zeros(0, np.int64)
            rough = self.unit[rows] @ q[i]
            rows = rows[rough >= (np.sort(rough)[-k] if len(rows) > k else -2) - TIE]
            score = cosine(raw[i], self.raw[rows])
            by = np.lexsort((self.ids[rows], -score))[:k]
            out.append([(float(score[j]), int(self.ids[rows[j]])) for j in by])
        return out


def in_order(x: np.ndarray) -> np.ndarray:
    """Sums of the rows, each from its first item to its last."""
    return np.add.accumulate(x, 1)[:, -1]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of a vector and the rows of ``b`` in double precision; all sums run from the first component on."""
    return in_order(b * a) / (np.sqrt(in_order((a * a)[None])) * np.sqrt(in_order(b * b)))


def vectors_of(column: pa.Array) -> list[np.ndarray]:
    flat, at = column.flatten().to_numpy(zero_copy_only=False).astype(float), np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
    return [flat[i:j] for i, j in zip(at, at[1:], strict=False)]


def _placed(tops: dict[int, Cells]):
    """Adds the cell of each vector; vectors of a length that the sample doesn't have are in one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = vectors_of(batch.column(1))
            size, cell = np.array([len(x) for x in own], np.int64), np.zeros(len(own), np.int64)
            for n in np.unique(size):
                if n in tops:
                    rows = np.flatnonzero(size == n)
                    cell[rows] = tops[n].place(np.stack([own[i] for i in rows]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(size.astype(np.int32)), pa.array(cell.astype(np.int32))], ["vec_id", "v", "size", "cell"])

    return run


def _wider(tops: dict[int, Cells]):
    """The cells but its own that a query with its worst score so far goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, size, home = vectors_of(batch.column(1)), batch.column(2).to_numpy(), batch.column(3).to_numpy()
            worst = batch.column(4).to_numpy(zero_copy_only=False)
            to: list[np.ndarray] = [np.zeros(0, np.int64)] * len(own)
            for n in np.unique(size):
                rows = np.flatnonzero(size == n)
                if int(n) in tops:
                    for i, cells in zip(rows, tops[int(n)].near(np.stack([own[i] for i in rows]), worst[rows]), strict=True):
                        to[i] = cells[cells != home[i]]
            at = np.repeat(np.arange(len(own)), [len(t) for t in to])
            cells = pa.array(np.concatenate(to).astype(np.int32) if len(to) else np.zeros(0, np.int32))
            take = [batch.column(c).take(pa.array(at)) for c in (0, 1, 2, 4)]
            yield pa.RecordBatch.from_arrays([*take[:3], cells, take[3]], ["vec_id", "v", "size", "cell", "worst"])

    return run


def _search(k: int, seed: int):
    """Cells (tree, queries) in order; in a cell the tree's vectors (role 0) come before its queries (role 1)."""

    def answer(tree: Tree, held: list[tuple]) -> pa.RecordBatch:
        ids = np.array([h[0] for h in held], np.int64)
        got = tree.search(ids, np.stack([h[1] for h in held]), k, np.array([h[2] for h in held]))
        rows = [(int(q), s, v) for q, best in zip(ids, got, strict=True) for s, v in best]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.float64())], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, vectors, asked = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if vectors and asked:
                tree = Tree(np.array([v[0] for v in vectors], np.int64), np.stack([v[1] for v in vectors]), seed)
                for i in range(0, len(asked), 256):
                    yield answer(tree, asked[i : i + 256])

        for batch in batches:
            own = vectors_of(batch.column(4))
            for i, (tree, block, role, vec, worst) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 3, 5)), strict=True)):
                if (tree, block) != now:
                    yield from close()
                    now, vectors, asked = (tree, block), [], []
                (asked if role else vectors).append((vec, own[i], worst))
        yield from close()

    return run


def sized(df: DataFrame) -> DataFrame:
    """The frame as a table, to be broadcast if it has no more than FEW_TREES rows."""
    table = stage_table(df, "trees")
    return F.broadcast(table) if table.count() <= FEW_TREES else table


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, seed: int = 17, tree_rows: int | None = None) -> DataFrame:
    """The ``k`` vectors of largest cosine for each row whose id is divisible by ``every``, among all other rows.

    All vectors are placed in cells of projected space, fitted on SAMPLED of them; a cell of more than ``tree_rows``
    vectors (by default between LEAST_TREE and TREE) is dealt to several trees by a hash of the id, as many copies of a
    vector must be. A query is answered by the trees of its own cell, then by those of the cells for which the
    chi-square test doesn't hold at its k-th best score; its queries are dealt to blocks of QUERIES. Within a tree the
    leaves are verified whole in the order of their projected distance until the test holds. Returns ``query_id, rank,
    vec_id, score``; equal scores go to the smaller id.

    Vectors that are null, empty, zero or hold null or non-finite components, and null ids, take no part; vectors are
    compared with those of their own length only. Rows of the query's own id are no candidates; repeated rows of other
    ids count once. Other columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    plain = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & v.isNotNull() & sound)
    # equal ids are one candidate; the vector that sorts first stands for them
    plain = stage_table(plain.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    n = max(plain.count(), 1)
    most = tree_rows or min(TREE, max(LEAST_TREE, n // SOME_TREES))
    wanted = min(-(-n // most), SAMPLED // IN_CELL)
    tops: dict[int, Cells] = {}
    if wanted > 1:
        some: dict[int, list] = {}
        for r in plain.where(F.pmod(F.xxhash64("vec_id"), F.lit(-(-n // SAMPLED))) == 0).collect():
            some.setdefault(len(r.v), []).append(r.v)
        tops = {size: Cells(np.array(rows), max(1, wanted * len(rows) // sum(map(len, some.values()))), seed) for size, rows in some.items()}
    placed = stage_table(plain.transform(arrow, _placed(tops), "vec_id long, v array<double>, size int, cell int"), "placed")
    # trees of each cell, for as many cells as were wanted and lengths there are
    trees = sized(placed.groupBy("size", "cell").agg(F.ceil(F.count("*") / most).cast("int").alias("trees")))
    name = lambda i: F.concat_ws(":", "size", "cell", i)
    held = placed.join(trees, ["size", "cell"]).select(name(F.pmod(F.xxhash64("vec_id"), "trees")).alias("tree"), "vec_id", "v")
    asked = placed.where(F.col("vec_id") % every == 0)

    def answered(queries: DataFrame) -> DataFrame:
        """Best of the trees of each query's cell (vec_id, v, size, cell, worst)."""
        to = queries.join(trees, ["size", "cell"]).select(F.explode(F.transform(F.sequence(F.lit(0), F.col("trees") - 1), name)).alias("tree"), "vec_id", "v", "worst")
        to = stage_table(to, "asked")
        busy = sized(to.groupBy("tree").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks")))
        left = held.join(busy, "tree").select("tree", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("role"), "vec_id", "v", F.lit(-2.0).alias("worst"))
        right = to.join(busy, "tree").select("tree", F.pmod(F.xxhash64(F.col("vec_id") + 1), "blocks").cast("int").alias("block"), F.lit(1).alias("role"), "vec_id", "v", "worst")
        cells = left.unionByName(right).repartition("tree", "block").sortWithinPartitions("tree", "block", "role")
        found = cells.transform(arrow, _search(k, seed), "query_id long, vec_id long, score double")
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    own = answered(asked.withColumn("worst", F.lit(-2.0)))
    if tops:
        own = stage_table(own, "own")
        kth = own.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth"))
        so_far = asked.join(kth, "vec_id", "left").withColumn("worst", F.coalesce("kth", F.lit(-2.0))).select("vec_id", "v", "size", "cell", "worst")
        wide = answered(so_far.transform(arrow, _wider(tops), "vec_id long, v array<double>, size int, cell int, worst double"))
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        own = own.unionByName(wide).withColumn("rank", rank).where(F.col("rank") <= k)
    return own.select("query_id", "rank", "vec_id", "score")
