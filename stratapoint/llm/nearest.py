"""Approximate nearest neighbours by few stable projections.

Vectors are projected on PROJECTIONS random Gaussian directions. A squared distance between projections, divided by the
true one, has a chi-square distribution, so neighbours are visited in the order of their projected distance and verified
by their true one, until the next projected distance is so large that a point as near as the k-th found would have a
smaller one with probability CONFIDENCE. The projections lie in kd-trees: a top tree, fitted on a bounded sample, deals
all vectors to leaves; each block of a leaf has a tree of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stored

PROJECTIONS = 8
CONFIDENCE = 0.99
SAMPLE = 16_384  # rows that the top tree is fitted on
ROWS = 8192  # rows of a block
LEAVES = 4096  # of the top tree, at most
CELL = 64  # rows of a leaf of a block's own tree
QUERIES = 4096  # queries that meet a block at once

HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def chi_square(p: float, freedom: int) -> float:
    """Quantile for an even number of degrees of freedom."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        tail = math.exp(-mid / 2) * sum((mid / 2) ** i / math.factorial(i) for i in range(freedom // 2))
        low, high = (mid, high) if 1 - tail < p else (low, mid)
    return high


def directions(dim: int, m: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, m))


@dataclass
class Tree:
    """kd-tree of boxes: lo and hi corners of the cells, and order of the rows by cell (cells: where each starts)."""

    lo: np.ndarray
    hi: np.ndarray
    order: np.ndarray
    cells: np.ndarray
    splits: list[tuple[int, float, int, int]]  # axis, value, child below, child above; a child under 0 is the cell ~child

    @classmethod
    def build(cls, points: np.ndarray, size: int) -> Tree:
        """Halves the widest axis at its median until cells have at most size rows or equal points only."""
        m = points.shape[1]
        splits: list[tuple[int, float, int, int]] = []
        los, his, parts = [], [], []

        def grow(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> int:
            if len(rows) > size:
                p = points[rows]
                axis = int(np.ptp(p, axis=0).argmax())
                value = float(np.median(p[:, axis]))
                below = p[:, axis] < value
                if not below.any():
                    below = p[:, axis] <= value
                if 0 < below.sum() < len(rows):
                    value = float(p[~below, axis].min())
                    at = len(splits)
                    splits.append((axis, value, 0, 0))
                    mid_hi, mid_lo = hi.copy(), lo.copy()
                    mid_hi[axis] = mid_lo[axis] = value
                    left, right = grow(rows[below], lo, mid_hi), grow(rows[~below], mid_lo, hi)
                    splits[at] = (axis, value, left, right)
                    return at
            los.append(lo)
            his.append(hi)
            parts.append(rows)
            return ~(len(parts) - 1)

        grow(np.arange(len(points)), np.full(m, -np.inf), np.full(m, np.inf))
        return cls(np.array(los), np.array(his), np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts])), splits)

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64) if self.splits else np.full(len(points), -1)
        while (open_ := at >= 0).any():
            for node in np.unique(at[open_]):
                axis, value, left, right = self.splits[node]
                here = np.flatnonzero(at == node)
                at[here] = np.where(points[here, axis] < value, left, right)
        return ~at

    def gaps(self, points: np.ndarray) -> np.ndarray:
        """Least squared distance from each point to each cell."""
        out = np.zeros((len(points), len(self.lo)))
        for axis in range(points.shape[1]):
            p = points[:, axis : axis + 1]
            out += np.maximum(0, np.maximum(self.lo[:, axis] - p, p - self.hi[:, axis])) ** 2
        return out


def search(ids: np.ndarray, vectors: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the query, id and distance of up to k neighbours of each query in a block; limit: the quantile that stops."""
    if not len(ids) or not len(q_ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    matrix = directions(vectors.shape[1])
    tree = Tree.build(vectors @ matrix, CELL)
    ids, vectors = ids[tree.order], vectors[tree.order]
    out = []
    for start in range(0, len(q_ids), 256):
        own, some = q_ids[start : start + 256], queries[start : start + 256]
        gaps = tree.gaps(some @ matrix)
        order = np.argsort(gaps, axis=1, kind="stable")
        best = np.full((len(own), k), np.inf)
        best_id = np.full((len(own), k), np.iinfo(np.int64).max)
        alive = np.arange(len(own))
        for turn in range(order.shape[1]):
            cell = order[alive, turn]
            kth = np.minimum(best[alive, -1], bounds[start + alive])
            alive_now = gaps[alive, cell] <= kth**2 * limit
            alive, cell = alive[alive_now], cell[alive_now]
            if not len(alive):
                break
            for c in np.unique(cell):
                who = alive[cell == c]
                s = slice(tree.cells[c], tree.cells[c + 1])
                for a in range(s.start, s.stop, 1024):
                    z = slice(a, min(a + 1024, s.stop))
                    d = np.sqrt(((some[who, None, :] - vectors[None, z]) ** 2).sum(axis=2))
                    d[own[who, None] == ids[None, z]] = np.inf
                    near = np.concatenate([best[who], d], axis=1)
                    near_id = np.concatenate([best_id[who], np.broadcast_to(ids[z], d.shape)], axis=1)
                    pick = np.lexsort((near_id, near), axis=1)[:, :k]
                    best[who], best_id[who] = np.take_along_axis(near, pick, 1), np.take_along_axis(near_id, pick, 1)
        row, col = np.nonzero(np.isfinite(best))
        out.append((row + start, best_id[row, col], best[row, col]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (doubles), dim of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(fine).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.size(v).alias("dim"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return np.asarray(column.flatten(), np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def neighbours(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, its k nearest other rows.

    score is the Euclidean distance in double precision; ties go to the smaller id; with fewer than k candidates, all.
    Vectors that are null, zero, or hold null or non-finite components, and rows without id, take no part. Vectors of
    unlike length are no candidates for each other. Rows with the id of the query are its own. Every row is indexed; only the
    top tree is fitted on a sample. A query first meets the leaf it lies in, and then, with the bound found there, the
    leaves that the stopping test does not rule out. Leaves with many rows (as of equal vectors) are cut into blocks.
    """
    rows = stored(usable(vectors, id_col, vector_col), "vectors")
    dims = [r.dim for r in rows.groupBy("dim").count().orderBy("dim").collect()]
    parts = [_one_length(rows.where(F.col("dim") == d), d, every, k, chi_square(confidence, PROJECTIONS)) for d in dims]
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _one_length(rows: DataFrame, dim: int, every: int, k: int, limit: float) -> DataFrame:
    matrix = directions(dim)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()
    total = rows.count()
    points = np.array(sample["v"].tolist(), np.float64) @ matrix
    leaves = min(LEAVES, max(1, total // ROWS))
    top = Tree.build(points, max(1, math.ceil(len(points) / leaves)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = top.cell_of(_matrix(batch.column(1)) @ matrix) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf, pa.int32())], ["vec_id", "v", "leaf"])

    placed = stored(rows.select("vec_id", "v").mapInArrow(place, "vec_id long, v array<double>, leaf int"), "vectors-placed")
    is_query = F.col("vec_id") % every == 0
    sizes = {r.leaf: (r.n, r.q) for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("long")).alias("q")).collect()}
    n_leaves = len(top.lo)
    blocks = np.array([-(-sizes.get(c, (0, 0))[0] // (2 * ROWS)) for c in range(n_leaves)])
    group = np.cumsum([sizes.get(c, (0, 0))[1] for c in range(n_leaves)]) // QUERIES  # of queries near each other
    pointers = F.lit([int(b) for b in blocks])
    by_leaf = lambda values: F.element_at(F.lit([int(v) for v in values]), F.col("leaf") + 1)
    base = placed.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.greatest(F.element_at(pointers, F.col("leaf") + 1), F.lit(1))).cast("int"))
    sub = F.pmod(F.xxhash64("vec_id"), F.greatest(F.lit(1), F.ceil(by_leaf([sizes.get(c, (0, 0))[1] for c in range(n_leaves)]) / QUERIES))).cast("int")
    queries = placed.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("leaf"), (by_leaf(group) * 65536 + sub).cast("long").alias("part"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks that each query has to meet, given its bound (NaN: only its own leaf)."""
        for batch in batches:
            if not batch.num_rows:
                continue
            bound = batch.column(4).to_numpy(zero_copy_only=False)
            home = batch.column(2).to_numpy(zero_copy_only=False)
            gaps = top.gaps(_matrix(batch.column(1)) @ matrix)
            first = np.isnan(bound)
            must = np.where(first[:, None], np.arange(n_leaves)[None] == home[:, None], gaps <= np.where(first, 0, bound)[:, None] ** 2 * limit)
            row, leaf = np.nonzero(must)
            times = blocks[leaf]
            row, leaf = np.repeat(row, times), np.repeat(leaf, times)
            block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(batch.column(j).take(take) for j in (0, 1, 3, 4)), pa.array(leaf, pa.int32()), pa.array(block, pa.int32())], ["query_id", "q", "part", "bound", "leaf", "block"])

    def meet(mine: pa.Table, asks: pa.Table) -> pa.Table:
        if not mine.num_rows or not asks.num_rows:  # a side without rows comes without columns
            return HITS.empty_table()
        bound = asks["bound"].to_numpy()
        q, ids, score = search(mine["vec_id"].to_numpy(), _matrix(mine["v"]), asks["query_id"].to_numpy(), _matrix(asks["q"]), np.where(np.isnan(bound), np.inf, bound), k, limit)
        return pa.Table.from_arrays([pa.array(asks["query_id"].to_numpy()[q], pa.int64()), pa.array(ids, pa.int64()), pa.array(score, pa.float64())], schema=HITS)

    def found(asking: DataFrame) -> DataFrame:
        visits = stored(asking.select("query_id", "q", "leaf", "part", "bound").mapInArrow(visit, "query_id long, q array<double>, part long, bound double, leaf int, block int"), "visits")
        wanted = visits.select(F.col("leaf").alias("l"), F.col("block").alias("b"), F.col("part").alias("p")).distinct()
        sides = base.join(wanted, (F.col("leaf") == F.col("l")) & (F.col("block") == F.col("b"))).select("vec_id", "v", "leaf", "block", F.col("p").alias("part"))
        key = ["leaf", "block", "part"]
        hits = sides.groupBy(*key).cogroup(visits.groupBy(*key)).applyInArrow(meet, "query_id long, vec_id long, score double")
        best = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    at_home = found(queries.withColumn("bound", F.lit(float("nan"))))
    bounds = at_home.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("score")).alias("bound"))
    asking = queries.join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    return found(asking).select("query_id", "rank", "vec_id", "score")
