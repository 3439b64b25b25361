"""Nearest neighbours by inner product through vantage-point trees, one per shard."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillroll.llm import vectors
from tillroll.llm.common import materialise, ship

_LEAF = 256
_SLACK = 1e-9


def lowest(score: np.ndarray) -> np.ndarray:
    """What may still equal `score`, as sums in another order differ in their last digits."""
    return score - _SLACK * (1 + np.where(np.isfinite(score), np.abs(score), 0.0))


class Tree:
    """Vantage-point tree over the rows of one shard, with Euclidean distances.

    Inner products become distances by one more component: all rows are lifted onto a sphere of the longest row's
    radius, queries get a zero there, and the nearest lifted row is the one with the largest inner product.
    """

    def __init__(self, data: np.ndarray, leaf: int = _LEAF):
        squares = np.einsum("ij,ij->i", data, data)
        self.radius2 = float(squares.max(initial=0.0))
        self.data, self.leaf = data, leaf
        self.points = np.hstack([data, np.sqrt(np.maximum(self.radius2 - squares, 0.0))[:, None]])
        self.root = self._build(np.arange(len(data)), np.random.default_rng(len(data)))

    def _build(self, rows: np.ndarray, rng: np.random.Generator):
        if len(rows) <= self.leaf:
            return rows
        point = self.points[rows[rng.integers(len(rows))]]
        distance = np.linalg.norm(self.points[rows] - point, axis=1)
        border = np.median(distance)
        inner = distance <= border
        if inner.all():  # many equal distances
            inner = distance < border
        if inner.all() or not inner.any():
            return rows
        return point, float(border), self._build(rows[inner], rng), self._build(rows[~inner], rng)

    def search(self, ids: np.ndarray, own: np.ndarray, queries: np.ndarray, k: int, factor: float):
        """(query places, rows): each query's k nearest rows, and all found that tie with the k-th to rounding.

        A subtree is left out where the triangle inequality puts it beyond 1/factor of the distance to the query's
        k-th best so far. At factor one nothing nearer can lie there, so the search is exact.
        """
        n = len(queries)
        lifted = np.hstack([queries, np.zeros((n, 1))])
        norms = np.einsum("ij,ij->i", queries, queries)
        cut = np.full((n, k), -np.inf)  # the k best inner products so far, the smallest first
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def reach(active: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(norms[active] + self.radius2 - 2 * cut[active, 0], 0.0)) + _SLACK

        def visit(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                scores = queries[active] @ self.data[node].T
                scores[ids[node][None, :] == own[active][:, None]] = -np.inf
                i, j = np.nonzero((scores >= lowest(cut[active, 0])[:, None]) & (scores > -np.inf))
                found.append((active[i], node[j], scores[i, j]))
                both = np.hstack([cut[active], scores])
                cut[active] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)
                return
            point, border, inner, outer = node
            away = np.linalg.norm(lifted[active] - point, axis=1) - border
            near_in, near_out = active[away <= 0], active[away > 0]
            visit(inner, near_in)
            visit(outer, near_out)
            visit(outer, near_in[-away[away <= 0] <= reach(near_in) / factor])
            visit(inner, near_out[away[away > 0] <= reach(near_out) / factor])

        visit(self.root, np.arange(n))
        if not found:
            return np.array([], np.int64), np.array([], np.int64)
        place, row, score = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = score >= lowest(cut[place, 0])
        return place[keep], row[keep]


def in_order(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, components added from the first to the last."""
    total = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        total += queries[:, d] * rows[:, d]
    return total


class _Trees:
    """The nearest found for a unit's queries in the shards offered; each shard's tree is built once and asked in steps."""

    def __init__(self, rows: list[dict], k: int, factor: float, step: int):
        self.asked, self.k, self.factor, self.step = vectors.opened(*rows), k, factor, step
        self.lists = vectors.Lists(len(self.asked.ids), k)

    def offer(self, shard: vectors.Block) -> None:
        tree = Tree(shard.data)
        for at in range(0, len(self.asked.ids), self.step):
            ids, queries = self.asked.ids[at : at + self.step], self.asked.data[at : at + self.step]
            place, row = tree.search(shard.ids, ids, queries, self.k, self.factor)
            self.lists.offer(at + place, shard.ids[row], in_order(queries[place], shard.data[row]))


def nearest(
    table: DataFrame, queries: DataFrame, k: int = 20, factor: float = 1.0, shard: int = 16384, query_block: int = 1024
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query up to k candidates with the largest inner products.

    `table` and `queries` have vec_id and embedding. Rows are cut into shards of about `shard` vectors where they lie;
    a task builds the tree of each of its shards and asks it for its queries, up to 65,536 of them. With `factor` over one,
    subtrees are skipped earlier: faster, with less than full recall. A query meets every vector of its own
    length but those with its id. Scores are computed again on the original vectors in double precision.

    Null ids, and vectors that are null, empty, zero or hold null or non-finite components, take no part. A repeated
    query id counts once, as its smallest vector; repeated candidate rows are candidates each; ties go to smaller ids. An empty table
    gives no rows; other columns are ignored.
    """
    ship(table.sparkSession)

    asked = vectors.usable(queries, zero=False).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    shards = materialise(vectors.blocks(vectors.usable(table, zero=False), shard), "shards")
    query_blocks = materialise(vectors.blocks(asked, query_block), "queries")
    return vectors.best_of_units(vectors.units(shards, query_blocks), lambda rows: _Trees(rows, k, factor, query_block), k, "double")
