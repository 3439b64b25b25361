"""Exact top-k search by tiled matrix products over whole-number vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillroll.llm import vectors
from tillroll.llm.common import materialise, ship

_EXACT = 2.0**53  # doubles hold every whole number up to here
_LONG = 2**63 - 1


def _scores(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Integer inner products as long. Doubles while every partial sum stays exact, else Python integers held to the range of long."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(tile).max(initial=0)) * queries.shape[1]
    if bound < _EXACT:
        return (queries @ tile.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x.tolist()], dtype=object)
    return np.clip(whole(queries) @ whole(tile).T, -_LONG - 1, _LONG).astype(np.int64)


class _Tiles:
    """The highest scores of a unit's queries over the tiles offered."""

    def __init__(self, rows: list[dict], k: int, step: int = 256):
        self.asked, self.step = vectors.opened(*rows), step
        self.lists = vectors.Lists(len(self.asked.ids), k, np.int64)

    def offer(self, tile: vectors.Block) -> None:
        for at in range(0, len(self.asked.ids), self.step):
            places = np.arange(at, min(at + self.step, len(self.asked.ids)))
            others = self.asked.ids[places][:, None] != tile.ids[None, :]
            self.lists.offer_tile(places, tile.ids, _scores(self.asked.data[places], tile.data), others)


def top_k(table: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, tile: int = 4096, query_block: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k highest integer inner products.

    `table` and `queries` have vec_id and embedding; a component x counts as floor(scale · x). A query meets every
    vector of its own length but those with its id; ties go to smaller ids. A task multiplies its queries with one tile
    after the other and keeps k for each query; the lists of all tasks then meet in a tree.

    Null ids, and vectors that are null, empty or hold null or non-finite components, take no part. A repeated query id
    counts once, as its smallest vector; repeated candidate rows are candidates each. Scores beyond long are held at its ends. An
    empty table gives no rows; other columns are ignored.
    """
    ship(table.sparkSession)
    whole = lambda x: np.clip(np.floor(x * float(scale)), -1e300, 1e300)
    asked = vectors.usable(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    tiles = materialise(vectors.blocks(vectors.usable(table), tile, whole), "tiles")
    query_blocks = materialise(vectors.blocks(asked, query_block, whole), "queries")
    return vectors.best_of_units(vectors.units(tiles, query_blocks), lambda rows: _Tiles(rows, k), k, "long")
