"""Blocks of vectors: how searches of stated queries against all rows are dealt out to tasks.

A block is one row with the ids and components of up to `rows` vectors of one length. A part of the candidates' blocks
and a part of the queries' are one unit of work with a key of its own: its task keeps the queries and streams the
candidates. The best of each unit meet in a tree: a few tasks per query first, then one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.common import materialise
from tillroll.operators.basket import small

_BLOCK = "dim int, family long, block long, rows int, ids binary, labels binary, data binary"
_ARROW = pa.schema(
    [("dim", pa.int32()), ("family", pa.int64()), ("block", pa.int64()), ("rows", pa.int32())] + [(n, pa.binary()) for n in ("ids", "labels", "data")]
)
_UNIT = ["dim", "family", "c_part", "q_part"]


def is_usable(vector: Column, zero: bool = True) -> Column:
    """Whether a vector is not null, not empty and of finite components only; with `zero` false, not of zeros alone either."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    good = (F.size(vector) > 0) & F.forall(vector, finite)
    return good if zero else good & F.exists(vector, lambda x: x != 0)


def usable(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", zero: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """(vec_id long, vector array<double>, *keep): rows with an id, a vector and finite components only.

    Empty vectors take no part; with `zero` false, vectors of zeros don't either.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"), *keep)
    return rows.filter(F.col("vec_id").isNotNull() & is_usable(F.col("vector"), zero))


def blocks(vectors: DataFrame, rows: int, change: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Blocks of about `rows` vectors of one length and family, made where the rows lie: no shuffle.

    `vectors` has vec_id, vector, and may have family (vectors of different families never meet) and label (carried
    along), both long. Block numbers are unique, not gapless. `change` is applied to the components.
    """

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, made, held = TaskContext.get().partitionId() << 32, 0, {}

        def out(kind: tuple[int, int]) -> pa.RecordBatch:
            nonlocal made
            ids, labels, data = (np.concatenate(x) for x in zip(*held.pop(kind), strict=True))
            data = change(data) if change else data
            made += 1
            row = [kind[0]], [kind[1]], [home + made], [len(ids)], [ids.tobytes()], [labels.tobytes()], [data.tobytes()]
            return pa.record_batch([pa.array(x, f.type) for x, f in zip(row, _ARROW, strict=True)], schema=_ARROW)

        for batch in stream:
            ids, families, labels = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2, 3))
            lists = batch.column(1)
            offsets, flat = np.asarray(lists.offsets), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            lengths = np.diff(offsets)
            for dim, family in np.unique(np.stack([lengths, families], axis=1), axis=0).tolist():
                at = np.flatnonzero((lengths == dim) & (families == family))
                data = flat[(offsets[at][:, None] + np.arange(dim)).ravel()].reshape(-1, dim)
                for k in range(0, len(at), rows):
                    part = held.setdefault((dim, family), [])
                    part.append((ids[at[k : k + rows]], labels[at[k : k + rows]], data[k : k + rows]))
                    if sum(len(x) for x, *_ in part) >= rows:
                        yield out((dim, family))
        for kind in list(held):
            yield out(kind)

    column = lambda name: F.col(name).cast("long") if name in vectors.columns else F.lit(0).cast("long").alias(name)
    return vectors.select("vec_id", "vector", column("family"), column("label")).mapInArrow(task, _BLOCK)


@dataclass
class Block:
    """Rows of one block as arrays."""

    ids: np.ndarray
    labels: np.ndarray
    data: np.ndarray


def opened(*rows: dict) -> Block:
    """The rows of one or more blocks together."""
    ids, labels = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in ("ids", "labels"))
    data = np.concatenate([np.frombuffer(r["data"], np.float64).reshape(-1, r["dim"]) for r in rows])
    return Block(ids, labels, data)


def units(candidates: DataFrame, queries: DataFrame, side: int = 65_536, least: int = 64) -> DataFrame:
    """Both tables of blocks dealt out so that each block of candidates meets each block of queries of its length and family once.

    A unit is a part of the candidates and a part of the queries, of about `side` rows each, its query blocks first. A
    candidate is copied once per `side` queries and a query once per `side` candidates, not once per block, and smaller tables
    are cut into `least` units so that all tasks have work. A unit's task keeps its queries and streams its candidates.
    """
    keys = ["dim", "family"]
    size = lambda t, name: t.groupBy(*keys).agg(F.sum("rows").alias(f"{name}_rows"), F.count("*").alias(f"{name}_blocks"))
    sizes = size(candidates, "c").join(size(queries, "q"), keys).withColumn("q_parts", F.ceil(F.col("q_rows") / side).cast("int"))
    c_parts = F.greatest(F.ceil(F.col("c_rows") / side), F.least("c_blocks", F.ceil(F.lit(least) / F.col("q_parts")))).cast("int")
    parts = small(materialise(sizes.select(*keys, c_parts.alias("c_parts"), "q_parts"), "unit-parts"))
    home = lambda n: F.pmod(F.xxhash64("block"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = queries.join(parts, keys).withColumn("q_part", home("q_parts")).withColumn("c_part", every("c_parts")).withColumn("kind", F.lit(0))
    held = candidates.join(parts, keys).withColumn("c_part", home("c_parts")).withColumn("q_part", every("q_parts")).withColumn("kind", F.lit(1))
    both = asked.drop("c_parts", "q_parts").unionByName(held.drop("c_parts", "q_parts"), allowMissingColumns=True)
    return both.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "kind", "block")


def search_units(dealt: DataFrame, search: Callable, schema: pa.Schema, ddl: str) -> DataFrame:
    """Per unit, the record batches of `search(query block rows)`: an object that is offered each candidate block and gives `columns()` at last.

    `columns()` are lists for the schema's fields.
    """

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, state = None, [], None

        def done() -> Iterator[pa.RecordBatch]:
            if state is not None:
                yield pa.record_batch([pa.array(x, f.type) for x, f in zip(state.columns(), schema, strict=True)], schema=schema)

        for batch in stream:
            for row in batch.to_pylist():
                unit = tuple(row[c] for c in _UNIT)
                if unit != now:
                    yield from done()
                    now, asked, state = unit, [], None
                if row["kind"] == 0:
                    asked.append(row)
                elif asked:
                    state = search(asked) if state is None else state
                    state.offer(opened(row))
        yield from done()

    return dealt.mapInArrow(task, ddl)


class Lists:
    """The `k` best (score, id) of each of `n` places so far: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int, kind: type = np.float64):
        self.n, self.k = n, k
        self.place, self.ids, self.scores = np.array([], np.int64), np.array([], np.int64), np.array([], kind)
        self.cut = np.full(n, -np.inf if kind is np.float64 else np.iinfo(kind).min)  # the k-th score of a full list

    def offer(self, place: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Entries below a place's cut may be left out beforehand."""
        if not len(place):
            return
        place, ids, scores = (np.concatenate(x) for x in ((self.place, place), (self.ids, ids), (self.scores, scores)))
        falling = -scores if scores.dtype == np.float64 else ~scores  # the least long has no negative
        order = np.lexsort((ids, falling, place))
        place, ids, scores = place[order], ids[order], scores[order]
        at = np.arange(len(place)) - np.searchsorted(place, place)
        self.cut[place[at == self.k - 1]] = scores[at == self.k - 1]
        first = at < self.k
        self.place, self.ids, self.scores = place[first], ids[first], scores[first]

    def offer_tile(self, places: np.ndarray, ids: np.ndarray, scores: np.ndarray, valid: np.ndarray) -> None:
        """A tile of scores, a row for each of `places` and a column for each id. Only what may enter a list is sorted."""
        least = -np.inf if scores.dtype == np.float64 else np.iinfo(scores.dtype).min
        scores = np.where(valid, scores, least)
        cut = self.cut[places]
        if scores.shape[1] > self.k:
            cut = np.maximum(cut, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k])
        i, j = np.nonzero((scores >= cut[:, None]) & valid)
        self.offer(places[i], ids[j], scores[i, j])


_FOUND = "query_id long, unit long, vec_id long, score {}"


def best_of_units(dealt: DataFrame, search: Callable, k: int, score: str) -> DataFrame:
    """`best` over what `search(query block rows)` objects find; their `lists` have a place for each row of `asked`."""
    schema = pa.schema([("query_id", pa.int64()), ("unit", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64() if score == "long" else pa.float64())])

    class Found:
        def __init__(self, rows: list[dict]):
            self.search, self.unit = search(rows), rows[0]["c_part"] & 15

        def offer(self, block: Block) -> None:
            self.search.offer(block)

        def columns(self) -> tuple:
            lists = self.search.lists
            return self.search.asked.ids[lists.place], np.full(len(lists.place), self.unit), lists.ids, lists.scores

    return best(search_units(dealt, Found, schema, _FOUND.format(score)), k)


def best(found: DataFrame, k: int, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """(*keys, rank, vec_id, score): per query the k highest scores, ties to smaller ids; merged as a tree."""
    order = [F.desc("score"), F.asc("vec_id")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    partial = found.withColumn("rank", rank(*keys, "unit")).filter(F.col("rank") <= k)
    top = partial.withColumn("rank", rank(*keys)).filter(F.col("rank") <= k)
    return top.select(*keys, F.col("rank").cast("int").alias("rank"), "vec_id", "score")
