"""Hard negatives through candidate lists that the anchors of a cluster share, walked until no candidate left can matter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillroll.llm import vectors
from tillroll.llm.common import materialise, ship
from tillroll.llm.words import sorted_groups

_SLACK = 1e-9
_EXACT = 2.0**53


def centres_of(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Directions of up to `count` clusters of the sample's rows, by k-means on the sphere."""
    lengths = np.linalg.norm(sample, axis=1)
    units = sample[lengths > 0] / lengths[lengths > 0][:, None]
    if not len(units):
        return np.zeros((1, sample.shape[1]))
    centres = units[np.random.default_rng(len(units)).permutation(len(units))[:count]]
    for _ in range(rounds):
        nearest = (units @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, units)
        size = np.linalg.norm(total, axis=1)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], centres)
    return centres


class Cluster:
    """Anchors of one cluster: where they lie in the unit, their middle and their widest angle from it."""

    def __init__(self, places: np.ndarray, data: np.ndarray):
        self.places, self.lengths = places, np.linalg.norm(data, axis=1)
        units = data / np.maximum(self.lengths, 1e-300)[:, None]
        middle = units.sum(axis=0)
        self.middle = middle / max(np.linalg.norm(middle), 1e-300)
        cosines = np.clip(units @ self.middle, -1.0, 1.0)[self.lengths > 0]
        self.radius = float(np.arccos(cosines.min(initial=1.0)))

    def bounds(self, block: vectors.Block) -> np.ndarray:
        """For each candidate, what no inner product with an anchor of length one in the cluster can exceed.

        An anchor is at least the candidate's angle from the middle less the cluster's radius away from it.
        """
        lengths = np.linalg.norm(block.data, axis=1)
        cosines = np.clip(block.data @ self.middle / np.maximum(lengths, 1e-300), -1.0, 1.0)
        return lengths * (np.cos(np.maximum(np.arccos(cosines) - self.radius, 0.0)) + _SLACK)


def _products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles below 2^53, else as Python integers held to long."""
    bound = float(np.abs(anchors).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * anchors.shape[1]
    if bound < _EXACT:
        return (anchors @ candidates.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x.tolist()], dtype=object)
    return np.clip(whole(anchors) @ whole(candidates).T, -(2**62), 2**62).astype(np.int64)


class _Walk:
    """Lists of a unit's anchors: per anchor and limit the highest scores from `share` of the limit up to it.

    `limits` has a row for each anchor; without it an anchor has one list, of the rows with its own label. For each
    block of candidates a cluster sorts them once by its bound; its members walk that order together, and one leaves as soon as
    the next bound is below all that its lists still take.
    """

    def __init__(self, rows: list[dict], k: int, share: int, step: int):
        self.asked, self.share, self.step = vectors.opened(*rows), share, step
        limits = [np.frombuffer(r["limits"], np.int64).reshape(r["rows"], -1) for r in rows if r.get("limits") is not None]
        self.limits = np.concatenate(limits) if limits else None
        width = 1 if self.limits is None else self.limits.shape[1]
        self.width, self.lists = width, vectors.Lists(len(self.asked.ids) * width, k, np.int64)
        self.clusters, at = [], 0
        for r in rows:
            places = np.arange(at, at + r["rows"])
            self.clusters.append(Cluster(places, self.asked.data[places]))
            at += r["rows"]
        self.walked = 0

    def _floor(self, places: np.ndarray) -> np.ndarray:
        """The least score that may still enter any list of an anchor."""
        cuts = self.lists.cut.reshape(-1, self.width)[places].astype(np.float64)
        if self.limits is None:
            return cuts[:, 0]
        limits = self.limits[places].astype(np.float64)
        wanted = np.maximum(cuts, limits * (self.share / 100))
        # none: no such positive; below zero, `share` of the limit lies above it, and nothing is between
        return np.where(limits >= 0, wanted, np.inf).min(axis=1)

    def offer(self, block: vectors.Block) -> None:
        for cluster in self.clusters:
            bounds = cluster.bounds(block)
            order = np.argsort(-bounds, kind="stable")
            active = np.arange(len(cluster.places))
            for at in range(0, len(order), self.step):
                chunk = order[at : at + self.step]
                reach = cluster.lengths[active] * bounds[chunk[0]]
                active = active[reach + _SLACK * (1 + np.abs(reach)) >= self._floor(cluster.places[active])]
                if not len(active):
                    break
                self.walked += len(active) * len(chunk)
                self._meet(cluster.places[active], vectors.Block(block.ids[chunk], block.labels[chunk], block.data[chunk]))

    def _meet(self, places: np.ndarray, part: vectors.Block) -> None:
        scores = _products(self.asked.data[places], part.data)
        same = self.asked.labels[places][:, None] == part.labels[None, :]
        if self.limits is None:
            return self.lists.offer_tile(places, part.ids, scores, same & (self.asked.ids[places][:, None] != part.ids[None, :]))
        for j in range(self.width):
            limit = self.limits[places, j][:, None]
            # score >= share · limit / 100, by quotient and remainder so that no product leaves the range of long
            least = self.share * (limit // 100) - (-self.share * (limit % 100)) // 100
            self.lists.offer_tile(places * self.width + j, part.ids, scores, ~same & (limit >= 0) & (scores <= limit) & (scores >= least))
        return None


_SLOTS = pa.schema([(n, pa.int64()) for n in ("anchor_id", "slot", "unit", "vec_id", "score")])


class _Slots:
    """A walk whose lists come out by anchor and limit."""

    def __init__(self, rows: list[dict], *options):
        self.walk, self.unit = _Walk(rows, *options), rows[0]["c_part"] & 15

    def offer(self, block: vectors.Block) -> None:
        self.walk.offer(block)

    def columns(self) -> tuple:
        lists, width = self.walk.lists, self.walk.width
        return self.walk.asked.ids[lists.place // width], lists.place % width, np.full(len(lists.place), self.unit), lists.ids, lists.scores


_ASKED = "dim int, family long, cluster int, vec_id long, label long, data binary, limits binary"
_CLUSTERS = "dim int, family long, block long, rows int, ids binary, labels binary, data binary, limits binary"


def _names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]


def _whole(data: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(data * float(scale)), -1e300, 1e300)


def _sampled_centres(anchors: DataFrame, sample: int, cluster: int, most: int, scale: int) -> dict[int, np.ndarray]:
    """Centres by length of vector, from about `sample` anchors picked by the hash of their id; at most `most` a length."""
    n = anchors.count()
    kept = anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < min(1 << 30, (sample << 30) // max(1, n)))
    by_dim: dict[int, list] = {}
    for row in kept.select("vector").toLocalIterator():
        by_dim.setdefault(len(row.vector), []).append(row.vector)
    count = max(1, min(most, -(-n // cluster)))
    return {dim: centres_of(_whole(np.array(rows), scale), count) for dim, rows in by_dim.items()}


def _clusters(anchors: DataFrame, centres: dict[int, np.ndarray], members: int, scale: int) -> DataFrame:
    """Blocks of some `members` anchors of one cluster, length and family; anchors has vec_id, vector, family, label and limits."""

    def assigned(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for batch in stream:
            rows = batch.to_pydict()
            data = [_whole(np.array(v, np.float64), scale) for v in rows["vector"]]
            places = [int((centres[len(x)] @ x).argmax()) if len(x) in centres else 0 for x in data]
            limits = [np.array(x, np.int64).tobytes() for x in rows["limits"]]
            columns = [len(x) for x in data], rows["family"], places, rows["vec_id"], rows["label"], [x.tobytes() for x in data], limits
            yield pa.record_batch([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=_names(_ASKED))

    def blocked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
        home, made = TaskContext.get().partitionId() << 32, 0
        for group in sorted_groups(stream, 4):
            made += 1
            data, limits = (b"".join(group[c].to_pylist()) for c in ("data", "limits"))
            ids, labels = (group[c].to_numpy().astype(np.int64).tobytes() for c in ("vec_id", "label"))
            row = group["dim"][0].as_py(), group["family"][0].as_py(), home + made, len(group), ids, labels, data, limits
            yield pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=_names(_CLUSTERS))

    placed = materialise(anchors.select("vec_id", "vector", "family", "label", "limits").mapInArrow(assigned, _ASKED), "anchors")
    keys = ["dim", "family", "cluster"]
    parts = placed.groupBy(*keys).agg(F.ceil(F.count("*") / members).cast("int").alias("parts"))
    dealt = placed.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int"))
    dealt = dealt.select(*keys, "part", "vec_id", "label", "data", "limits").repartition(*keys, "part").sortWithinPartitions(*keys, "part")
    return materialise(dealt.mapInArrow(blocked, _CLUSTERS), "anchor-clusters")


def hard_negatives(
    table: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    share: int = 80,
    scale: int = 256,
    tile: int = 4096,
    members: int = 128,
    sample: int = 8192,
    most: int = 1024,
    step: int = 512,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `table` and `anchors` have vec_id, embedding and label (a whole number); a component x counts as floor(scale · x) and a
    row's score is its inner product with the anchor. An anchor's positives are its `positives` highest rows of its label,
    without its id. For each of them the `negatives` highest rows of other labels come, whose score is the positive's at
    most and `share` hundredths of it at least. Ties go to smaller ids.

    Anchors are clustered by k-means fitted on about `sample` of them, in blocks of some `members`. Per block of candidates
    a cluster sorts them once by an upper bound from the angle to its middle; its anchors walk that order and leave it once
    the bound proves that nothing further can enter their lists, so the result is exact.

    Null ids and labels, and vectors that are null, empty or hold null or non-finite components, take no part; vectors
    of zeros do. Rows meet rows of their own length. A repeated anchor id counts once, as its least (vector, label);
    repeated candidate rows are candidates each. A positive below zero has no negatives. Other columns are ignored; an
    empty table gives no rows.
    """
    ship(table.sparkSession)
    labelled = lambda t: t.filter("label IS NOT NULL").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    rows = vectors.usable(labelled(table), keep=["label"])
    asked = vectors.usable(labelled(anchors), keep=["label"]).groupBy("vec_id").agg(F.min(F.struct("vector", "label")).alias("row"))
    asked = materialise(asked.select("vec_id", "row.vector", "row.label"), "asked")
    centres = _sampled_centres(asked, sample, members, most, scale)
    whole = lambda data: _whole(data, scale)

    by_label = materialise(vectors.blocks(rows.withColumn("family", F.col("label")), tile, whole), "tiles")
    own = _clusters(asked.withColumns({"family": F.col("label"), "limits": F.array().cast("array<long>")}), centres, members, scale)
    dealt = vectors.units(by_label, own.drop("limits"))
    liked = materialise(vectors.best_of_units(dealt, lambda r: _Walk(r, positives, share, step), positives, "long"), "positives")

    listed = liked.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("list"))
    padding = F.array_repeat(F.lit(-1).cast("long"), positives)
    limits = listed.select(F.col("query_id").alias("vec_id"), F.slice(F.concat("list.score", padding), 1, positives).alias("limits"))
    limited = asked.join(limits, "vec_id").withColumn("family", F.lit(0).cast("long"))
    tiles = materialise(vectors.blocks(rows, tile, whole), "tiles")
    dealt = vectors.units(tiles, _clusters(limited, centres, members, scale))
    ddl = ", ".join(f"{name} long" for name in _SLOTS.names)
    found = vectors.search_units(dealt, lambda r: _Slots(r, negatives, share, step), _SLOTS, ddl)
    top = vectors.best(found, negatives, ("anchor_id", "slot")).withColumn("place", (F.col("slot") + 1).cast("int"))
    named = liked.select(
        F.col("query_id").alias("anchor_id"), F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return top.join(named, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
