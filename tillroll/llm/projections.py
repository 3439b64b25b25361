"""Near-duplicate vectors through sorted projection passes, counted exactly within each group that the passes find."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm.common import materialise, ship
from tillroll.llm.near import components
from tillroll.llm.vectors import is_usable, usable
from tillroll.llm.words import sorted_groups
from tillroll.operators.basket import small

_BITS = 62  # random hashes in a key
_MARGIN = 1e-9


def passes_needed(vectors: int, window: int, similarity: float, recall: float) -> int:
    """Passes after which a pair at the threshold, alone among `vectors`, has met with probability `recall`.

    A pass brings it together where its leading hashes agree until no more than a window of vectors shares them. One
    hash agrees with probability 1 - angle / π, so the number grows with the logarithm of the vectors only in the exponent.
    """
    if vectors <= window:
        return 1
    bits = math.log2(vectors / window) + 1
    together = (1 - math.acos(similarity) / math.pi) ** bits
    return 1 if together >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - together))


def _units(data: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by their largest component first, so that no square overflows or vanishes."""
    data = data / np.abs(data).max(axis=1, keepdims=True)
    return data / np.sqrt(np.einsum("ij,ij->i", data, data))[:, None]


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _packed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components as bytes. Zeros lose their sign, so that equal vectors have equal bytes."""
    for batch in stream:
        lists = batch.column(2)
        offsets, flat = np.asarray(lists.offsets), lists.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        data = [flat[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        sizes = pa.array(np.diff(offsets).astype(np.int32))
        yield pa.record_batch([batch.column(0), batch.column(1), sizes, pa.array(data, pa.binary())], names=["vec_id", "label", "dim", "data"])


def _keys(stream: Iterator[pa.RecordBatch], passes: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Per pass, a vector's signs along random directions as one number whose order is their lexicographic order."""
    planes: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(_BITS - 1, -1, -1, dtype=np.int64)
    for batch in stream:
        dims = batch.column(2).to_numpy()
        for dim in np.unique(dims).tolist():
            if dim not in planes:
                planes = {dim: np.random.default_rng([seed, dim]).standard_normal((passes, dim, _BITS))}
            at = np.flatnonzero(dims == dim)
            rows = batch.take(pa.array(at))
            units = _units(_matrix(rows.column(3), dim))
            for p in range(passes):
                keys = (units @ planes[dim][p] > 0) @ weights
                places = pa.array(np.full(len(at), p, np.int32))
                yield pa.record_batch([places, rows.column(1), rows.column(2), pa.array(keys), rows.column(0)], names=["pass", "label", "dim", "key", "class"])


def _linked(stream: Iterator[pa.RecordBatch], window: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Per stretch of a sorted pass: edges that join what its neighbour windows link, one a vector at most."""
    for group in sorted_groups(stream, 4):
        n = len(group)
        units = _units(_matrix(group["data"], group["dim"][0].as_py()))
        ids = group["class"].to_numpy()
        root = np.arange(n)
        for a in range(0, n, window):
            rows, others = units[a : a + window], units[a : a + 2 * window]
            near = rows @ others.T >= similarity
            apart = np.arange(len(others))[None, :] - np.arange(len(rows))[:, None]
            near &= (apart > 0) & (apart <= window)
            for i in np.flatnonzero(near.any(axis=1)).tolist():
                for r in np.unique(root[a + np.flatnonzero(near[i])]).tolist():
                    if r != root[a + i]:
                        root[root == max(r, root[a + i])] = min(r, root[a + i])
        joined = np.flatnonzero(root != np.arange(n))
        if len(joined):
            yield pa.record_batch([pa.array(ids[joined]), pa.array(ids[root[joined]])], names=["a", "b"])


def _sums(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the unit vectors of each root in a batch."""
    for batch in stream:
        roots, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            units = _units(_matrix(batch.column(2).take(pa.array(at)), dim))
            found, place = np.unique(roots[at], return_inverse=True)
            total = np.zeros((len(found), dim))
            np.add.at(total, place, units)
            yield pa.record_batch([pa.array(found), pa.array([t.tobytes() for t in total], pa.binary())], names=["root", "total"])


def _centre(parts: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(t, np.float64) for t in parts["total"].to_pylist())
    length = np.sqrt(total @ total)
    centre = total / length if length > 0 else total
    return pa.table({"root": parts["root"][:1], "centre": pa.array([centre.tobytes()], pa.binary())})


def _core(stream: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Marks members within half the threshold's angle of their centre: by the triangle inequality these link with each other."""
    least = math.cos(math.acos(similarity) / 2) + _MARGIN
    for batch in stream:
        dims = batch.column(2).to_numpy()
        core = np.zeros(batch.num_rows, bool)
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            rows = batch.take(pa.array(at))
            core[at] = np.einsum("ij,ij->i", _units(_matrix(rows.column(3), dim)), _matrix(rows.column(5), dim)) >= least
        yield pa.record_batch([*batch.columns[:5], pa.array(core)], names=[*batch.schema.names[:5], "core"])


def _cells(stream: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Per cell of a group's grid: copies that its rim rows link with, and those that they add to core members."""
    for group in sorted_groups(stream, 3):
        rim = group["rim"].to_numpy(zero_copy_only=False)
        if rim.all() or not rim.any():
            continue
        units, ids, copies = _units(_matrix(group["data"], group["dim"][0].as_py())), group["class"].to_numpy(), group["copies"].to_numpy()
        core = group["core"].to_numpy(zero_copy_only=False)
        linked = (units[rim] @ units[~rim].T >= similarity) & (ids[rim][:, None] != ids[~rim][None, :])
        links = linked @ copies[~rim]
        added = (copies[rim] @ linked) * core[~rim]
        yield pa.record_batch([pa.array(np.concatenate([ids[rim], ids[~rim]])), pa.array(np.concatenate([links, added]))], names=["class", "links"])


def _ranked(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows with their exact `rank` per group of `by`, through one range sort.

    Rows are spread over tasks by ranges of (by, order), so neither a large group nor a run of equal values meets in
    one task as long as `order` is unique. The sorted rows are written out: counting and numbering must see the
    same ranges, also after a lost executor.
    """
    keys = [*by, *order]
    rows = df.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = materialise(rows.withColumn("position", F.monotonically_increasing_id()), "ranked")
    rows = rows.withColumn("range", F.shiftright("position", 33))
    ranges = rows.groupBy(*by, "range").agg(F.count("*").alias("held"), F.min("position").alias("first"))
    # One row per group and task: few whatever the number of rows.
    earlier = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(ranges.withColumn("offset", F.coalesce(F.sum("held").over(earlier), F.lit(0))), "range-offsets")
    ranked = rows.join(small(offsets), [*by, "range"])
    return ranked.select(*keys, (F.col("offset") + F.col("position") - F.col("first") + 1).alias("rank"))


def _edges(classes: DataFrame, largest: int, window: int, similarity: float, recall: float, seed: int) -> DataFrame:
    """(a, b): pairs of classes found, enough to connect all that the passes link."""
    passes = passes_needed(largest, window, similarity, recall)
    narrow = classes.select("class", "label", "dim", "data")
    keys = narrow.mapInArrow(lambda stream: _keys(stream, passes, seed), "pass int, label string, dim int, key long, class long")
    ranked = _ranked(keys, ["pass", "label", "dim"], ["key", "class"])
    step = 8 * window
    at = F.col("rank") - 1
    # The head of a stretch also ends the stretch before it, so every window lies whole in one of them.
    stretches = F.when(at % step < window, F.array(F.expr(f"(rank - 1) div {step}"), F.expr(f"(rank - 1) div {step} - 1"))).otherwise(F.array(F.expr(f"(rank - 1) div {step}")))
    dealt = ranked.select("pass", "label", "dim", "class", "rank", F.explode(stretches).alias("stretch")).filter("stretch >= 0")
    dealt = dealt.join(classes.select("class", "data"), "class").select("pass", "label", "dim", "stretch", "rank", "class", "data")
    place = ["pass", "label", "dim", "stretch"]
    dealt = dealt.repartition(*place).sortWithinPartitions(*place, "rank")
    return dealt.mapInArrow(lambda stream: _linked(stream, window, similarity), "a long, b long")


def _counted(members: DataFrame, similarity: float, block: int) -> DataFrame:
    """(class, links): copies of other classes of its group that each class links with, all pairs compared or proven."""
    partial = members.select("root", "dim", "data").mapInArrow(_sums, "root long, total binary")
    centres = partial.groupBy("root").applyInArrow(_centre, "root long, centre binary")
    columns = ["root", "class", "dim", "data", "copies"]
    marked = members.join(centres, "root").select(*columns, "centre")
    marked = materialise(marked.mapInArrow(lambda s: _core(s, similarity), "root long, class long, dim int, data binary, copies long, core boolean"), "members")
    outer = F.when(~F.col("core"), 1)
    sizes = marked.groupBy("root").agg(
        F.coalesce(F.sum(F.when(F.col("core"), F.col("copies"))), F.lit(0)).alias("inner"),
        F.ceil(F.count("*") / block).cast("int").alias("parts"),
        F.ceil(F.count(outer) / block).cast("int").alias("rims"),
    )
    proven = marked.filter("core").join(sizes, "root").select("class", (F.col("inner") - F.col("copies")).alias("links"))
    grid = marked.join(sizes.filter("rims > 0"), "root").withColumn("h", F.xxhash64("class"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rims = grid.filter("NOT core").withColumn("row", F.pmod("h", "rims").cast("int")).withColumn("part", every("parts")).withColumn("rim", F.lit(True))
    rest = grid.withColumn("part", F.pmod("h", "parts").cast("int")).withColumn("row", every("rims")).withColumn("rim", F.lit(False))
    place = ["root", "row", "part"]
    cells = rims.unionByName(rest).select(*place, "rim", "class", "dim", "data", "copies", "core")
    cells = cells.repartition(*place).sortWithinPartitions(*place)
    found = cells.mapInArrow(lambda s: _cells(s, similarity), "class long, links long")
    return proven.union(found).groupBy("class").agg(F.sum("links").alias("links"))


def near_vectors(
    table: DataFrame, similarity: float = 0.98, window: int = 512, recall: float = 0.9999, block: int = 1024, seed: int = 11
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): vectors of one label whose cosine reaches `similarity`.

    `table` has vec_id, embedding and label. Equal vectors of a label are one class. Each pass orders a label's classes
    by the signs along `_BITS` random directions of its own and compares each class with its `window` neighbours in that order; the
    number of passes follows from the largest label, so that a lone pair at the threshold meets with probability
    `recall`. What the passes link is joined to groups, and within a group all pairs are compared, in cells of about `block` × `block`, so a
    group denser than the window loses no link. Members close to the group's centre are linked by the triangle
    inequality and not compared.

    n_links counts the other rows linked directly, component_id is the smallest vec_id that links lead to, kept marks the
    rows with that id. Vectors that are null, empty, zero or hold null or non-finite components, and rows without
    a label, link with nothing; so do vectors of different lengths. Null ids take no part. Repeated rows and ids
    are rows each, and link where their vectors do. Other columns are ignored; an empty table gives no rows. No order plays a part, so there are no ties.
    """
    spark = table.sparkSession
    ship(spark)
    good = usable(table.filter("label IS NOT NULL"), zero=False, keep=["label"])
    packed = good.select("vec_id", F.col("label").cast("string").alias("label"), "vector").mapInArrow(_packed, "vec_id long, label string, dim int, data binary")
    rows = materialise(packed.withColumn("digest", F.md5("data")), "vectors")
    classes = rows.groupBy("label", "dim", "digest", "data").agg(F.min("vec_id").alias("head"), F.count("*").alias("copies"))
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    edges = _edges(classes, largest, window, similarity, recall, seed)
    groups = materialise(components(edges).withColumnsRenamed({"node": "class"}), "groups")
    leaders = groups.select("root").distinct().select("root", F.col("root").alias("class"))
    members = materialise(groups.select("root", "class").union(leaders).distinct().join(classes, "class"), "grouped")
    heads = members.groupBy("root").agg(F.min("head").alias("component"))
    known = members.select("class", "root").join(heads, "root").join(_counted(members, similarity, block), "class", "left")
    told = classes.drop("data").join(known, "class", "left").select(
        "label",
        "digest",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "head").alias("component_id"),
    )
    linked = rows.select("vec_id", "label", "digest").join(told, ["label", "digest"]).select("vec_id", "n_links", "component_id")
    rest = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label").filter("vec_id IS NOT NULL")
    usable_row = F.coalesce(F.col("label").isNotNull() & is_usable(F.col("embedding").cast("array<double>"), zero=False), F.lit(False))
    alone = rest.filter(~usable_row).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
