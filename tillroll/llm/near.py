"""Similarity join of documents on word shingles through MinHash banding, with exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import batches, materialise, ship
from tillroll.llm.words import mixed, run_hashes, sorted_groups, word_hashes

_SKETCH = "doc_id long, text_hash long, key binary, shingles long, prefixes array<long>"
_SOLID = 1 << 22  # cells of an incidence tile


def prefix_length(longest: int, trees: int, similarity: float, recall: float) -> int:
    """Signature values that two documents must share in a tree, a band of the signature. It depends on the parameters alone.

    Starts from the longest prefix and shortens it until a pair at the threshold meets in one tree at least with
    probability `recall`; more similar pairs meet with a higher one.
    """
    for length in range(longest, 1, -1):
        if 1 - (1 - similarity**length) ** trees >= recall:
            return length
    return 1


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; a text of fewer words than `size` is one shingle, one without words none."""
    words, counts = word_hashes(texts)
    runs, out, at = run_hashes(words, size), [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(runs[at : at + n - size + 1]))
        else:
            out.append(run_hashes(words[at : at + n], n) ^ np.uint64(n) if n else np.array([], np.uint64))
        at += n
    return out


def _sketch(stream: Iterator[pa.RecordBatch], size: int, trees: int, length: int) -> Iterator[pa.RecordBatch]:
    """A key for the set of shingles, and per tree the hash of the first `length` signature values."""
    rng = np.random.default_rng(1)
    factors = rng.integers(0, 2**64, (trees * length, 2), dtype=np.uint64) | np.uint64(1)
    for batch in stream:
        texts = [t or "" for t in batch.column(2).to_pylist()]
        for a, b in batches([len(t) for t in texts], 2_000_000):
            sets = shingle_sets(texts[a:b], size)
            some = [i for i, s in enumerate(sets) if len(s)]
            if not some:
                continue
            sizes = np.array([len(sets[i]) for i in some])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            flat = np.concatenate([sets[i] for i in some])
            signature = np.stack([np.minimum.reduceat(flat * m + c, starts) for m, c in factors], axis=1)
            levels = signature.reshape(len(some), trees, length)
            prefixes = np.zeros((len(some), trees), np.uint64)
            for i in range(length):
                prefixes = mixed(prefixes + levels[:, :, i])
            ones, twos = (np.add.reduceat(mixed(flat ^ np.uint64(s)), starts) for s in (0, 0x5851F42D4C957F2D))
            keys = np.stack([ones, twos], axis=1).tobytes()
            rows = batch.slice(a, b - a).take(pa.array(some))
            yield pa.record_batch(
                [
                    rows.column(0),
                    rows.column(1),
                    pa.array([keys[16 * i : 16 * i + 16] for i in range(len(some))], pa.binary()),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(np.arange(0, prefixes.size + 1, trees, dtype=np.int32), prefixes.view(np.int64).ravel()),
                ],
                names=["doc_id", "text_hash", "key", "shingles", "prefixes"],
            )


def _new_pairs(prefixes: np.ndarray, tree: int, parts: np.ndarray, crossing: bool) -> np.ndarray:
    """Upper triangle of the pairs that share tree `tree` and none before; in a crossing block, of unequal parts only."""
    new = np.triu(np.ones((len(prefixes), len(prefixes)), bool), 1)
    if crossing:
        new &= parts[:, None] != parts[None, :]
    for t in range(tree):
        new &= prefixes[:, None, t] != prefixes[None, :, t]
    return new


def _prefix_matrix(group: pa.Table) -> np.ndarray:
    lists = group["prefixes"].combine_chunks()
    return lists.flatten().to_numpy().reshape(len(group), -1)


def _block_pairs(group: pa.Table) -> np.ndarray:
    tree, low, high = (group[c][0].as_py() for c in ("tree", "low", "high"))
    return _new_pairs(_prefix_matrix(group), tree, group["part"].to_numpy(), low != high)


def _useful(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of blocks that have a pair to verify there."""
    held, rows = [], 0
    for group in sorted_groups(stream, 4):
        if len(group) < 2:
            continue
        new = _block_pairs(group)
        use = np.flatnonzero(new.any(axis=0) | new.any(axis=1))
        if len(use):
            held.append(group.take(pa.array(use)))
            rows += len(use)
        if rows > 5000:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def _overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Shared shingles of each marked pair, as a matrix."""
    n = len(sets)
    shared = np.zeros((n, n), np.float32)
    if pairs.sum() < 4 * n:
        for i, j in np.argwhere(pairs).tolist():
            shared[i, j] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return shared
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = max(1, _SOLID // n)
    cuts = np.searchsorted(column, np.arange(0, column[-1] + 1, width))
    for at, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(column)], strict=True)):
        tile = np.zeros((n, width), np.float32)
        tile[owner[a:b], column[a:b] - at * width] = 1
        shared += tile @ tile.T
    return shared


def _verify(stream: Iterator[pa.RecordBatch], size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Per block: each member's linked documents, and edges that keep the block's linked members together."""
    schema = pa.schema([("key", pa.binary()), ("other", pa.binary()), ("links", pa.int64())])
    for group in sorted_groups(stream, 4):
        if len(group) < 2:
            continue
        pairs = _block_pairs(group)
        sets = shingle_sets(group["text"].to_pylist(), size)
        counts = np.array([len(s) for s in sets], np.float64)
        shared = _overlaps(sets, pairs).astype(np.float64)
        union = counts[:, None] + counts[None, :] - shared
        # whole numbers: no pair at the threshold is lost to rounding
        linked = pairs & (np.round(shared * 1_000_000) >= round(similarity * 1_000_000) * union)
        if not linked.any():
            continue
        linked |= linked.T
        weights = linked @ group["copies"].to_numpy().astype(np.int64)
        keys = group["key"].to_pylist()
        root, out = np.full(len(keys), -1), []
        for start in range(len(keys)):
            if root[start] < 0 and linked[start].any():
                reached = front = np.arange(len(keys)) == start
                while front.any():
                    front = linked[front].any(axis=0) & ~reached
                    reached = reached | front
                root[reached] = start
                out += [(keys[i], keys[start], 0) for i in np.flatnonzero(reached).tolist() if i != start]
        out += [(keys[i], None, int(weights[i])) for i in np.flatnonzero(weights).tolist()]
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of `edges` (a, b) is joined to, by large-star and small-star rounds.

    Each round hands a node's neighbours to the smallest among them, in joins on the node; stars of any size stay
    rows. Ends when a round changes nothing.
    """
    least = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
    edges = materialise(edges.filter("a != b").select(*least).distinct(), "edges")
    state = None
    while True:
        both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).union(edges.select("high", "low"))
        lows = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lows, "u").filter("v > u").select(F.col("m").alias("low"), F.col("v").alias("high")).distinct()
        lows = large.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
        small = large.join(lows, large["high"] == lows["u"]).select(F.col("m").alias("low"), F.when(F.col("low") == F.col("m"), F.col("high")).otherwise(F.col("low")).alias("high"))
        edges = materialise(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
        state = now


def near_join(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, trees: int = 16, longest: int = 6, recall: float = 0.9999, block: int = 512
) -> DataFrame:
    """One row per document: (doc_id, text_hash, class_id, class_size, n_links, group_id, first).

    A class is the documents with equal sets of `shingle`-word shingles, named by its smallest doc_id. n_links counts
    the other documents whose Jaccard similarity reaches `similarity`, all copies included; group_id is the smallest
    doc_id that links lead to. `first` marks the row that stands for its group, the least by (doc_id, text_hash);
    rows that repeat it whole are marked with it.

    Signatures lie in `trees` prefix tries; two classes meet where they share a prefix, which is shortened until the
    expected recall at the threshold reaches `recall`. Every meeting pair is verified on whole texts, in the first tree
    where it meets. A trie node with many classes is dealt out as a grid of blocks of about `block` members, which return
    counts and spanning edges, never their pairs.

    Texts without words (null, empty) are classes of one document each without links. Null doc_ids take no part, other
    columns are ignored, an empty table gives no rows. Repeated ids and rows are documents each.
    """
    ship(docs.sparkSession)
    length = prefix_length(longest, trees, similarity, recall)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    named = named.filter("doc_id IS NOT NULL")
    sketches = materialise(named.mapInArrow(partial(_sketch, size=shingle, trees=trees, length=length), _SKETCH), "sketches")
    classes = sketches.groupBy("key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("head"), F.count("*").alias("copies"), F.first("shingles").alias("shingles"), F.first("prefixes").alias("prefixes")
    )
    classes = materialise(classes, "classes")

    nodes = classes.select("key", "shingles", F.posexplode("prefixes").alias("tree", "prefix"))
    shared = nodes.groupBy("tree", "prefix").agg(F.count("*").alias("members"), F.sum("shingles").alias("weight")).filter("members > 1")
    parts = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("weight") / (block * 4096))).cast("int").alias("parts")
    met = nodes.select("key", "tree", "prefix").join(shared.select("tree", "prefix", parts), ["tree", "prefix"])
    met = met.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    grid = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    grid = grid.select("tree", "prefix", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "key")
    place = ["tree", "prefix", "low", "high"]
    grid = grid.join(classes.select("key", "head", "copies", "prefixes"), "key").select(*place, "part", "key", "head", "copies", "prefixes")
    grid = grid.repartition(*place).sortWithinPartitions(*place)
    useful = materialise(grid.mapInArrow(_useful, grid.schema), "blocks")

    heads = useful.select("key", "head.doc_id", "head.text_hash").distinct()
    texts = named.join(heads, ["doc_id", "text_hash"]).dropDuplicates(["key"]).select("key", "text")
    blocks = useful.drop("head").join(texts, "key").select(*place, "part", "key", "copies", "prefixes", "text")
    blocks = blocks.repartition(*place).sortWithinPartitions(*place)
    found = materialise(blocks.mapInArrow(partial(_verify, size=shingle, similarity=similarity), "key binary, other binary, links long"), "links")

    links = found.filter("other IS NULL").groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.filter("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")))
    grouped = classes.select("key", "head", "copies").join(links, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "key"))
    leaders = grouped.filter("links IS NOT NULL").groupBy("root").agg(F.min("head").alias("leader"))
    grouped = grouped.join(leaders, "root", "left").select("key", "head", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("leader", "head").alias("leader"))
    with_words = sketches.select("doc_id", "text_hash", "key").join(grouped, "key").select(
        "doc_id",
        "text_hash",
        F.col("head.doc_id").alias("class_id"),
        F.col("copies").alias("class_size"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"),
        F.col("leader.doc_id").alias("group_id"),
        F.struct("doc_id", "text_hash").eqNullSafe(F.col("leader")).alias("first"),
    )
    blank = named.filter(~F.coalesce(F.col("text"), F.lit("")).rlike(r"(?U)\S"))
    alone = blank.select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(1).cast("long"), F.lit(0).cast("long"), F.col("doc_id"), F.lit(True))
    return with_words.union(alone)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs`, with all columns: the first of each group; rows without an id or words stay as they are."""
    linked = near_join(docs, **options).filter("n_links > 0").select("doc_id", "text_hash", "first").distinct()
    hashed = F.xxhash64(F.col("row.text").cast("string"))
    keyed = docs.select(F.struct("*").alias("row")).withColumns({"doc_id": F.col("row.doc_id").cast("long"), "text_hash": hashed})
    marked = keyed.join(linked, ["doc_id", "text_hash"], "left")
    first = marked.filter("first").dropDuplicates(["doc_id", "text_hash"])
    return marked.filter("first IS NULL").union(first).select("row.*")
