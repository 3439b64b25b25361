from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import topk, vectors, vptree

SCHEMA = "vec_id long, embedding array<float>, score string, rank string"


def embeddings(spark, rows):
    as_floats = lambda v: v and [None if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, as_floats(v), "x", "y") for i, v in rows], SCHEMA)


def odd_rows(n=300, dim=6, seed=3):
    rnd = random.Random(seed)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(1000, None), (1001, []), (1002, [1.0, None, 1, 1, 1, 1]), (1003, [float("nan")] * dim), (1004, [math.inf] * dim)]
    rows += [(1005, [0.0] * dim), (1006, [1.0, 2.0]), (1020, [1.0, -2.0]), (None, rows[0][1]), (12, rows[12][1])]
    return rows


def plain(rows, every, k, whole, zero):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    good = [(i, v) for i, v in good if zero or v.any()]
    if whole:
        good = [(i, np.floor(1024 * v)) for i, v in good]
    out = {}
    for q, a in {i: v for i, v in good}.items():
        if q % every:
            continue
        near = []
        for i, b in good:
            if i != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a, b, strict=True):
                    total += x * y
                near.append((-total, i))
        out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sizes", [(4096, 1024), (50, 7)])
def test_top_k_is_exact(spark, sizes):
    rows = odd_rows()
    table = embeddings(spark, rows)
    got = found(topk.top_k(table, table.filter("vec_id % 20 = 0"), k=10, tile=sizes[0], query_block=sizes[1]))
    want = plain(rows, 20, 10, True, True)
    assert got == {q: [(i, int(s)) for i, s in best] for q, best in want.items() if best}


def test_factor_one_finds_all_nearest(spark):
    rows = odd_rows()
    table = embeddings(spark, rows)
    got = found(vptree.nearest(table, table.filter("vec_id % 20 = 0"), k=20, factor=1.0, shard=100, query_block=9))
    assert got == {q: best for q, best in plain(rows, 20, 20, False, False).items() if best}


def test_equal_vectors_make_a_leaf_of_any_size():
    data = np.ones((1000, 3))
    ids = np.arange(1000)
    place, at = vptree.Tree(data).search(ids, np.array([5]), data[:1], 4, 1.0)
    assert sorted(at) == [i for i in range(1000) if i != 5] and set(place) == {0}


def test_production_factor_reaches_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    queries = table.filter("vec_id % 20 = 0")
    exact, near = (vptree.nearest(table, queries, factor=f).select("query_id", "vec_id") for f in (1.0, 4.0))
    assert exact.intersect(near).count() >= 0.9 * exact.count()


def test_large_components_stay_exact(spark):
    rows = [(0, [3e9, 1.0]), (1, [3e9, -1.0]), (2, [-3e9, 1.0]), (3, [3e38, 3e38])]
    table = embeddings(spark, rows)
    got = found(topk.top_k(table, table.filter("vec_id = 0"), k=3))
    whole = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in rows}
    score = lambda i: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[0], whole[i], strict=True))))
    assert got[0] == [(i, score(i)) for i in (1, 3, 2)]


def test_empty_tables_and_few_candidates(spark):
    none = embeddings(spark, [])
    assert topk.top_k(none, none).count() == 0 and vptree.nearest(none, none).count() == 0
    one = embeddings(spark, [(1, [1.0])])
    assert topk.top_k(one, one).count() == 0


def test_blocks_hold_every_vector_once(spark):
    table = vectors.usable(embeddings(spark, odd_rows()))
    blocks = vectors.blocks(table.repartition(3), 32).collect()
    ids = np.concatenate([vectors.opened(b.asDict()).ids for b in blocks])
    assert sorted(ids) == sorted(r.vec_id for r in table.collect())
    assert table.filter(F.col("vec_id").isNull()).count() == 0


@pytest.mark.parametrize(("side", "least"), [(65_536, 64), (65_536, 1), (40, 1)])
def test_units_let_every_block_meet_every_query_block_once(spark, side, least):
    """Also when both sides are cut into parts; with one part of queries, candidates are copied once."""
    table = vectors.usable(embeddings(spark, odd_rows()))
    held, asked = vectors.blocks(table.repartition(3), 16), vectors.blocks(table.repartition(2), 9)
    held, asked = (spark.createDataFrame(t.collect(), t.schema) for t in (held, asked))
    rows = vectors.units(held, asked, side, least).drop("data").collect()
    units: dict[tuple, tuple[list, list]] = {}
    for r in rows:
        units.setdefault((r.dim, r.family, r.c_part, r.q_part), ([], []))[r.kind].append(r.block)
    met = sorted((dim, c, q) for (dim, *_), (asked_here, held_here) in units.items() for c in held_here for q in asked_here)
    by_dim = lambda t: {(r.dim, r.block) for r in t.collect()}
    assert met == sorted((d, c, q) for d, c in by_dim(held) for e, q in by_dim(asked) if d == e)
    if side > 1000:
        assert sum(r.kind == 1 for r in rows) == held.count()
