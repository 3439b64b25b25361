from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tillroll.llm import negatives, vectors

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, family string, score long"


def table(spark, rows):
    return spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v], l, "r", "f", 5) for i, v, l in rows], SCHEMA)


def plain(rows, anchors, positives=5, most=5):
    good = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for a, va, la in {g[0]: g for g in sorted(good, key=lambda g: (g[1], g[2]), reverse=True) if anchors(g[0])}.values():
        scored = [(-dot(va, v), i, l) for i, v, l in good if len(v) == len(va)]
        liked = sorted((s, i) for s, i, l in scored if l == la and i != a)[:positives]
        for s, p in liked:
            near = sorted((t, i) for t, i, l in scored if l != la and 80 * -s <= 100 * -t <= 100 * -s)[:most]
            out += [(a, p, r, i, -s, -t) for r, (t, i) in enumerate(near, 1)]
    return sorted(out)


def found(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def odd_rows(n=500, dim=6, seed=3):
    rnd = random.Random(seed)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(dim)], rnd.randrange(4)) for i in range(n)]
    rows += [(n + i, rows[8][1], i % 4) for i in range(60)]  # ties, of all labels
    rows += [(1000, None, 1), (1004, [], 1), (1008, [None] * dim, 1), (1012, [math.nan] * dim, 1), (1016, [math.inf] * dim, 1), (1020, [0.0] * dim, 2)]
    rows += [(1024, rows[4][1], None), (1028, [1.0, 0.5], 1), (1032, [1.0, 0.4], 1), (1036, [1.0, 0.3], 2), (None, rows[4][1], 1), (40, rows[40][1], rows[40][2]), (1040, rows[8][1], 9)]
    return rows


@pytest.mark.parametrize("options", [{}, {"tile": 40, "members": 5, "step": 16}])
def test_all_pairs(spark, options):
    rows = odd_rows()
    frame = table(spark, rows).repartition(4)
    want = plain(rows, lambda i: i % 4 == 0)
    assert len(want) > 1500
    assert found(negatives.hard_negatives(frame, frame.filter("vec_id % 4 = 0"), **options)) == want


def test_walks_end_early_where_clusters_are_tight():
    """Far candidates are left out, and what is left out could not have entered a list."""
    rng = np.random.default_rng(5)
    centres = 40 * rng.standard_normal((8, 16))
    data = np.floor(256 * (centres[rng.integers(8, size=4000)] + rng.standard_normal((4000, 16))))
    labels = rng.integers(5, size=4000)
    asked = np.flatnonzero(np.linalg.norm(data / 256 - centres[0], axis=1) < 8)[:50]
    row = {"dim": 16, "rows": len(asked), "ids": asked.astype(np.int64).tobytes(), "labels": labels[asked].tobytes(), "data": data[asked].tobytes()}
    walk = negatives._Walk([row], 5, 80, 128)
    walk.offer(vectors.Block(np.arange(4000), labels, data))
    assert walk.walked < 0.4 * 4000 * len(asked)
    for place, a in enumerate(asked.tolist()):
        scores = (data @ data[a]).astype(int)
        want = sorted((-scores[i], i) for i in range(4000) if i != a and labels[i] == labels[a])[:5]
        mine = walk.lists.place == place
        assert list(zip(-walk.lists.scores[mine], walk.lists.ids[mine], strict=True)) == want


def test_empty_tables_lone_rows_and_big_components(spark):
    none = table(spark, [])
    assert found(negatives.hard_negatives(none, none)) == []
    lone = table(spark, [(100, [1.0, 2.0], 1), (101, [1.0, 2.0], 2)])
    assert found(negatives.hard_negatives(lone, lone)) == []
    rows = [(0, [1e6, 1.0], 1), (1, [1e6, 2.0], 1), (2, [1e6, 1.5], 2), (3, [9e5, 0.0], 2), (4, [7e5, 0.0], 2), (5, [1e6, 2.0], 3)]
    frame = table(spark, rows)
    assert found(negatives.hard_negatives(frame, frame.filter("vec_id = 0"))) == plain(rows, lambda i: i == 0)
