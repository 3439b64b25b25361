from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tillroll.llm import projections
from tillroll.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, class string, root long, data binary"


def table(spark, rows):
    return spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v], l, "c", 3, b"d") for i, v, l in rows], SCHEMA)


def plain(rows, similarity=0.98):
    """Every pair; one result per row that has an id."""
    named = [(i, v, l) for i, v, l in rows if i is not None]
    unit = []
    for _, v, label in named:
        good = label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / max(abs(x) for x in v) if good else None)
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    n = len(named)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and named[i][2] == named[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= similarity] for i in range(n)]
    out = []
    for i in range(n):
        seen, front = {i}, [i]
        while front:
            front = [j for f in front for j in near[f] if j not in seen and not seen.add(j)]
        root = min(named[j][0] for j in seen)
        out.append((named[i][0], len(near[i]), root, named[i][0] == root))
    return sorted(out)


def found(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(tuple(r) for r in df.collect())


def clustered(seed=4, dim=12):
    """Loose vectors, exact copies, groups at the threshold, scaled vectors, a chain whose ends do not link."""
    rnd = random.Random(seed)
    draw = lambda: [rnd.gauss(0, 1) for _ in range(dim)]
    rows = [(i, draw(), i % 3) for i in range(300)]
    for g in range(12):
        centre = draw()
        for k in range(3 + 9 * (g % 4)):
            rows.append((1000 + 100 * g + k, [x + rnd.gauss(0, 0.16) for x in centre], g % 3))
    rows += [(5000 + k, rows[5][1], rows[5][2]) for k in range(40)]
    rows += [(5100, [2.5 * x for x in rows[5][1]], rows[5][2]), (5101, rows[5][1], (rows[5][2] + 1) % 3)]
    rows += [(5200 + k, [math.cos(0.15 * k), math.sin(0.15 * k), *[0.0] * (dim - 2)], 1) for k in range(15)]
    return rows


ODD = [
    (9000, None, 1), (9001, [], 1), (9002, [0.0] * 12, 1), (9003, [None] + [1.0] * 11, 1), (9004, [math.nan] * 12, 1), (9005, [math.inf] * 12, 1),
    (9006, [1.0] * 12, None), (9007, [1.0] * 12, None), (9008, [1.0, 2.0], 1), (9009, [2.0, 4.0], 1), (None, [1.0] * 12, 1),
    (9010, [1e300] * 12, 2), (9011, [1e-300] * 12, 2), (9012, [-0.0, *[1.0] * 11], 2), (9013, [0.0, *[1.0] * 11], 2), (9012, [-1.0] * 12, 2), (9010, [1e300] * 12, 2),
]


@pytest.mark.parametrize("options", [{}, {"window": 8, "block": 8}])
def test_every_link_is_found_and_counted(spark, options):
    rows = clustered() + ODD
    want = plain(rows)
    assert sum(r[1] for r in want) > 2000
    assert found(projections.near_vectors(table(spark, rows).repartition(5), **options)) == want


def test_a_group_denser_than_the_window_loses_no_link(spark):
    rnd = random.Random(9)
    centre = [rnd.gauss(0, 1) for _ in range(20)]
    rows = [(i, [x + rnd.gauss(0, 0.1) for x in centre], 0) for i in range(400)] + [(1000 + i, [rnd.gauss(0, 1) for _ in range(20)], 0) for i in range(200)]
    want = plain(rows)
    assert max(r[1] for r in want) > 350
    assert found(projections.near_vectors(table(spark, rows), window=4, block=16)) == want


def test_number_of_passes_keeps_the_recall():
    assert projections.passes_needed(500, 512, 0.98, 0.9999) == 1
    sizes = [projections.passes_needed(10**e, 512, 0.98, 0.9999) for e in range(3, 10)]
    assert sizes == sorted(sizes) and sizes[-1] < 60
    assert projections.passes_needed(10**6, 512, 1.0, 0.9999) == 1


def test_lone_pairs_meet_among_many(spark):
    """Pairs just above the threshold among vectors far more than a window: the passes alone have to bring them together."""
    rng = np.random.default_rng(2)
    loose = rng.standard_normal((3000, 16))
    rows = [(i, v.tolist(), 7) for i, v in enumerate(loose)]
    for k in range(60):
        u = loose[k] / np.linalg.norm(loose[k])
        w = rng.standard_normal(16)
        w -= (w @ u) * u
        rows.append((10_000 + k, (0.981 * u + math.sqrt(1 - 0.981**2) * w / np.linalg.norm(w)).tolist(), 7))
    got = {r[0]: r for r in found(projections.near_vectors(table(spark, rows), window=32))}
    assert all(got[10_000 + k][1] >= 1 and got[10_000 + k][2] <= k for k in range(60))


def test_empty_table_and_the_registered_query(spark, sf_dir):
    assert found(projections.near_vectors(table(spark, []))) == []
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found(QUERIES["op11_projection_near_vectors"](spark, sf_dir)) == plain(rows)
