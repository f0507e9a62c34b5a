import math
import random

import numpy as np
import pytest
from aircascade.llm import topk
from pyspark.sql import functions as F


def vectors(n=700, dim=8, seed=2):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) + (i % 5) for _ in range(dim)]) for i in range(n)]
    rows += [(5000, [0.5] * dim), (5001, rows[100][1]), (300, [1.0] * dim), (400, [0.0] * dim)]
    rows += [(6000, None), (6001, [None, 1.0]), (6002, [math.nan] * dim), (6003, [math.inf] * dim), (6100, [2.0, 1.0]), (None, [1.0] * dim)]
    return rows


def brute(rows, k=10, as_stored=lambda x: float(np.float32(x))):
    rows = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max(len(v) for _, v in rows)
    q = [(i, [math.floor(1024 * as_stored(x)) for x in v] + [0] * (dim - len(v)), v) for i, v in rows]
    out, asked = [], {}
    for i, e, v in q:
        if i % 100 == 0 and (i not in asked or v < asked[i][1]):
            asked[i] = (e, v)
    for i, (e, _) in asked.items():
        s = sorted((-sum(a * b for a, b in zip(e, f)), j) for j, f, _ in q if j != i)[:k]
        out += [(i, r + 1, j, -n) for r, (n, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize(("blocks", "pivots"), [((8192, 32768), None), ((3, 100), 5)])
def test_against_brute_force(spark, monkeypatch, blocks, pivots):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "VECTOR_BLOCK", blocks[1])
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, cell string, far double")
    assert sorted(tuple(r) for r in topk.search(df, pivots=pivots).collect()) == brute(rows)


def test_doubles_stay_doubles(spark):
    rng = random.Random(7)
    rows = [(i, [0.3 - 1e-9 * rng.random() + 1e-12, rng.random(), (2 * i + 1) / 1024 - 1e-13]) for i in range(250)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, as_stored=float)
    assert want != brute(rows) and sorted(tuple(r) for r in topk.search(df).collect()) == want


def test_few_rows_and_large_numbers(spark):
    rows = [(0, [1.5e6, 1.0]), (100, [-1.5e6, 1e6]), (7, [1e6, 1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in topk.search(df).collect()) == brute(rows)
    assert topk.search(df.limit(0)).count() == 0
    wide = [(0, [1e30, -1e30]), (100, [1e-30, 0.0]), (200, [0.0, 0.0])]
    df = spark.createDataFrame([(i, [x * 1e-15 for x in v]) for i, v in wide], "vec_id long, embedding array<double>")
    assert topk.search(df.where("vec_id > 0")).count() == 2


def test_bounds_hold_and_exclude():
    """No vector of a cell that a query passes over, and none nearer to the pivot than it says, is among its k best."""
    rng = np.random.default_rng(3)
    for spread in (0.05, 1.0):
        middle = rng.normal(size=(12, 16)) * 3
        x = np.floor(1024 * (middle[rng.integers(0, 12, 3000)] * rng.uniform(0.5, 1, (3000, 1)) + spread * rng.normal(size=(3000, 16))))
        x[:5] = 0
        p = topk.pivots_of(x[:400], 12)
        d = np.sqrt(((x[:, None, :] - p) ** 2).sum(2))
        cell, far, norm = d.argmin(1), d.min(1), np.sqrt((x * x).sum(1))
        angle = topk._angle((x * p[cell]).sum(1), norm, np.sqrt((p * p).sum(1))[cell])
        cells = [{"cell": c, "radius": far[cell == c].max(), "least": norm[cell == c].min(), "most": norm[cell == c].max(), "angle": angle[cell == c].max()} for c in np.unique(cell)]
        near = np.concatenate([np.flatnonzero(cell == c)[np.argsort(far[cell == c])[:10]] for c in np.unique(cell)])
        need, least = topk.Bounds(p, cells, x[near], near, 10).needed(np.arange(300), x[:300])
        scores = x[:300] @ x.T
        for i in range(300):
            best = [j for j in np.argsort(-scores[i]) if j != i][:10]
            assert all(need[i, cell[j]] and far[j] >= least[i, cell[j]] for j in best)
        assert need.mean() < (0.4 if spread < 1 else 1.01)


def test_clustered_queries_go_to_few_cells(spark):
    rng = random.Random(5)
    middle = [[rng.gauss(0, 3) for _ in range(12)] for _ in range(10)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in middle[i % 10]]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    p = topk.pivots_of(np.floor(1024 * np.array([v for _, v in rows[:500]])), 10)
    cells = topk.celled(topk.usable(df), p, 12).cache()
    bounds, sizes = topk.summed_up(cells, p, 12, 10)
    asked = topk.routed(cells.where("vec_id % 100 = 0"), bounds, 12)
    assert sum(sizes.values()) == 3000 and asked.agg(F.avg(F.size("to"))).first()[0] < 3
    assert sorted(tuple(r) for r in topk.search(df).collect()) == brute(rows, as_stored=float)
