import random

import numpy as np
import pytest
from aircascade.functions import shower_depth, traces
from aircascade.operators import checks, hits, ordering, profile, sampling, sparse
from pyspark.sql import functions as F

HITS = "file_name string, event_idx long, hit_idx int, xxyy int, nfold int"
WAVES = "file_name string, event_idx long, wf_idx int, xxyy int, value int"


def greedy(expected, actual):
    i, out = 0, []
    for j, a in enumerate(actual):
        if i < len(expected) and a == expected[i]:
            out.append(j)
            i += 1
    return out if i == len(expected) else None


def test_greedy_match_on_random_events(spark):
    rng, h, w, want = random.Random(4), [], [], {}
    for e in range(60):
        hs = [(rng.randrange(3), rng.randrange(0, 3)) for _ in range(rng.randrange(1, 6))]
        expected = [x for x, n in hs for _ in range(n)]
        actual = [x for x in expected if rng.random() < 0.97]
        for _ in range(rng.randrange(0, 4)):
            actual.insert(rng.randrange(0, len(actual) + 1), rng.randrange(3))
        h += [("f", e, k, x, n) for k, (x, n) in enumerate(hs)]
        w += [("f", e, k, x, k * 10) for k, x in enumerate(actual)]
        want[e] = greedy(expected, actual)
    found, broken = hits.greedy_match(spark.createDataFrame(h, HITS), spark.createDataFrame(w, WAVES))
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.event_idx, r.wf_idx)):
        assert r.value == r.raw_wf_idx * 10
        got.setdefault(r.event_idx, []).append(r.raw_wf_idx)
    assert got == {e: m for e, m in want.items() if m}
    assert {r.event_idx for r in broken.collect()} == {e for e, m in want.items() if m is None}


def test_records_and_numbers(spark):
    df = spark.createDataFrame([(" 1 2  3 4 5 ",), ("",), ("7 8",)], "line string")
    n = df.select(traces.numbers(F.col("line"), "int").alias("v")).select(traces.records(F.col("v"), 2).alias("r"), traces.whole_records(F.col("v"), 2).alias("w"))
    assert [(r.r, r.w) for r in n.collect()] == [([[1, 2], [3, 4]], False), ([], True), ([[7, 8]], True)]


def test_splits_are_exact_and_free_of_leaks(spark):
    sizes = [0, 1, 4, 5, 24, 100]
    rows = [("f", 1000 * s + i, s, i % 2 == 0 or s == 5) for s in sizes for i in range(s)]
    df = spark.createDataFrame(rows, "file_name string, event_idx long, stratum int, full boolean")
    t = sampling.tile_types(df, ["stratum"])
    count = {(r.tile_type, r.split, r.stratum): r["count"] for r in t.groupBy("tile_type", "split", "stratum").count().collect()}
    for s in sizes:
        full = min(24, sum(1 for r in rows if r[2] == s and r[3]))
        test = int(full * 0.2)
        assert count.get(("full_tiles", "test", s), 0) == test and count.get(("full_tiles", "train", s), 0) == full - test
        if full:
            assert count[("full_tiles", "small_train", s)] == min(max((full - test) // 10, 1), full - test)
    assert count[("any_tiles", "test", 100)] == 4 and count[("any_tiles", "train", 100)] == 20 and count[("any_tiles", "small_train", 100)] == 2
    pick = lambda kind, split: t.where((F.col("tile_type") == kind) & (F.col("split") == split))
    for a in (pick("full_tiles", "train"), pick("any_tiles", "train")):
        assert sampling.overlap(a, pick("any_tiles", "test")).count() == 0
    assert sorted(map(tuple, t.collect())) == sorted(map(tuple, sampling.tile_types(df.repartition(5), ["stratum"]).collect()))
    with pytest.raises(ValueError):
        sampling.subtract(df.where("stratum = 5"), df, strict=True)


def test_drawn_depths_follow_their_model(spark):
    df = spark.range(20000).select("id", F.lit(19.0).alias("e"), F.lit(56.0).alias("m"))
    mu, sigma, shape = shower_depth.gumbel_parameters(F.col("e"), F.col("m"))
    r = df.select("id", shower_depth.drawn_depth(F.col("e"), F.col("m"), [F.col("id")]).alias("x"), mu.alias("mu"), sigma.alias("s"), shape.alias("k")).toPandas()
    # Mean of ln Gamma(k, 1/k): digamma(k) - ln k, here by its series.
    k = r.k[0]
    digamma = -1 / k - 1 / (k + 1) - 1 / (k + 2) + np.log(k + 3) - 1 / (2 * (k + 3)) - 1 / (12 * (k + 3) ** 2)
    assert r.x.mean() == pytest.approx(r.mu[0] - r.s[0] * (digamma - np.log(k)), abs=1.5)
    with pytest.raises(ValueError):
        shower_depth.gumbel_parameters(F.col("e"), F.col("m"), "none")


def test_sparse_and_dense(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.0, 1.5]) for _ in range(20)]) for i in range(30)] + [(99, [0.0] * 20)]
    df = spark.createDataFrame(rows, "k long, a array<double>")
    back = sparse.to_dense(df, sparse.to_sparse(df, ["k"], "a"), ["k"], 20, "a")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert sparse.is_sparse(df, "a").first().nonzero == sum(x != 0 for _, a in rows for x in a)


def test_checks_and_profiles(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    assert [r.same for r in checks.differences(a, a.withColumn("v", F.col("v") + 1e-3), ["k"], ["v"]).collect()] == [False]
    assert {r.column: r.size for r in profile.sizes(a, "B").collect()} == {"k": 16, "v": 16, "total": 32}
    with pytest.raises(ValueError):
        profile.sizes(a, "XB")
    assert profile.listing({"a": a}).count() == 2
    p = {r.column: r for r in profile.profile(a.withColumn("t", F.array("v", "v"))).collect()}
    assert p["t"].mean_length == 2 and p["v"].high == 2 and p["k"].n == 2


def test_numbers_and_totals_over_a_whole_table(spark):
    rng = random.Random(4)
    rows = [(f"p{i:05d}é"[: rng.randrange(6, 8)], rng.randrange(9)) for i in rng.sample(range(90_000), 900)] + [(None, 5)]
    rows = list({p: (p, n) for p, n in rows}.values())
    got = ordering.in_order(spark.createDataFrame(rows, "path string, n long").repartition(7), "path", "place", total="all", before={"start": "n"}).collect()
    want, start = [], 0
    for i, (p, n) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0]))):
        want.append((p, n, i, start, len(rows)))
        start += n
    assert sorted(((r.path, r.n, r.place, r.start, r["all"]) for r in got), key=lambda r: r[2]) == want
    small = ordering.in_order(spark.createDataFrame(rows, "path string, n long"), "path", "place", before={"start": "n"}, size=4)  # more ranges than RANGES
    assert sorted(((r.path, r.n, r.place, r.start, len(rows)) for r in small.collect()), key=lambda r: r[2]) == want
    assert ordering.in_order(spark.createDataFrame([], "path string, n long"), "path", "place", total="all").count() == 0
