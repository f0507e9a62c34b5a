"""Collocations against DuckDB and plain Python, and the guarantees of their summaries."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from aircascade.llm import phrases

from .helpers import SCHEMA, documents

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def corpus(spark, seed=3, n=260):
    rng = random.Random(seed)
    common = ["New York City", "new york", "of the", "in the end of the day", "Ünï çødé 漢字", "a", "b\tb", "c\x0bd", "x\x00y z"]
    rows = []
    for i in range(n):
        said = "".join(rng.choice([*common, f"w{rng.randrange(40)}"]) + rng.choice([" ", " ", " ", ", ", ".\n", "\t", "!"]) for _ in range(rng.randrange(60)))
        rows.append((i, rng.choice([said, said, said, None, "", " \n "]), rng.choice(["en", "de", None, "und", "en"]), "s", 0, "k", "c", "p", "z"))
    rows += [(900, "one hot text of seven words. ", "en", None, 0, "k", "c", "p", "z")] * 120
    rows.append((901, "again and again " * 2000, "fr", None, 0, "k", "c", "p", "z"))
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    """Every count in dictionaries."""
    f, n = {}, Counter()
    for r in rows:
        lang, text = r.lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= 30}
        left = []
        for p, a in cand.items():
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items())
            if not inside:
                left.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(left)[:2000], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


@pytest.mark.parametrize("small", [False, True])
def test_equals_sql_and_brute_force(spark, monkeypatch, small):
    if small:  # many chunks, parts and slices
        for name, size in (("CHUNK", 2000), ("SLICE", 300), ("PART", 3000)):
            monkeypatch.setattr(phrases, name, size)
    docs = corpus(spark)
    got = rows_of(phrases.collocations(docs))
    assert len(got) > 30 and {r[0] for r in got} >= {"en", "de", "und", "fr"}
    assert got == brute(docs.collect())
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert got == sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({phrases.SQL})").fetchall())


def test_slices_cut_a_long_text_at_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 40)
    text = "alpha beta gamma, delta epsilon. zeta eta theta iota kappa lambda mu nu xi omicron pi rho! sigma tau"
    one = lambda: Counter((n, s.text(i, n)) for s in phrases._slices([("en", text, 1), ("en", "", 2), ("de", "tau", 3)]) for n, at, _ in s.phrases(7) for i in at.tolist())
    cut = one()
    monkeypatch.setattr(phrases, "SLICE", 1 << 20)
    assert cut == one() and cut[4, "zeta eta theta iota"] == 1 and not cut[2, "gamma delta"]


@pytest.mark.parametrize("seed", range(4))
def test_summaries_keep_all_that_is_frequent(seed):
    rng = np.random.default_rng(seed)
    lists, truth = [], Counter()
    for _ in range(60):
        k = np.unique(np.concatenate([rng.integers(0, 50, 20), rng.integers(0, 100_000, 4000)]).astype(np.uint32))
        c = rng.integers(1, 3, len(k)).astype(np.int64)
        lists.append((k, c))
        truth.update(dict(zip(k.tolist(), c.tolist())))
    mass = sum(truth.values())
    capacity = mass // 30 + 1
    keys, counters, low = phrases.summary(iter(lists), capacity)
    assert len(keys) <= capacity and low * (capacity + 1) <= mass and low < 30
    for k, c in zip(keys.tolist(), counters.tolist()):
        assert c <= truth[k] <= c + low
    assert {k for k, c in truth.items() if c >= 30} <= set(keys[counters + low >= 30].tolist())
    # Summaries of halves merge into one with the same bounds.
    halves = [phrases.summary(iter(x), capacity) for x in (lists[::2], lists[1::2])]
    keys, counters, low = phrases.summary([(k, c) for k, c, _ in halves], capacity)
    low += sum(x for *_, x in halves)
    assert low * (capacity + 1) <= mass and {k for k, c in truth.items() if c >= 30} <= set(keys[counters + low >= 30].tolist())


def test_empty(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, [None, "", "few words"])).count() == 0
