"""The parity-sketch join against brute force and DuckDB, and the guarantee of its keys."""

import random
import re

import duckdb
import numpy as np
import pytest
from aircascade.llm import minhash, parity

from .helpers import documents, odd_texts, rows_of, words


def brute(texts):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()

    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if n and 100 * n >= 85 * (len(a) + len(sets[j]) - n):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), find(i)) for i, s in enumerate(sets)), key=repr)


def edited(rng, base, most):
    w = base.split(" ")
    for _ in range(rng.randrange(1, most)):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


def test_equals_brute_force_and_sql(spark):
    rng = random.Random(8)
    base = words(rng, 250)
    texts = odd_texts() + [edited(rng, base, 12) for _ in range(40)] + [base.upper(), "A b c d e f g h", "a B c d e f g h i", "a b", "A b"]
    docs = documents(spark, texts)
    got = rows_of(parity.similar_documents(docs))
    assert got == brute(texts)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert got == sorted(con.sql(f"SELECT doc_id, n_shingles, component_id FROM ({parity.SQL})").fetchall(), key=repr)
    assert len({r[2] for r in got}) < len(got) - 30


def test_blocks_join_what_pivots_leave(spark, monkeypatch):
    """A loose family: pivots leave many links to the other members of their buckets."""
    rng = random.Random(9)
    base = words(rng, 200)
    texts = [edited(rng, base, 9) for _ in range(70)]
    want = brute(texts)
    assert 1 < len({r[2] for r in want}) < 60
    monkeypatch.setattr(parity, "BLOCK", 5)
    monkeypatch.setattr(minhash, "BLOCK_SETS", 7)
    assert rows_of(parity.similar_documents(documents(spark, texts))) == want


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    for size in (8, 50, 700):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for other in (1, 3, size // 2):
            b = np.unique(np.concatenate([a[other:], rng.integers(0, 1 << 63, other, dtype=np.uint64)]))
            for band in set(parity.bands(len(a))) & set(parity.bands(len(b))):
                x, y = (parity._bits([parity.sketch(s, band)]) for s in (a, b))
                assert parity._apart(x, y)[0, 0] <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("seed", range(3))
def test_linked_sets_share_a_key(seed):
    """The pigeonhole guarantee, at the threshold and at the edges of bands."""
    rng = np.random.default_rng(seed)
    for size in [7, 8, 9, 13, 14, 20, 21, 30, 31, 45, 100, 500, 3000, *rng.integers(7, 400, 60).tolist()]:
        for _ in range(6):
            # A larger set of ``size``, a smaller one with c shingles in common and e of its own, just similar enough.
            e = int(rng.integers(0, max(1, parity.most_apart(2 * size))))
            c = -(-85 * (size + e) // 100)
            if c > size or c + e > size or c + e < 1:
                continue
            pool = rng.integers(0, 1 << 63, size + e, dtype=np.uint64)
            a, b = np.unique(pool[:size]), np.unique(np.concatenate([pool[:c], pool[size:]]))
            assert len(np.setxor1d(a, b)) <= parity.most_apart(len(a) + len(b))
            if len(np.setxor1d(a, b)):
                keys = [np.concatenate([np.empty(0, np.uint64), *(parity.segment_keys(s, band) for band in parity.bands(len(s)))]) for s in (a, b)]
                assert len(np.intersect1d(*keys)), (size, c, e)


def test_empty_segments_are_sent_where_they_are_many():
    """A set whose shingles lie in few segments relies on the empty ones."""
    a = np.arange(1, 101, dtype=np.uint64) << np.uint64(20)  # all in the first segment
    b = np.append(a[:-1], np.uint64(1) << np.uint64(19))
    b.sort()
    keys = [np.concatenate([parity.segment_keys(s, band) for band in parity.bands(len(s))]) for s in (a, b)]
    assert len(np.intersect1d(*keys)) > 0


def test_null_and_repeated_ids_and_empty(spark):
    got = parity.similar_documents(documents(spark, ["a b c d e f", "a b c d e f", "x", "a b c d e f"], [None, 4, None, 4])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 4), (4, 4), (4, 4)]
    assert parity.similar_documents(documents(spark, [])).count() == 0
