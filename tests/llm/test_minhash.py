import random
import re
from collections import defaultdict

from aircascade.llm import minhash

from .helpers import documents, odd_texts, words


def brute(texts):
    def shingles(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and sets[j] and 100 * n >= 75 * (len(a) + len(sets[j]) - n):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def near(docs):
    return sorted(tuple(r) for r in minhash.near_duplicates(docs).collect())


def test_against_brute_force(spark):
    assert near(documents(spark)) == brute(odd_texts())


def test_blocks_join_what_pivots_leave(spark, monkeypatch):
    """A family in which most pairs are too far apart: blocks must find each remaining link."""
    monkeypatch.setattr(minhash, "BLOCK_SETS", 7)
    rng = random.Random(9)
    base = words(rng, 120).split(" ")
    texts = []
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randrange(2, 9)):
            w[rng.randrange(len(w))] = words(rng, 1)
        texts.append(" ".join(w))
    got = near(documents(spark, texts))
    assert got == brute(texts)
    groups = defaultdict(int)
    for r in got:
        groups[r[2]] += 1
    assert 1 < len(groups) < 60


def test_null_ids_and_empty(spark):
    got = minhash.near_duplicates(documents(spark, ["a b c d e f", "a b c d e f", "x"], [None, 4, None])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, False), (0, 4, False), (4, 4, True)]
    assert minhash.near_duplicates(documents(spark, [])).count() == 0
    kept = minhash.deduplicated(documents(spark, ["a b c d e f", "a b c d e f", None]))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]
