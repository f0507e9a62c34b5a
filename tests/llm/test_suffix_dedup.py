import hashlib
import random

import numpy as np
from aircascade.llm import induced, suffix_dedup

from .helpers import documents, odd_texts


def brute(docs, length):
    seen, out = set(), []
    for doc, text in docs:
        x = (text or "").encode()
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            g = x[i : i + length]
            if g in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(g)
        kept = bytes(c for c, r in zip(x, gone) if not r)
        spans = sum(1 for i in range(len(x)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_order_with_and_without_spill():
    rng = random.Random(3)
    for k in range(150):
        n, size = rng.randint(1, 300), rng.choice([2, 3, 26])
        raw = [rng.randint(1, size) for _ in range(n)]
        raw = (raw[:7] * 100)[:n] if k % 3 == 0 else raw
        raw.append(0)
        for held in (1 << 26, 128):
            got = np.concatenate(list(induced.suffixes(np.array(raw, np.uint16), 1000, held))).tolist()
            assert got == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_names_are_told_apart_by_their_characters():
    t = np.array([5, 1, 2, 3, 5, 1, 2, 3, 5, 1, 2, 4, 0], np.uint16)
    same = induced._equal(t, np.array([1, 1, 1, 0]), np.array([5, 9, 9, 4]), np.array([3, 3, 2, 0]))
    assert same.tolist() == [True, False, True, True]
    rng = random.Random(11)
    raw = np.array([rng.randint(1, 3) for _ in range(400)] + [0], np.uint16)
    assert np.concatenate(list(induced.suffixes(raw, 1000))).tolist() == sorted(range(401), key=lambda i: raw[i:].tolist())


def test_default_queues_reach_the_disk(monkeypatch):
    spilled = []
    spill = induced.Queues._spill
    monkeypatch.setattr(induced.Queues, "_spill", lambda self: (spilled.append(self.held), spill(self)))
    rng = np.random.default_rng(2)
    t = np.append(rng.integers(1, 30, suffix_dedup.SHARD // 2), 0).astype(np.uint16)
    got = np.concatenate(list(induced.suffixes(t, 100)))
    assert spilled and sorted(got.tolist()) == list(range(len(t)))
    near = [t[i : i + 12].tolist() for i in got[::997]]
    assert near == sorted(near)


def test_copies_in_a_shard_larger_than_memory():
    rng = random.Random(4)
    text = bytes(rng.randrange(97, 100) for _ in range(300))
    rows = [((True, d, 0, 0), text[a : a + 150]) for d, a in enumerate(rng.randrange(0, 150) for _ in range(40))]
    assert sorted(suffix_dedup.shard_copies(rows, 100)) == sorted(suffix_dedup.shard_copies(rows, 100, held=512))


def test_against_brute_force(spark):
    texts = odd_texts()
    got = sorted((tuple(r) for r in suffix_dedup.deduplicated(documents(spark)).collect()), key=repr)
    assert got == brute(list(enumerate(texts)), 100)


def test_null_and_repeated_ids(spark):
    t = [c * 150 for c in "abc"]
    docs = documents(spark, [t[0] + t[1], t[0] + t[2], t[1] + t[0]], [7, 7, None])
    got = sorted((tuple(r)[:3] for r in suffix_dedup.deduplicated(docs).collect()), key=repr)
    order = [(None, t[1] + t[0]), (7, t[0] + t[1]), (7, t[0] + t[2])]
    assert got == sorted((r[:3] for r in brute(order, 100)), key=repr)


def test_empty(spark):
    assert suffix_dedup.deduplicated(documents(spark, [])).count() == 0


def test_common_line_gets_other_anchors(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 5)
    rng = random.Random(6)
    line = "".join(rng.choice("abcdefgh ") for _ in range(60))
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [word(70) for _ in range(4)]
    texts = [word(rng.randrange(40, 90)) + rng.choice(shared) + line + rng.choice(shared) + word(rng.randrange(90)) for _ in range(60)]
    texts += [word(120) + line + word(120) for _ in range(40)] + ["q" * 500, "xy" * 300, "q" * 200]
    got = sorted((tuple(r) for r in suffix_dedup.deduplicated(documents(spark, texts)).collect()), key=repr)
    assert got == brute(list(enumerate(texts)), 100)
