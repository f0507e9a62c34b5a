"""Synthetic dumps with known content, and a synthetic detector catalogue."""

import random

MARKERS = ["EVENT DATA", "SD meta DATA", "SD waveform DATA", "badsdinfo"]


def catalogue():
    """12 x 14 detectors at a pitch of 1,200 m with one hole."""
    return [(x * 100 + y, x * 120000.0, y * 120000.0, 140000.0 + x * 10 + y) for x in range(1, 13) for y in range(1, 15) if (x, y) != (6, 7)]


def hit(xxyy, good=4, t=(1.0, 1.5), p=(5.0, 6.0), vem=(40.0, 50.0), nfold=1):
    return [xxyy, good, *t, *p, xxyy // 100, xxyy % 100, 0.5, *vem, nfold]


def waveform(xxyy, seed=0):
    rng = random.Random(f"{xxyy}|{seed}")
    return [xxyy, 1000 + seed, 50_000_000, *(rng.randrange(0, 80) for _ in range(256))]


def event(k=0, particle=14):
    e = [float(i + k) / 7 for i in range(61)]
    e[0] = particle
    return e


def text_of(events, drop_last_bad=True):
    sections = [[" ".join(map(str, e["event"])) for e in events]]
    for name in ("hits", "waveforms", "bad"):
        sections.append([" ".join(str(x) for r in e[name] for x in r) for e in events])
    lines = ["something before"]
    for marker, body in zip(MARKERS, sections):
        lines += [f"# {marker}", *body]
    return "\n".join(lines) + "\n"


def plain_events(n=3, seed=1):
    rng = random.Random(seed)
    ids = [c[0] for c in catalogue()]
    out = []
    for k in range(n):
        at = rng.sample(ids, rng.randrange(4, 9))
        hits = [hit(i, rng.randrange(0, 6), (rng.random(), rng.random()), (rng.random() * 9, rng.random() * 9), nfold=rng.randrange(1, 4)) for i in at]
        waves = [waveform(h[0], j) for h in hits for j in range(h[11])]
        bad = [[rng.choice(ids), rng.randrange(1 << 16)] for _ in range(rng.randrange(0, 5))]
        out.append({"event": event(k, rng.choice([14, 402, 5626])), "hits": hits, "waveforms": waves, "bad": bad})
    return out
