"""External induced suffix sorting of one shard.

Suffixes are induced bucket by bucket: the queues hold text positions with the
leading character as priority, first in, first out, and whatever is popped
pushes its predecessors.  Positions of a bucket are handled as arrays.  Queues
beyond a memory bound move to a nameless scratch file of the task, which no other
task reads and which is gone when the sort is done.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes of queued positions held in memory; a shard of a few hundred thousand suffixes goes beyond it.
HELD = 4 << 20
#: Positions taken from a queue at once.
TAKEN = 1 << 18
#: Largest alphabet that gets a queue for each character; reduced texts with more names are ranked by doubling.
QUEUES = 4096


class Queues:
    """A disk-backed priority queue: FIFO arrays of positions by character."""

    def __init__(self, size: int, held: int):
        self.parts: list[list] = [[] for _ in range(size)]
        self.bound, self.held, self.file, self.end = held, 0, None, 0

    def push(self, chars: np.ndarray, at: np.ndarray) -> None:
        """Append positions to the queues of their characters, in order."""
        if not len(at):
            return
        order = np.argsort(chars, kind="stable")
        at, counts = at[order], np.bincount(chars)
        here = np.flatnonzero(counts)
        end = 0
        for c, n in zip(here.tolist(), counts[here].tolist()):
            self.parts[c].append(at[end : end + n])
            end += n
        self._add(at.nbytes)

    def put(self, char: int, at: np.ndarray) -> None:
        """Append positions to one queue."""
        self.parts[char].append(at)
        self._add(at.nbytes)

    def _add(self, size: int) -> None:
        self.held += size
        if self.held > self.bound:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(self.end)
        for queue in self.parts:
            for i, x in enumerate(queue):
                if isinstance(x, np.ndarray):
                    self.file.write(np.ascontiguousarray(x).data)
                    queue[i] = (self.end, len(x), x.dtype)
                    self.end += x.nbytes
        self.held = 0

    def _read(self, x) -> np.ndarray:
        if isinstance(x, np.ndarray):
            return x
        start, n, kind = x
        self.file.seek(start)
        return np.frombuffer(self.file.read(n * kind.itemsize), kind)

    def pop(self, char: int) -> np.ndarray | None:
        """What waits in a queue, up to a bound, in one array."""
        queue, some, size = self.parts[char], [], 0
        if not queue:
            return None
        while len(some) < len(queue) and size < TAKEN:
            x = queue[len(some)]
            some.append(self._read(x))
            size += len(some[-1])
            if isinstance(x, np.ndarray):
                self.held -= x.nbytes
        del queue[: len(some)]
        return some[0] if len(some) == 1 else np.concatenate(some)

    def _gathered(self, parts: Iterable) -> Iterator[np.ndarray]:
        some, size = [], 0
        for x in parts:
            some.append(x)
            size += len(x)
            if size >= TAKEN:
                yield np.concatenate(some)
                some, size = [], 0
        if some:
            yield np.concatenate(some)

    def __getitem__(self, char: int) -> Iterator[np.ndarray]:
        return self._gathered(map(self._read, self.parts[char]))

    def backwards(self, char: int) -> Iterator[np.ndarray]:
        return self._gathered(self._read(x)[::-1] for x in reversed(self.parts[char]))

    def close(self) -> None:
        if self.file:
            self.file.close()


def _induce(t: np.ndarray, lms: np.ndarray, size: int, held: int) -> Iterator[np.ndarray]:
    """All suffixes in order, from the order of the leftmost S suffixes; yielded bucket by bucket."""
    begin = np.searchsorted(t[lms], np.arange(size + 1))
    todo, large, small = Queues(size, held), Queues(size, held), Queues(size, held)
    try:
        for c in range(size):  # L suffixes, smallest first
            while (at := todo.pop(c)) is not None:
                large.put(c, at)
                before = at[at > 0] - 1
                chars = t[before]
                on = chars >= c
                todo.push(chars[on], before[on])
            at = lms[begin[c] : begin[c + 1]]
            before = at[at > 0] - 1
            todo.push(t[before], before)
        for c in range(size - 1, -1, -1):  # S suffixes, largest first
            while (at := todo.pop(c)) is not None:
                small.put(c, at)
                before = at[at > 0] - 1
                chars = t[before]
                on = chars <= c
                todo.push(chars[on], before[on])
            for at in large.backwards(c):
                before = at[at > 0] - 1
                chars = t[before]
                on = chars < c
                todo.push(chars[on], before[on])
        yield np.array([len(t) - 1])
        for c in range(size):
            yield from large[c]
            yield from small.backwards(c)
    finally:
        for q in (todo, large, small):
            q.close()


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of ``names`` by their first ``depth`` names at least."""
    rank, step = names.astype("i8") + 1, 1
    while step < depth and rank.max() < len(rank):
        after = np.zeros_like(rank)
        after[:-step] = rank[step:]
        rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1] + 1
        step *= 2
    return rank


def _equal(t: np.ndarray, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether t agrees with itself on ``size`` characters from x and from y on, pair by pair."""
    out = np.ones(len(x), bool)
    some = np.flatnonzero(size > 0)
    bounds = np.append(0, np.cumsum(size[some]))
    for a in range(0, len(some), TAKEN // 8):
        z = min(a + TAKEN // 8, len(some))
        n, begin = size[some[a:z]], bounds[a:z] - bounds[a]
        step = np.arange(bounds[z] - bounds[a]) - np.repeat(begin, n)
        same = t[np.repeat(x[some[a:z]], n) + step] == t[np.repeat(y[some[a:z]], n) + step]
        out[some[a:z]] = np.logical_and.reduceat(same, begin)
    return out


def suffixes(t: np.ndarray, depth: int, held: int = HELD) -> Iterator[np.ndarray]:
    """Text positions in the order of their suffixes' first ``depth`` characters, as a stream of arrays.

    ``t`` holds small integers and ends with its only 0.  Suffixes that agree on
    ``depth`` characters come next to each other in any order.
    """
    n, size = len(t), int(t.max()) + 1
    step = np.sign(np.diff(t.astype("i4")))
    # A character equal to its successor has the successor's type: take the next step that isn't 0.
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    after = np.minimum.accumulate(at[::-1])[::-1]
    s_type = np.append(np.append(step, 1)[after] > 0, True)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = s_type[1:] & ~s_type[:-1]
    lms = np.flatnonzero(is_lms)
    if len(lms) > 1:
        first = lms[np.argsort(t[lms], kind="stable")]
        order = np.concatenate([x[is_lms[x]] for x in _induce(t, first, size, held)])
        # Names: substrings between LMS positions, told apart by length and hash; where those agree, by their characters.
        ends = np.append(lms[1:], n - 1)
        power, mult = np.uint64(0x9E3779B97F4A7C15), np.empty(n, np.uint64)
        mult[0] = 1
        np.multiply.accumulate(np.full(n - 1, power), out=mult[1:]) if n > 1 else None
        total = np.concatenate([[np.uint64(0)], np.cumsum((t.astype(np.uint64) + np.uint64(1)) * mult)])
        # Multiplying up to a common power takes the place's factor away.
        key = (total[ends + 1] - total[lms]) * mult[n - 1 - lms]
        place = np.searchsorted(lms, order)
        k, length = key[place], (ends - lms)[place]
        new = np.append(False, (k[1:] != k[:-1]) | (length[1:] != length[:-1]))
        new[1:] |= ~_equal(t, lms[place[1:]], lms[place[:-1]], np.where(new[1:], 0, length[1:] + 1))
        names = np.empty(len(lms), "i8")
        names[place] = np.cumsum(new)
        count = int(new.sum()) + 1
        if count < len(lms):
            if count < QUEUES and names[-1] == 0 and not (names[:-1] == 0).any():
                order = np.concatenate(list(suffixes(names, depth, held)))
                lms = lms[order]
            else:
                lms = lms[np.argsort(_doubled(names, depth), kind="stable")]
        else:
            lms = order
    yield from _induce(t, lms, size, held)
