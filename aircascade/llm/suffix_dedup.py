"""Exact substring deduplication with suffix arrays over shards.

A byte goes if a string of ``length`` bytes that covers it also starts earlier.
Shards are made so that all copies of such a string meet in one: each string has
an anchor, the smallest hash among its k-grams, which depends on its bytes only.
The strings around one anchor occurrence are its context.

1. Anchors of all texts are dealt by hash; those that occur once are done.
2. Of equal contexts all but the first go as a whole, without moving a byte.
3. Contexts that share an anchor but differ are fetched once each.  An anchor with
   very many (a common line) is set aside, and its contexts get other anchors,
   so no anchor gathers them all.  They are dealt by anchor into shards, and each shard is suffix-sorted by external induced
   sorting; neighbours in the suffix order that agree on ``length`` bytes are
   copies, and all but the first go.
4. The removed ranges meet their documents again.

Defined results: a null text is empty; documents are ordered by doc_id, null
first, and rows that share a doc_id by their text; an empty table gives no rows.
Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, tune
from .induced import suffixes

LENGTH, GRAM = 100, 24
#: Bytes of text hashed at once, and of contexts in a shard (a single anchor's contexts may make it larger).
CHUNK, SHARD = 1 << 20, 2 << 20
#: An anchor with more contexts is anchored anew by rarer grams; at most FREQUENT such anchors are listed at a time.
HOT, FREQUENT = 4096, 100_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Anchors of all strings of ``length`` bytes in a run of documents."""

    def __init__(self, length: int, gram: int, frequent: np.ndarray | None = None):
        """``frequent``: sorted gram hashes that are anchors only of strings that have no other gram."""
        self.length, self.gram, self.wide = length, gram, length - gram + 1
        self.frequent = frequent if frequent is not None and len(frequent) else None
        n = CHUNK + length + 1
        self.up, self.down = _powers(_BASE, n), _powers(_BACK, n)

    def chunk(self, data: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """first string, number of strings, anchor hash, context hash of each anchor, in order.

        ``last`` has, for each string start in ``data``, the document's last string start.
        """
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=total[1:])
        n = len(data) - self.gram + 1
        h = _mixed((total[self.gram :] - total[:n]) * self.down[:n])
        key = h >> np.uint64(1)
        if self.frequent is not None:
            at = np.minimum(np.searchsorted(self.frequent, h), len(self.frequent) - 1)
            key |= (self.frequent[at] == h).astype(np.uint64) << np.uint64(63)
        low = (key & ~np.uint64(0x1FFFFF)) | np.arange(n, dtype=np.uint64)  # the leftmost of equal hashes
        width = 1
        while 2 * width <= self.wide:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < self.wide:
            more = self.wide - width
            low = np.minimum(low[:-more], low[more:])
        starts = np.flatnonzero(np.arange(len(last)) <= last)
        if not len(starts):
            return (np.zeros(0, "i8"),) * 2 + (np.zeros(0, "u8"),) * 2
        at = (low[starts] & np.uint64(0x1FFFFF)).astype("i8")
        cut = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        first, count, anchor = starts[cut], np.diff(np.append(cut, len(at))), at[cut]
        context = (total[first + count - 1 + self.length] - total[first]) * self.down[first]
        context = _mixed(context + _mixed((count * 1024 + anchor - first).astype("u8")))
        return first, count, h[anchor], context

    def batch(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """doc, pos, strings, times, anchor hash, context hash: a run of equal neighbours is one row, ``times`` long."""
        ends = offsets[1:] - self.length
        for a in range(int(offsets[0]), int(offsets[-1]) - self.length + 1, CHUNK):
            z = min(a + CHUNK, int(offsets[-1]) - self.length + 1)
            place = np.arange(a, z)
            doc = np.searchsorted(offsets, place, side="right") - 1
            first, count, h, context = self.chunk(data[a : z + self.length - 1], ends[doc] - a)
            if not len(first):
                continue
            d = doc[first]
            same = (h[1:] == h[:-1]) & (context[1:] == context[:-1]) & (d[1:] == d[:-1])
            cut = np.flatnonzero(np.append(True, ~same))
            yield d[cut], first[cut] + a - offsets[d[cut]], count[cut], np.diff(np.append(cut, len(h))), h[cut], context[cut]


def anchored(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, copy, pos, strings, times, h, context of ``docs`` (doc_id, copy, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Anchors(length, GRAM)
        for b in batches:
            text = b.column(2).cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], "i8")[text.offset : text.offset + len(text) + 1]
            if not len(text) or offsets[-1] == offsets[0]:
                continue
            data = np.frombuffer(text.buffers()[2], "u1")
            for doc, pos, strings, times, h, context in find.batch(data, offsets):
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(pos.astype("i8")), pa.array(strings.astype("i4")), pa.array(times.astype("i4")), pa.array(h.view("i8")), pa.array(context.view("i8"))],
                    ["doc_id", "copy", "pos", "strings", "times", "h", "context"],
                )

    return docs.mapInArrow(run, "doc_id long, copy int, pos long, strings int, times int, h long, context long")


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, copy, and the text's bytes compressed, as they are moved twice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            texts = [z.compress(x.as_buffer() or b"") for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())], ["doc_id", "copy", "packed"])

    return docs.mapInArrow(run, "doc_id long, copy int, packed binary")


def _in_batches(arrays: Iterable[np.ndarray], size: int = 1 << 16) -> Iterator[np.ndarray]:
    some, n = [], 0
    for x in arrays:
        some.append(x)
        n += len(x)
        if n >= size:
            yield np.concatenate(some)
            some, n = [], 0
    if n:
        yield np.concatenate(some)


def shard_copies(rows: list[tuple], length: int, held: int | None = None) -> list[tuple[int, int, int]]:
    """(row, first, last): strings of the rows that also start earlier; ``rows`` are (order key, context bytes)."""
    sizes = np.array([len(r[1]) for r in rows])
    begin = np.cumsum(np.append(0, sizes + 1))[:-1]
    t = np.ones(int(sizes.sum()) + len(rows) + 1, np.uint16)  # 1 ends a context, 0 the shard
    row_of = np.repeat(np.arange(len(rows)), sizes + 1)
    for i, (_, raw) in enumerate(rows):
        t[begin[i] : begin[i] + len(raw)] = np.frombuffer(raw, "u1")
        t[begin[i] : begin[i] + len(raw)] += 2
    t[-1] = 0
    # Eight bytes from each position on; what follows a context's end is never compared.
    word, byte = np.zeros(len(t), np.uint64), (t - 2).astype("u1").astype(np.uint64)
    for k in range(8):
        word[: len(t) - k] |= byte[k:] << np.uint64(8 * k)
    valid = np.zeros(len(t), bool)
    left = np.append(np.repeat(begin + sizes, sizes + 1), 0)
    valid[:-1] = np.arange(len(t) - 1) + length <= left[:-1]
    rank = np.empty(len(rows), "i8")
    rank[sorted(range(len(rows)), key=lambda i: rows[i][0])] = np.arange(len(rows))
    steps = [*range(0, length - 7, 8), length - 8]

    def same(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the strings at x and y have ``length`` characters in common; longer agreement is tested on what agrees so far."""
        out = np.ones(len(x), bool)
        on = np.arange(len(x))
        for s in steps:
            on = on[word[x[on] + s] == word[y[on] + s]]
        out[:] = False
        out[on] = True
        return out

    again, last, best = [], None, None
    for at in _in_batches(x[valid[x]] for x in suffixes(t, length, *([held] if held else []))):
        order = rank[row_of[at]] * (1 << 32) + (at - begin[row_of[at]])
        if last is not None:  # the group may go on from the array before
            at, order = np.append(last, at), np.append(best, order)
        cut = np.flatnonzero(np.append(True, ~same(at[1:], at[:-1])))
        least = np.minimum.reduceat(order, cut)
        first = order == np.repeat(least, np.diff(np.append(cut, len(at))))
        # The last group stays open: its smallest so far goes on, all others are copies in any case.
        open_ = cut[-1]
        keep = open_ + int(np.argmax(first[open_:]))
        last, best = at[keep], order[keep]
        again.append(at[~first])
    gone = np.unique(np.concatenate(again)) if again else np.zeros(0, "i8")
    if not len(gone):
        return []
    cut = np.flatnonzero(np.append(True, (np.diff(gone) != 1) | (row_of[gone[1:]] != row_of[gone[:-1]])))
    end = np.append(cut[1:], len(gone)) - 1
    return [(int(r), int(a), int(z)) for r, a, z in zip(row_of[gone[cut]], gone[cut] - begin[row_of[gone[cut]]], gone[end] - begin[row_of[gone[cut]]])]


def _level(seen: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Of context occurrences: the first of each context among anchors that occur again, and the ranges that go in any case."""
    w = Window.partitionBy("h").orderBy("context", "doc_id", "copy", "pos")
    seen = seen.withColumns({"before": F.lag("context").over(w), "after": F.lead("context").over(w)})
    seen = seen.withColumn("head", F.col("before").isNull() | (F.col("before") != F.col("context")))
    seen = stored(seen.where("before is not null or after is not null or times > 1").drop("before", "after", "context"), "anchors")
    skip = F.when(F.col("head"), F.col("strings")).otherwise(0)
    whole = seen.where("not head or times > 1").select("doc_id", "copy", (F.col("pos") + skip).alias("start"), (F.col("pos") + F.col("strings") * F.col("times") + (length - 1)).alias("stop"))
    return seen.where("head").drop("head", "times"), whole


def _hottest(contexts: DataFrame) -> np.ndarray:
    """Anchors with more than HOT contexts, the most frequent FREQUENT of them at most (the rest are smaller than any of these)."""
    rows = contexts.where(F.col("count") > HOT).select("h", "count").distinct().orderBy(F.desc("count")).limit(FREQUENT).select("h").toArrow()
    return np.sort(rows["h"].to_numpy().astype("i8").view(np.uint64))


def _anchored_again(contexts: DataFrame, length: int, frequent: np.ndarray) -> DataFrame:
    """Context occurrences of ``contexts`` (doc_id, copy, pos, raw) with other anchors than the frequent ones, where there are any."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Anchors(length, GRAM, frequent)
        for b in batches:
            raw = b.column("raw").cast(pa.large_binary())
            offsets = np.frombuffer(raw.buffers()[1], "i8")[raw.offset : raw.offset + len(raw) + 1]
            if not len(raw):
                continue
            data, begin = np.frombuffer(raw.buffers()[2], "u1"), b.column("pos").to_numpy()
            for row, pos, strings, times, h, context in find.batch(data, offsets):
                at = pa.array(row)
                n = strings * times
                pieces = [data[a : a + m + length - 1].tobytes() for a, m in zip(offsets[row] + pos, n)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(at), b.column("copy").take(at), pa.array(begin[row] + pos), pa.array(n.astype("i4")), pa.array(np.ones(len(n), "i4")), pa.array(h.view("i8")), pa.array((context + times.astype("u8")).view("i8")), pa.array(pieces, pa.binary())],
                    ["doc_id", "copy", "pos", "strings", "times", "h", "context", "raw"],
                )

    rows = contexts.select("doc_id", "copy", "pos", "raw")
    return rows.mapInArrow(run, "doc_id long, copy int, pos long, strings int, times int, h long, context long, raw binary")


def removed_ranges(docs: DataFrame, length: int = LENGTH, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """``docs`` with its copy column, and doc_id, copy, start, stop of the byte ranges that go (they may overlap)."""
    tune(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    twice = docs.groupBy("doc_id").count().where("count > 1")
    if twice.isEmpty():
        docs = docs.select("doc_id", F.lit(0).alias("copy"), "text")
    else:
        w = Window.partitionBy("doc_id").orderBy("text")
        docs = stored(docs.withColumn("copy", F.row_number().over(w) - 1).select("doc_id", "copy", "text"), "copies")
    # Level 0 anchors whole texts; a further level anchors anew the contexts of anchors that have too many.
    heads, ranges = _level(anchored(docs, length), length)
    counts = heads.groupBy("h").count().where("count > 1")
    shared = stored(heads.join(counts, "h"), "contexts")
    wanted = shared.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("h", "pos", "strings", "count")).alias("wanted"))

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        names = ["h", "doc_id", "copy", "pos", "count", "raw"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            for r in b.to_pylist():
                raw = z.decompress(r["packed"])
                rows = [(x["h"], r["doc_id"], r["copy"], x["pos"], x["count"], raw[x["pos"] : x["pos"] + x["strings"] + length - 1]) for x in r["wanted"]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    both = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("l.copy").eqNullSafe(F.col("r.copy"))
    contexts = wanted.alias("l").join(_packed(docs).alias("r"), both).select("l.doc_id", "l.copy", "wanted", "packed").mapInArrow(fetch, "h long, doc_id long, copy int, pos long, count long, raw binary")
    frequent, hot = np.zeros(0, np.uint64), _hottest(shared)
    # It ends when no anchor has too many contexts, or those that have were passed over already: their strings have no other gram.
    while len(np.setdiff1d(hot, frequent)):
        contexts, frequent = stored(contexts, "raw"), np.union1d(frequent, hot)
        heads, more = _level(_anchored_again(contexts.where(F.col("count") > HOT), length, frequent), length)
        counts = heads.groupBy("h").count().where("count > 1")
        again = stored(heads.join(counts, "h").select("h", "doc_id", "copy", "pos", "count", "raw"), "again")
        contexts, ranges = contexts.where(F.col("count") <= HOT).unionByName(again), ranges.unionByName(more)
        hot = _hottest(again)
    contexts = contexts.select("h", "doc_id", "copy", "pos", "raw")

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None

        def solve() -> pa.RecordBatch:
            found = shard_copies([((r[0] is not None, r[0] or 0, r[1], r[2]), r[3]) for r in rows], length)
            out = [(*rows[i][:2], rows[i][2] + a, rows[i][2] + z + length) for i, a, z in found]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)], ["doc_id", "copy", "start", "stop"])

        for b in batches:
            for h, doc, copy, pos, raw in zip(*(c.to_pylist() for c in b.columns)):
                if size >= shard and h != last:
                    yield solve()
                    rows, size = [], 0
                rows.append((doc, copy, pos, raw))
                size, last = size + len(raw), h
        if rows:
            yield solve()

    sorted_ = contexts.repartition("h").sortWithinPartitions("h").mapInArrow(sort, "doc_id long, copy int, start long, stop long")
    return docs, ranges.unionByName(sorted_)


def deduplicated(docs: DataFrame, length: int = LENGTH, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (and with ``texts`` the bytes kept)."""
    rows, ranges = removed_ranges(docs, length)
    # A document's ranges: no more than its anchors.
    gone = ranges.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * texts]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * texts]
        for b in batches:
            out = []
            for doc, packed, spans in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                raw = z.decompress(packed.as_buffer())
                at = removed = n = 0
                kept = []
                for s in sorted(spans or [], key=lambda s: s["start"]):
                    start, stop = s["start"], s["stop"]
                    if start > at or n == 0:
                        kept.append(raw[at:start])
                        n += 1
                        at = start
                    if stop > at:
                        removed += stop - at
                        at = stop
                kept = b"".join([*kept, raw[at:]])
                out.append((doc, len(raw), removed, n, hashlib.sha256(kept).hexdigest(), *[kept] * texts))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(kinds), kinds)], names)

    both = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("l.copy").eqNullSafe(F.col("r.copy"))
    at = _packed(rows).alias("l").join(gone.alias("r"), both, "left").select("l.doc_id", "packed", "gone")
    return at.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts)
