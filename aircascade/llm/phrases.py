"""Collocations: phrases of two to four words that keep together, per language.

What is frequent is found by Misra-Gries summaries, and what they keep is counted
exactly in a second pass.

1. Equal texts of a language become one row with a weight.  Rows are dealt by their
   hash into chunks of a few megabytes, the same in both passes.
2. First pass: each chunk sends the hashes of its phrases (of one to four words), put
   together and counted, to the hash partitions that own them: 4 bytes a phrase.
3. A hash partition merges what the chunks sent into one Misra-Gries summary.  Its
   capacity exceeds the partition's mass divided by the threshold, so no phrase that
   is frequent can drop out: counters are lowered by less than the threshold in all.
   It answers each chunk with those of its hashes that may be frequent.
4. Second pass: each chunk reads its texts again, takes the occurrences that its
   answers name, and counts them by their words, not by hashes.  Only these few go
   through a shuffle as text, and their sums are the exact numbers.  Hashes that
   collide cost a little work, never a wrong count.

Scores, nested phrases and ranks are joins and windows over the candidates.

Defined results: a null text is empty; a null language is ``und``, one with the language
of that name.  Repeated rows count as often as they come.  Very long texts are read
in slices that end where a piece ends; a single piece is held whole.  Ties in the
ranking go by the phrase's UTF-8 bytes.  An empty table gives no rows.  Columns
other than text and lang are ignored, whatever their names; doc_id isn't needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, salted_join, shuffles_dropped, stored, tune

LONGEST, THRESHOLD, TOP = 4, 30, 2000
#: Bytes of text of a chunk, of a slice that is read at once, and for each hash partition.
CHUNK, SLICE, PART = 4 << 20, 2 << 20, 16 << 20
#: Parts of a language that are ranked before the language is.
RANKED_APART = 64
#: Marks between pieces and between texts; these bytes are in no UTF-8 text.
_PIECE, _TEXT = b"\xff", b"\xfe"
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _PIECE * 10)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, the sums of their counts, and where each first came."""
    if not len(keys):
        return keys, counts, np.empty(0, np.int64)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[cut], np.add.reduceat(counts[order], cut), order[cut]


class Slice:
    """The words of some texts of one language, with their texts' weights."""

    def __init__(self, lang: str, texts: list[bytes], weights: list[int]):
        from xxhash import xxh3_64_intdigest

        said = (b" " + _TEXT + b" ").join(texts).replace(_PIECE, b" " + _PIECE + b" ").split()
        place = {w: i for i, w in enumerate(dict.fromkeys([_PIECE, _TEXT, *said]))}
        self.vocabulary = list(place)
        self.ids = np.fromiter(map(place.__getitem__, said), np.int64, len(said))
        hashes = np.fromiter(map(xxh3_64_intdigest, self.vocabulary), np.uint64, len(place))
        self.hashes = hashes[self.ids]
        self.marks = np.concatenate([[0], np.cumsum(self.ids < 2)])
        self.weights = np.array(weights, np.int64)[np.cumsum(self.ids == 1)]
        self.seed = xxh3_64_intdigest(lang.encode())
        self.n_words = int(self.weights[self.ids > 1].sum())

    def phrases(self, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: the places where phrases begin, and their keys (hash partition in the upper half, hash in the lower)."""
        rolled = self.hashes
        for n in range(1, LONGEST + 1):
            if n > 1:
                rolled = rolled[:-1] * _STEP + self.hashes[n - 1 :]
            if len(rolled) == 0:
                return
            at = np.flatnonzero(self.marks[n:] == self.marks[: len(self.ids) - n + 1])
            h = _mixed(rolled[at] + np.uint64(self.seed * (2 * n + 1) % (1 << 64)))
            yield n, at, (((h >> _HALF) * np.uint64(parts)) >> _HALF) << _HALF | (h & _LOW)

    def codes(self, at: np.ndarray, n: int) -> np.ndarray:
        """A number for each phrase of ``n`` words at ``at``, equal for equal words only."""
        code = self.ids[at]
        for k in range(1, n):
            if k > 1:  # numbers of shorter phrases, so that two always fit into 64 bits
                code = np.unique(code, return_inverse=True)[1]
            code = code << 32 | self.ids[at + k]
        return code

    def text(self, at: int, n: int) -> str:
        return b" ".join([self.vocabulary[i] for i in self.ids[at : at + n].tolist()]).decode()


def _slices(rows: Iterable[tuple[str, str, int]]) -> Iterator[Slice]:
    """Rows (lang, text, weight) as slices of bounded size; a longer text is cut at ends of pieces."""
    lang, texts, weights, size = None, [], [], 0
    for to, text, weight in rows:
        data, at = text.encode().lower().translate(_ENDS), 0
        while at < len(data) or at == 0:
            end = at + SLICE if at + SLICE < len(data) else len(data)
            if end < len(data):
                end = max(data.rfind(_PIECE, at, end), 0) or data.find(_PIECE, end)
                end = len(data) if end < 0 else end + 1
            if texts and (to != lang or size + end - at > SLICE):
                yield Slice(lang, texts, weights)
                texts, weights, size = [], [], 0
            lang = to
            texts.append(data[at:end])
            weights.append(weight)
            size += end - at
            at = max(end, 1)
    if texts:
        yield Slice(lang, texts, weights)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as they need; nothing if all are 1."""
    top = int(counts.max())
    return b"" if top == 1 else counts.astype(np.uint8 if top < 1 << 8 else np.uint32 if top < 1 << 32 else np.int64).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.ones(n, np.int64) if not data else np.frombuffer(data, {1: np.uint8, 4: np.uint32, 8: np.int64}[len(data) // n]).astype(np.int64)


def sent(rows: DataFrame, parts: int) -> DataFrame:
    """part, chunk, keys, counts: what each chunk has for each hash partition.  ``rows`` has chunk, lang, text, weight, dealt and sorted by chunk."""

    def blobs(chunk: int, keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        k, c, _ = summed(np.concatenate(keys), np.concatenate(counts))
        owner = (k >> _HALF).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(k) else np.empty(0, np.int64)
        ends = [*cut[1:], len(k)]
        low = (k & _LOW).astype(np.uint32)
        columns = [owner[cut], np.full(len(cut), chunk), [low[i:z].tobytes() for i, z in zip(cut, ends)], [_narrow(c[i:z]) for i, z in zip(cut, ends)]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["part", "chunk", "keys", "counts"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = ((c, r) for b in batches for c, *r in zip(*(b.column(i).to_pylist() for i in range(4))))
        for chunk, mine in _grouped(flat):
            keys, counts = [], []
            for s in _slices(mine):
                for _, at, k in s.phrases(parts):
                    k, c, _ = summed(k, s.weights[at])
                    keys.append(k)
                    counts.append(c)
            if keys:
                yield blobs(chunk, keys, counts)

    return rows.select("chunk", "lang", "text", "weight").mapInArrow(run, "part int, chunk int, keys binary, counts binary")


def _grouped(rows: Iterable[tuple[int, list]]) -> Iterator[tuple[int, Iterator[list]]]:
    """Runs of rows with the same first member; each run must be read before the next."""
    from itertools import groupby

    for key, run in groupby(rows, key=lambda r: r[0]):
        yield key, (r[1] for r in run)


def summary(lists: Iterable[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A Misra-Gries summary of lists of (keys, counts): keys in order, counters, and by how much counters may be too low."""
    keys, counters, low = np.empty(0, np.uint32), np.empty(0, np.int64), 0
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def merge() -> None:
        nonlocal keys, counters, low
        keys, counters, _ = summed(np.concatenate([keys, *(k for k, _ in waiting)]), np.concatenate([counters, *(c for _, c in waiting)]))
        waiting.clear()
        if len(keys) > capacity:
            cut = len(keys) - capacity - 1
            least = int(np.partition(counters, cut)[cut])  # the largest that finds no room
            keys, counters, low = keys[counters > least], counters[counters > least] - least, low + least

    for k, c in lists:
        waiting.append((k, c))
        if sum(len(x) for x, _ in waiting) >= max(capacity, 1 << 16):
            merge()
    if waiting:
        merge()
    return keys, counters, low


def answers(blobs: DataFrame, threshold: int) -> DataFrame:
    """chunk, part, keys: for each chunk those of its hashes that may be frequent.  ``blobs`` is dealt and sorted by part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = ((p, r) for b in batches for p, *r in zip(*(b.column(i).to_pylist() for i in range(4))))
        for part, mine in _grouped(flat):
            held = [(chunk, np.frombuffer(k, np.uint32), c) for chunk, k, c in mine]
            mass = sum(int(_wide(c, len(k)).sum()) for _, k, c in held)
            keys, counters, low = summary(((k, _wide(c, len(k))) for _, k, c in held), mass // threshold + 1)
            kept = keys[counters + low >= threshold]
            if not len(kept):
                continue
            for chunk, k, _ in held:
                at = np.minimum(np.searchsorted(kept, k), len(kept) - 1)
                some = k[kept[at] == k]
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([part], pa.int32()), pa.array([some.tobytes()], pa.binary())], ["chunk", "part", "keys"])

    return blobs.select("part", "chunk", "keys", "counts").mapInArrow(run, "chunk int, part int, keys binary")


class _Member:
    """Which of many keys are among the given ones: a table of bits by hash, then the sorted keys."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.mask = np.uint64((1 << max(10, int(16 * len(keys) + 1).bit_length())) - 1)
        self.table = np.zeros(int(self.mask) + 1, bool)
        self.table[(self.keys & self.mask).astype(np.int64)] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.table[(keys & self.mask).astype(np.int64)])
        if not len(at):
            return at
        place = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        return at[self.keys[place] == keys[at]]


def counted(rows: DataFrame, replies: DataFrame, parts: int) -> DataFrame:
    """lang, phrase, size, f of the phrases that may be frequent, chunk by chunk; size 0 has the number of all words."""

    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, np.uint32).astype(np.uint64) | np.uint64(p) << _HALF for p, k in zip(wanted["part"].to_pylist(), wanted["keys"].to_pylist())]
        member = _Member(np.concatenate([np.empty(0, np.uint64), *keys]))
        out: dict[tuple[str, str | None, int], int] = {}
        texts = texts.take(pc.sort_indices(texts["lang"]))
        for s, lang in _with_lang(zip(*(texts[c].to_pylist() for c in ("lang", "text", "weight")))):
            out[lang, None, 0] = out.get((lang, None, 0), 0) + s.n_words
            for n, at, key in s.phrases(parts):
                at = at[member(key)]
                if len(at):
                    _, f, first = summed(s.codes(at, n), s.weights[at])
                    for i, x in zip(at[first].tolist(), f.tolist()):
                        name = (lang, s.text(i, n), n)
                        out[name] = out.get(name, 0) + x
        columns = [[k[0] for k in out], [k[1] for k in out], [k[2] for k in out], list(out.values())]
        return pa.table([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int64()))], ["lang", "phrase", "size", "f"])

    rows = rows.select("chunk", "lang", "text", "weight")
    return rows.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, "lang string, phrase string, size int, f long")


def _with_lang(rows: Iterable[tuple[str, str, int]]) -> Iterator[tuple[Slice, str]]:
    from itertools import groupby

    for lang, run in groupby(rows, key=lambda r: r[0]):
        for s in _slices(run):
            yield s, lang


def frequent(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """lang, phrase, size, f of all phrases of one to four words with f >= ``threshold``; size 0 (phrase null) has each language's words."""
    spark = docs.sparkSession
    tune(spark)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).groupBy("lang", "text").agg(F.count("*").alias("weight"))
    texts = stored(texts.withColumns({"size": F.octet_length("text"), "hash": F.xxhash64("lang", "text")}), "texts")
    size = texts.agg(F.sum("size")).first()[0] or 0
    chunks, parts = size // CHUNK + 1, size // PART + 1
    rows = texts.withColumn("chunk", F.pmod("hash", F.lit(chunks)).cast("int"))
    with shuffles_dropped(spark):
        blobs = stored(sent(rows.repartition("chunk").sortWithinPartitions("chunk", "lang"), parts), "phrase-hashes")
        replies = stored(answers(blobs.repartition("part").sortWithinPartitions("part"), threshold), "frequent-hashes")
        dropped(blobs)
        found = stored(counted(rows, replies, parts), "phrases")
    dropped(texts)
    dropped(replies)
    out = stored(found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where((F.col("f") >= threshold) | (F.col("size") == 0)), "frequent")
    dropped(found)
    return out


def _whole(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def _words(c: Column, start, length) -> Column:
    return F.array_join(F.slice(c, start, length), " ")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of ``docs`` (lang, text)."""
    known = frequent(docs, threshold)
    name = F.struct("lang", "phrase").alias("part")
    counts = known.where("size > 0").select(name, F.col("f").alias("part_f"))
    candidates = known.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    # Each cut has two parts; both are frequent, as they come wherever the phrase does.
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    sides = F.array(F.struct(F.lit(0).alias("side"), _words(F.col("w"), 1, F.col("k")).alias("text")), F.struct(F.lit(1).alias("side"), _words(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("text")))
    halves = cuts.select("lang", "phrase", "a", "k", F.explode(sides).alias("s")).select("lang", "phrase", "a", "k", "s.side", F.struct("lang", F.col("s.text").alias("phrase")).alias("part"))
    halves = salted_join(halves, counts, "part")
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("part_f")))
    scored = halves.groupBy("lang", "phrase", "a", "k").agg(of(0).alias("l"), of(1).alias("r"))
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = scored.groupBy("lang", "phrase", "a").agg(worst).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # Shorter phrases inside a longer candidate that comes nearly as often.
    spans = candidates.where("size > 2").withColumn("n", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)))
    inside = spans.groupBy("lang", _words(F.col("w"), F.col("i"), F.col("n")).alias("phrase")).agg(F.max("a").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * _whole("longer") < 80 * _whole("a"))).drop("longer")

    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    apart = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_APART))).orderBy(*best)
    left = left.withColumn("rank", F.row_number().over(apart)).where(F.col("rank") <= top)
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    words = known.where("size = 0").select("lang", F.col("f").alias("n"))
    return left.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same ranking in DuckDB's SQL.
SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, k AS size FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k))),
f AS MATERIALIZED (SELECT lang, phrase, size, count(*) AS f FROM g GROUP BY lang, phrase, size HAVING count(*) >= 30),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
k AS (SELECT lang, phrase, a, w, size, unnest(range(1, size)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * k.a) // (CAST(x.f AS HUGEINT) + y.f) AS score FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(w[1:k.k], ' ')
  JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(w[k.k + 1:], ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM s) WHERE nth = 1),
i AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, w, a, m, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM c WHERE size > 2)) GROUP BY ALL),
o AS (SELECT b.lang, b.phrase, a, l, r, score, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b LEFT JOIN i ON b.lang = i.lang AND b.phrase = i.phrase WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT))
SELECT o.lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n.n, CAST(score AS BIGINT) AS score FROM o JOIN n ON o.lang = n.lang WHERE rank <= 2000"""
