"""N-gram Jaccard join by parity sketches; an exact join, no candidate is missed.

A sketch is a row of bits.  Each shingle of a document's set flips the bit that its
hash names, so shingles that two sets share cancel out, and the Hamming distance of
two sketches is at most the size of the sets' symmetric difference.

1. Two sets that link differ in at most (100 - p) / (100 + p) of their sizes' sum.  So
   sizes fall into bands, each 1.5 times the one before: a pair belongs to the band
   of its larger set, and a set takes part in the one or two bands in which it can
   have partners.  A band fixes D, the largest distance of its pairs.
2. A band's sketch is cut into more than D segments, so by the pigeonhole principle a
   pair that links agrees on a whole segment.  Segments are a million bits wide,
   of which the few that are set are held as one 64-bit code, the XOR of a code for
   each.  Segments without a set bit tell nothing: there are more segments than D by a
   margin, and only a set that has as many empty ones as that margin sends them too.
3. Sets that share a segment meet there with narrow sketches, of some bits a shingle:
   each with the smallest of the bucket first (a number of comparisons linear in the
   bucket), then those that are in different components still, in blocks of bounded size.
   Only pairs whose Hamming distance allows a link go on.
4. These are verified: comparisons count the intersection of the full sets (as 64-bit hashes of shingles,
   which differ for different shingles but for one pair in 2^64).

Documents with the same set are one vertex, so copies cost nothing in the join.

Defined results: a text without words has an empty set and is linked with nothing; so
is a null text.  Very long texts are one set like any other.  Rows with a null doc_id
take part, but a component's id is its smallest doc_id that isn't null (null if
there is none).  Rows that share a doc_id are documents of their own, with one id.  An empty
table gives no rows.  Columns other than doc_id and text are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom_filters, dropped, salted_join, stored, tune
from .graph import components
from .minhash import full_sets, pivot_links, row_key, set_key_of, shingles

SHINGLE = 4
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Bits of a segment, as a power of two.
WIDTH = 20
#: Sets of a bucket that are compared with one, or with as many others, in one task.
BLOCK = 512
#: The last bits of a key are its band.
BAND_BITS = 63
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def most_apart(sizes: int, percent: int = PERCENT) -> int:
    """The largest symmetric difference of two linked sets whose sizes sum to ``sizes``."""
    return sizes * (100 - percent) // (100 + percent)


def tops() -> list[int]:
    """The largest size of each band."""
    out = [6]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 3 // 2)
    return out


TOPS = np.array(tops())


def bands(size: int, percent: int = PERCENT) -> range:
    """The bands in which a set of ``size`` shingles can have partners: by its own size, up to its largest partner's."""
    first, last = np.searchsorted(TOPS, [size, size * 100 // percent])
    return range(int(first), int(last) + 1)


def segments(band: int, percent: int = PERCENT) -> tuple[int, int]:
    """The largest distance in a band, and its number of segments."""
    d = most_apart(2 * int(TOPS[band]), percent)
    return d, d + 4 + d // 12


def segment_keys(hashes: np.ndarray, band: int, percent: int = PERCENT) -> np.ndarray:
    """A set's join keys in a band; ``hashes`` are its shingles' hashes in order."""
    d, k = segments(band, percent)
    if d == 0:  # only equal sets link
        return np.empty(0, np.uint64)
    at = ((hashes >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)  # in order too
    bit = at << np.uint64(WIDTH) | (hashes & np.uint64((1 << WIDTH) - 1))
    salt = np.uint64((band + 1) * int(_STEP) % (1 << 64))
    code = _mixed(bit + salt)
    cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    keys = np.bitwise_xor.reduceat(code, cut)
    full = keys != 0
    keys = keys[full]
    if k - len(keys) >= k - d:
        empty = np.setdiff1d(np.arange(k, dtype=np.uint64), at[cut][full])
        keys = np.concatenate([keys, _mixed(_mixed(empty + salt) + np.uint64(1))])
    return keys & ~np.uint64(BAND_BITS) | np.uint64(band)


def sketched(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, row_key, n_shingles, set_key, short (8 bytes of it), keys of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                sets = [shingles(x.as_py(), SHINGLE) for x in part.column(2)]
                keys = [np.concatenate([np.empty(0, np.uint64), *(segment_keys(s, band, percent) for band in (bands(len(s), percent) if len(s) else ()))]) for s in sets]
                ends = np.cumsum([0, *map(len, keys)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.uint64), *keys]).view(np.int64)))
                set_keys = [set_key_of(s) for s in sets]
                short = np.frombuffer(b"".join(k[:8] for k in set_keys), "<i8")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(set_keys, pa.binary()), pa.array(short), lists], ["doc_id", "row_key", "n_shingles", "set_key", "short", "keys"])

    rows = docs.select("doc_id", row_key(), "text")
    return rows.mapInArrow(run, "doc_id long, row_key binary, n_shingles long, set_key binary, short long, keys array<long>")


def sketches(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """set_key, band, n, bits: a set's sketch in each of its bands, of ``sets`` (set_key, hashes)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, x in zip(b.column(0).to_pylist(), b.column(1)):
                hashes = x.values.to_numpy().view(np.uint64)
                rows += [(key, band, len(hashes), sketch(hashes, band)) for band in bands(len(hashes), percent)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.int32(), pa.int64(), pa.binary()))], ["set_key", "band", "n", "bits"])

    return sets.select("set_key", "hashes").mapInArrow(run, "set_key binary, band int, n long, bits binary")


def sketch(hashes: np.ndarray, band: int) -> bytes:
    """A bit for each of at least twice as many places as the band's largest set has shingles: the parity of those that fall there."""
    size = max(64, 1 << (2 * int(TOPS[band]) - 1).bit_length())
    at = ((hashes >> np.uint64(12)) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=size) & 1).astype(bool)).tobytes()


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of bits with each other."""
    out = np.zeros((len(a), len(b)), np.int64)
    for i in range(len(a)):
        out[i] = np.bitwise_count(a[i] ^ b).sum(axis=1, dtype=np.int64)
    return out


def _bits(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint64).reshape(len(rows), -1)


def _runs(batches: Iterable[pa.RecordBatch], by: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows with the same first ``by`` columns."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    return groupby(rows, key=lambda r: r[:by])


def near_pivots(members: DataFrame, signs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """pivot, set_key, n_shingles of members whose sketch is near enough to that of a pivot of theirs.

    A pivot's members are dealt over tasks of bounded size, each of which gets the pivot's sketch first.
    """
    pairs = members.where("set_key <> pivot").select("pivot", "band", "set_key").distinct()
    parts = pairs.groupBy("pivot", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("k"))
    key = F.struct("pivot", "band").alias("at")
    mine = salted_join(pairs.select(key, "set_key"), parts.select(key, "k"), "at").select(F.col("at.pivot").alias("pivot"), F.col("at.band").alias("band"), F.pmod(F.xxhash64("set_key"), F.col("k")).cast("int").alias("part"), F.lit(1).alias("side"), "set_key")
    own = parts.select("pivot", "band", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("part"), F.lit(0).alias("side"), F.col("pivot").alias("set_key"))
    dealt = mine.unionByName(own).join(signs, ["set_key", "band"]).select("pivot", "band", "part", "side", "set_key", "n", "bits")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pivot, *_), run in _runs(batches, 3):
            rows = list(run)
            bits, n = _bits([r[6] for r in rows]), np.array([r[5] for r in rows])
            near = np.flatnonzero(_apart(bits[:1], bits[1:])[0] <= (n[0] + n[1:]) * (100 - percent) // (100 + percent)) + 1
            yield pa.RecordBatch.from_arrays([pa.array([pivot] * len(near), pa.binary()), pa.array([rows[i][4] for i in near], pa.binary()), pa.array(n[near], pa.int64())], ["pivot", "set_key", "n_shingles"])

    out = dealt.repartition("pivot", "band", "part").sortWithinPartitions("pivot", "band", "part", "side")
    return out.mapInArrow(compare, "pivot binary, set_key binary, n_shingles long")


def near_members(members: DataFrame, label: DataFrame, signs: DataFrame, percent: int = PERCENT, forest: bool = False) -> DataFrame:
    """pivot, set_key, n_shingles: pairs of a bucket's other members that are in different components and whose sketches are near enough.

    With ``forest`` a task gives no more of them than would join its components, the nearest first.

    Pivots have been compared with all of their bucket, so they are left out.  Buckets
    that hold the same sets are compared once.  A bucket is cut into blocks, and a task
    compares two of them, or one in itself.
    """
    rest = members.where("set_key <> pivot").select("key", "band", "set_key").join(label, "set_key")
    mixed = [F.bit_xor(F.xxhash64("set_key", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    open_ = rest.groupBy("key", "band").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high"), *mixed).where(F.col("low") != F.col("high"))
    open_ = open_.groupBy("band", "n", "x1", "x2").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("k"))
    rows = salted_join(rest, open_, "key").withColumn("b", F.pmod(F.xxhash64("set_key"), F.col("k")).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("key", F.least("b", "x").alias("i"), F.greatest("b", "x").alias("j"), (F.col("b") > F.col("x")).alias("second"), "band", "c", "set_key")
    dealt = rows.join(signs, ["set_key", "band"]).select("key", "i", "j", "second", "c", "set_key", "n", "bits")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), run in _runs(batches, 3):
            rows = list(run)
            bits, n = _bits([r[7] for r in rows]), np.array([r[6] for r in rows])
            code = np.unique([r[4] for r in rows], return_inverse=True)[1]
            left, right = (np.arange(len(rows)),) * 2 if i == j else (np.flatnonzero([not r[3] for r in rows]), np.flatnonzero([r[3] for r in rows]))
            apart, sizes = _apart(bits[left], bits[right]), n[left][:, None] + n[right]
            x, y = np.nonzero((apart <= sizes * (100 - percent) // (100 + percent)) & (code[left][:, None] != code[right]))
            if forest:
                order = np.argsort(apart[x, y] / sizes[x, y], kind="stable")
                x, y = x[order], y[order]
                x, y = x[keep := _spanning(code[left[x]], code[right[y]])], y[keep]
            pairs = {tuple(sorted((a, b), key=lambda r: rows[r][5])) for a, b in zip(left[x].tolist(), right[y].tolist())}
            columns = [[rows[a][5] for a, _ in pairs], [rows[b][5] for _, b in pairs], [rows[b][6] for _, b in pairs]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64()))], ["pivot", "set_key", "n_shingles"])

    out = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return out.mapInArrow(compare, "pivot binary, set_key binary, n_shingles long")


def _spanning(a: np.ndarray, b: np.ndarray) -> list[int]:
    """The places of edges (a, b) that, taken in turn, join what isn't joined yet."""
    root = {c: c for c in np.union1d(a, b).tolist()}
    left, keep = len(root) - 1, []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        if x != y:
            root[x] = y
            keep.append(i)
            left -= 1
            if not left:
                break
    return keep


def verified(near: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of ``near`` (pivot, set_key, n_shingles) that link, by their full sets.

    Only sets that some pair names are moved: a semi-join goes before the one that deals them.  Spark
    broadcasts its keys while they are few and takes a Bloom filter of them beyond (both within its
    bounds, above which all sets are moved once).
    """
    wanted = stored(near.select(F.explode(F.array("pivot", "set_key")).alias("set_key")).distinct(), "wanted")
    # Spark makes a Bloom filter only of a side that has a condition; this one always holds.
    some = sets.join(wanted.where(F.length("set_key") > 0), "set_key", "left_semi")
    with bloom_filters(near.sparkSession):
        links = stored(pivot_links(near, some, percent), "links")
    dropped(wanted)
    return links


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (set_key, c) with components joined by ``links`` (a, b)."""
    to = components(links).select(F.col("v").alias("c"), F.col("c").alias("to"))
    return stored(salted_join(label, to, "c", "left").select("set_key", F.coalesce("to", "c").alias("c")), "labels")


def similar_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    tune(spark)
    sig = stored(sketched(docs, percent), "sketches")
    # The widest shuffle: a row for each set and segment, 16 bytes each.
    one = stored(sig.where("n_shingles > 0").groupBy("set_key").agg(F.first("short").alias("short"), F.first("n_shingles").alias("n_shingles"), F.min("row_key").alias("row_key"), F.first("keys").alias("keys")), "distinct")
    # Keys are most of the sketches' bytes and are with the distinct sets now; what the end needs of each row is narrow.
    wide, sig = sig, stored(sig.select("doc_id", "n_shingles", "set_key"), "rows")
    dropped(wide)
    full = sig.where("n_shingles > 0")
    rows = one.select("short", F.explode("keys").alias("key"))
    again = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "shared")
    with bloom_filters(spark):
        found = stored(rows.join(again, "key"), "buckets")
    dropped(again)
    ends = stored(one.drop("keys").join(found.select("short").distinct(), "short", "left_semi"), "ends")
    dropped(one)
    with bloom_filters(spark):
        sets = stored(full_sets(docs, ends.where("n_shingles > 0").select("row_key"), SHINGLE), "sets")
    members = found.join(ends.select("short", "set_key"), "short").select("key", "set_key")
    members = salted_join(members, members.groupBy("key").agg(F.min("set_key").alias("pivot")), "key")
    members = stored(members.withColumn("band", F.col("key").bitwiseAND(F.lit(BAND_BITS)).cast("int")), "members")
    dropped(found)
    signs = stored(sketches(sets, percent), "sketches-of-sets")

    near = stored(near_pivots(members, signs, percent).distinct(), "near")
    links = verified(near, sets, percent)
    label = _joined(ends.select("set_key", F.col("set_key").alias("c")), links)
    for t in (ends, near, links):
        dropped(t)
    # A forest of the nearest pairs joins nearly all that links; then whatever may link across the components that are left.
    for forest in (True, False):
        near = stored(near_members(members, label, signs, percent, forest).distinct(), "near")
        if near.isEmpty():
            break
        links = verified(near, sets, percent)
        parts = links.join(label.select(F.col("set_key").alias("a"), F.col("c").alias("ca")), "a").join(label.select(F.col("set_key").alias("b"), F.col("c").alias("cb")), "b")
        before, label = label, _joined(label, parts.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        for t in (before, links):
            dropped(t)
    for t in (near, signs, sets, members):
        dropped(t)

    # The smallest doc_id of a set, then of a component.
    own = full.groupBy("set_key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    own = own.join(label, "set_key", "left").where("n > 1 or c is not null")
    low = own.where("c is not null").groupBy("c").agg(F.min("first").alias("low"))
    named = stored(salted_join(own, low, "c", "left").select("set_key", F.coalesce("low", "first").alias("first"), F.lit(True).alias("named")), "named")
    dropped(label)
    out = salted_join(sig.select("doc_id", "n_shingles", "set_key"), named, "set_key", "left")
    out = out.withColumn("component_id", F.when(F.col("named") & (F.col("n_shingles") > 0), F.col("first")).otherwise(F.col("doc_id")))
    out = stored(out.select("doc_id", "n_shingles", "component_id"), "components")
    dropped(sig)
    dropped(named)
    return out


#: The same components in DuckDB's SQL, by comparing all documents that share a shingle.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
r(d, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.d, e.y FROM r JOIN e ON r.c = e.x),
m AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN m ON w.doc_id = m.d"""
