"""MinHash near-duplicates with min-max hashing.

Each permutation gives two signature values, the smallest and the largest hash
of a document's shingles, so 80 permutations give 160 values at half the hash
evaluations.  A band holds both values of two permutations; at a similarity of
0.75 a pair misses all 40 bands about once in four million times.

Documents with the same shingle set are one vertex.  In each bucket (band and
value) all members are compared with the bucket's pivot, a number of comparisons
linear in the bucket, and the links make components.  Where members of a bucket
are then still in several components, all pairs across those are compared too,
in blocks of bounded size.  Comparisons count the intersection of the full sets.

What moves: narrow rows (keys, labels) decide what is compared with what; only
then one text for each set that shares a bucket is fetched, hashed and written,
and each comparison stage moves those sets by their key and by their task.

Defined results: a text without words has an empty set and is linked with
nothing; so is a null text.  Very long texts are one set like any other; a block
holds at least one set, however large.  Rows with a null doc_id take part, but a component's
id is its smallest doc_id that isn't null (null if there is none), and ``kept`` is
false for a null doc_id.  Rows that share a doc_id are rows of one document: all
of them are kept if it is.  An empty table gives no rows.  Columns other than
doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom_filters, dropped, salted_join, stored, tune
from .graph import components

SHINGLE, BANDS, PER_BAND = 5, 40, 2
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Sets and hashes of a block that is compared in one task.
BLOCK_SETS, BLOCK_HASHES = 1500, 250_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, length: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles of ``length`` words."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    n = len(words)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
    if not n:
        return h
    size = min(n, length)
    out = np.full(n - size + 1, np.uint64(size))
    for k in range(size):
        out = out * _STEP + h[k : n - size + 1 + k]
    return np.unique(_mixed(out))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, 2 * BANDS * PER_BAND + 1, dtype=np.uint64)
    r = _mixed(k * _STEP)
    return r[0::2] | np.uint64(1), r[1::2]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of band keys for each set (none may be empty)."""
    times, plus = _permutations()
    x, begin = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    keys = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sets), np.uint64(band + 1))
        for p in range(band * PER_BAND, (band + 1) * PER_BAND):
            v = x * times[p] + plus[p]
            v ^= v >> np.uint64(32)
            v *= times[p]
            for ends in (np.minimum.reduceat(v, begin), np.maximum.reduceat(v, begin)):
                key = _mixed(key * _STEP + ends)
        keys[:, band] = key
    return keys


def set_key_of(s: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(s.tobytes())


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, set_key, short (8 bytes of it), bands of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, sets = b.column(1), [shingles(x.as_py()) for x in b.column(2)]
            full, at = [s for s in sets if len(s)], 0
            keys = []
            while at < len(full):  # about 100,000 hashes at once stay in the cache
                n, size = at, 0
                while n < len(full) and size < 100_000:
                    size += len(full[n])
                    n += 1
                keys.append(band_keys(full[at:n]))
                at = n
            keys = np.concatenate(keys).view(np.int64) if keys else np.empty((0, BANDS), np.int64)
            ends = np.cumsum([0, *(BANDS * bool(len(s)) for s in sets)])
            bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.reshape(-1)))
            count = pa.array([len(s) for s in sets], pa.int64())
            set_keys = [set_key_of(s) for s in sets]
            short = np.frombuffer(b"".join(k[:8] for k in set_keys), "<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), own, count, pa.array(set_keys, pa.binary()), pa.array(short), bands], ["doc_id", "row_key", "n_shingles", "set_key", "short", "bands"])

    rows = docs.select("doc_id", row_key(), "text")
    return rows.mapInArrow(run, "doc_id long, row_key binary, n_shingles long, set_key binary, short long, bands array<long>")


def row_key() -> Column:
    """128 bits of a row's doc_id and text."""
    said = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("|"), F.coalesce("text", F.lit("")))
    return F.unhex(F.md5(said.cast("binary"))).alias("row_key")


def full_sets(docs: DataFrame, wanted: DataFrame, length: int = SHINGLE) -> DataFrame:
    """set_key, hashes of the rows of ``wanted`` (row_key), which has one for each set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 200):
                sets = [shingles(x.as_py(), length) for x in b.column(0).slice(k, 200)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key_of(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["set_key", "hashes"])

    # Rows that are repeated as a whole are put together before they are moved; the join then finds them in place.
    one = docs.select(row_key(), "text").groupBy("row_key").agg(F.first("text").alias("text"))
    return one.join(wanted, "row_key", "left_semi").select("text").mapInArrow(run, "set_key binary, hashes array<long>")


def pivot_links(members: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of members and pivots of their buckets that are similar enough.

    A pivot's members are dealt over tasks of bounded size, each of which gets the
    pivot too; a task reads the pivot first and then compares a stream of members.
    """
    pairs = members.where("set_key <> pivot").select("pivot", "set_key", "n_shingles").distinct()
    k = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n_shingles") / BLOCK_HASHES)).cast("int")
    parts = pairs.groupBy("pivot").agg(k.alias("k"))
    # Narrow rows: a third of all sets may have one pivot, so this join is salted.
    mine = salted_join(pairs.select("pivot", "set_key"), parts, "pivot").select("set_key", "pivot", F.pmod(F.xxhash64("set_key"), F.col("k")).cast("int").alias("part"), F.lit(1).alias("side"))
    own = parts.select(F.col("pivot").alias("set_key"), "pivot", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("part"), F.lit(0).alias("side"))
    dealt = sets.join(mine.unionByName(own), "set_key").select("pivot", "part", "side", "set_key", "hashes")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, against = None, None
        for b in batches:
            pivots, sides, keys, sets = b.column(0).to_pylist(), b.column(2).to_numpy(), b.column(3), b.column(4)
            offsets, flat = sets.offsets.to_numpy(), sets.values.to_numpy().view(np.uint64)
            found_a, found_b = [], []
            cut = [i for i in range(len(pivots)) if i == 0 or sides[i] == 0 or pivots[i] != pivots[i - 1]]
            for i, z in zip(cut, [*cut[1:], len(pivots)]):
                if sides[i] == 0:
                    pivot, against = pivots[i], flat[offsets[i] : offsets[i + 1]]
                    i += 1
                if i == z:
                    continue
                x, begin = flat[offsets[i] : offsets[z]], offsets[i:z] - offsets[i]
                at = np.minimum(np.searchsorted(against, x), len(against) - 1)
                both = np.add.reduceat((against[at] == x).astype("i8"), begin)
                size = np.diff(offsets[i : z + 1])
                near = np.flatnonzero(100 * both >= percent * (size + len(against) - both))
                found_a += keys.take(pa.array(near + i)).to_pylist()
                found_b += [pivot] * len(near)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.binary()), pa.array(found_b, pa.binary())], ["a", "b"])

    return dealt.repartition("pivot", "part").sortWithinPartitions("pivot", "part", "side").mapInArrow(compare, "a binary, b binary")


def cross_links(members: DataFrame, sets: DataFrame, label: DataFrame, families: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of components that some pair of their members links.

    ``label`` has set_key, c of the members, ``families`` c, f of the components
    that share a bucket with another one, directly or through others.  All pairs
    of members across the components of a family are compared, in pairs of blocks
    of bounded size; a block pair gives at most a spanning forest of its
    components.  Blocks inside one component are never paired.  Families of less
    than a block share tasks.
    """
    sized = members.select("set_key", "n_shingles").distinct()
    rows = stored(salted_join(sized.join(label, "set_key"), families, "c").select("f", "c", "set_key", "n_shingles"), "family")
    blocks = lambda n, h: F.greatest(F.ceil(n / BLOCK_SETS), F.ceil(h / BLOCK_HASHES)).cast("int")
    sizes = rows.groupBy("f", "c").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("h"))
    sizes = sizes.withColumn("own", blocks(F.col("n"), F.col("h"))).withColumn("part", F.when(F.col("own") > 1, F.col("c")).otherwise(F.lit(b"")))
    parts = sizes.groupBy("f", "part").agg(blocks(F.sum("n"), F.sum("h")).alias("k"), F.sum("n").alias("n"), F.sum("h").alias("h"))
    whole = parts.groupBy("f").agg(F.sum("n").alias("n"), F.sum("h").alias("h"), F.sum("k").alias("all"))
    small = (F.col("n") < BLOCK_SETS // 10) & (F.col("h") < BLOCK_HASHES // 10)
    total = whole.where(small).agg(F.sum("n"), F.sum("h")).first()
    bundles = max(1, -(-10 * (total[0] or 0) // BLOCK_SETS), -(-10 * (total[1] or 0) // BLOCK_HASHES))
    # The task of a small family; larger ones have none here.
    bundle = whole.select(F.col("f"), F.when(small, F.concat(F.lit("all|"), F.pmod(F.xxhash64("f"), F.lit(bundles)).cast("string"))).alias("bundle"))
    parts = parts.select("f", "part", "k").join(bundle, "f")
    parts = stored(sizes.select("f", "c", "part").join(parts, ["f", "part"]), "parts")
    rows = salted_join(rows.drop("f"), parts, "c")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("k")).cast("int"))
    each = parts.where("bundle is null").select("f", "part", "k").distinct().withColumn("block", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select("f", F.struct("part", "block").alias("x"))
    pairs = each.join(each.withColumnRenamed("x", "y"), "f").where((F.col("x") <= F.col("y")) & ((F.col("x.part") != F.col("y.part")) | (F.col("x.part") == F.lit(b""))))
    sides = F.array_distinct(F.array(F.struct(F.col("x").alias("at"), F.lit(0).alias("side")), F.struct(F.col("y").alias("at"), F.when(F.col("x") == F.col("y"), 0).otherwise(1).alias("side"))))
    pairs = pairs.select("f", F.sha2(F.concat_ws("|", F.hex("f"), F.hex("x.part"), "x.block", F.hex("y.part"), "y.block"), 256).alias("pair"), F.explode(sides).alias("s"))
    pairs = pairs.select("f", "pair", F.col("s.side").alias("side"), F.col("s.at.part").alias("part"), F.col("s.at.block").alias("block"))
    tasks = rows.where("bundle is null").join(pairs, ["f", "part", "block"]).select("set_key", "pair", "side", "c")
    tasks = tasks.unionByName(rows.where("bundle is not null").select("set_key", F.col("bundle").alias("pair"), F.lit(0).alias("side"), "c"))
    dealt = sets.join(tasks, "set_key").select("pair", "side", "c", "hashes")

    def compare(t):
        side, comps = t["side"].to_numpy(), t["c"].to_pylist()
        flat = t["hashes"].combine_chunks().flatten().to_numpy()
        size = np.array([len(x) for x in t["hashes"]])
        row = np.repeat(np.arange(len(size)), size)
        # Columns are the hashes of more than one set; the others meet nothing.
        _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        on = count[column] > 1
        order = np.argsort(column[on], kind="stable")
        column, row = column[on][order], row[on][order]
        column = np.cumsum(np.append(0, column[1:] != column[:-1])) if len(column) else column
        left, right = (np.flatnonzero(side == 0),) * 2 if not side.any() else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        kind = np.float32 if size.max(initial=0) < 1 << 24 else np.float64  # counts stay exact
        both = np.zeros((len(left), len(right)), kind)
        for a in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
            i, z = np.searchsorted(column, [a, a + 2048])
            m = np.zeros((len(size), 2048), kind)
            m[row[i:z], column[i:z] - a] = 1
            both += m[left] @ m[right].T
        near = 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)
        root = {c: c for c in comps}

        def top(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        out = []
        name = {c: i for i, c in enumerate(root)}
        code = np.array([name[c] for c in comps])
        i, j = np.nonzero(near & (code[left][:, None] != code[right][None, :]))
        for x, y in np.unique(np.stack([code[left[i]], code[right[j]]], 1), axis=0).tolist() if len(i) else []:
            x, y = top(comps[int(np.argmax(code == x))]), top(comps[int(np.argmax(code == y))])
            if x != y:
                root[x] = y
                out.append((x, y))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    return dealt.groupBy("pair").applyInArrow(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    tune(spark)
    sig = stored(signed(docs), "signatures")
    full = sig.where("n_shingles > 0")
    # The widest shuffle has a row for each set and band: it carries the band's key and 8 bytes of the set's.
    rows = full.groupBy("set_key").agg(F.first("short").alias("short"), F.first("bands").alias("bands")).select("short", F.explode("bands").alias("key"))
    again = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = stored(rows.join(again, "key"), "buckets")
    # Sets that share those 8 bytes, if any do, all go on; comparisons tell them apart.
    classes = full.groupBy("set_key").agg(F.first("short").alias("short"), F.first("n_shingles").alias("n_shingles"), F.min("row_key").alias("row_key"))
    ends = stored(classes.join(found.select("short").distinct(), "short", "left_semi"), "ends")
    with bloom_filters(spark):
        sets = stored(full_sets(docs, ends.where("n_shingles > 0").select("row_key")), "sets")
    members = found.join(ends.select("short", "set_key", "n_shingles"), "short").select("key", "set_key", "n_shingles")
    members = stored(salted_join(members, members.groupBy("key").agg(F.min("set_key").alias("pivot")), "key"), "members")
    dropped(found)
    dropped(ends)

    links = stored(pivot_links(members, sets), "links")
    roots = components(links)
    every = members.select("set_key").distinct()
    label = stored(every.join(roots, F.col("set_key") == F.col("v"), "left").select("set_key", F.coalesce("c", "set_key").alias("c")), "labels")
    dropped(links)
    dropped(roots)

    # Components that meet in a bucket: each is tied to the bucket's smallest.
    meet = members.select("key", "set_key").join(label, "set_key").groupBy("key", "c").agg(F.lit(1).alias("_"))
    low = meet.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("key", "low")
    ties = stored(meet.join(low, "key").where("c <> low").select(F.col("c").alias("a"), F.col("low").alias("b")).distinct(), "ties")
    if not ties.isEmpty():
        families = components(ties).select(F.col("v").alias("c"), F.col("c").alias("f"))
        cross = stored(cross_links(members, sets, label, families), "cross")
        more = components(cross).select(F.col("v").alias("c"), F.col("c").alias("to"))
        better = stored(salted_join(label, more, "c", "left").select("set_key", F.coalesce("to", "c").alias("c")), "labels")
        for t in (families, cross, more, label):
            dropped(t)
        label = better
    dropped(ties)
    dropped(sets)
    dropped(members)

    # Sets in their components: the smallest doc_id of a set, then of a component.
    own = full.groupBy("set_key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    own = own.join(label, "set_key", "left").where("n > 1 or c is not null")
    low = own.where("c is not null").groupBy("c").agg(F.min("first").alias("low"))
    named = stored(salted_join(own, low, "c", "left").select("set_key", F.coalesce("low", "first").alias("first"), F.lit(True).alias("named")), "named")
    dropped(label)
    out = salted_join(sig.select("doc_id", "n_shingles", "set_key"), named, "set_key", "left")
    out = out.withColumn("component_id", F.when(F.col("named") & (F.col("n_shingles") > 0), F.col("first")).otherwise(F.col("doc_id")))
    out = stored(out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")), "components")
    dropped(sig)
    dropped(named)
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    found = near_duplicates(docs)
    # Written, so that Spark knows its size: a short list is broadcast and no text moves, a long one is joined by shuffle.
    gone = stored(found.where("not kept and doc_id is not null").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    dropped(found)
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


#: The same groups in DuckDB's SQL, by comparing all documents that share a shingle.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
r(d, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.d, e.y FROM r JOIN e ON r.c = e.x),
m AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id, w.doc_id = coalesce(m.c, w.doc_id) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN m ON w.doc_id = m.d"""
