"""Token ids as directly addressable codes.

Each segment of tokens is stored as levels of 8-bit chunks.  Level 0 holds the
low chunk of every id; a continuation bitmap marks the ids that go on, and level
k + 1 holds the next chunk of just those.  A rank directory counts the set bits
before each block of a bitmap, so the place of any id in the next level is one
directory entry plus the bits of one block: any token is read without decoding
its neighbours.

File format: a Parquet table with one row a segment, written by Spark in
ascending document order.  ``part`` and ``seq`` order the segments;
``doc_ids`` and ``doc_ends`` (exclusive, within the segment) give the documents.
A segment is closed by the first document that takes it over its size, so one
document never spans two.

Defined results: a null text counts as empty and gets just its end id; a null
doc_id comes first; rows that share a doc_id are kept, ordered by text; an
empty table gives an empty file set.  Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, tune
from .pieces import encoder

BLOCK = 512
SEGMENT = 1 << 20
SCHEMA = "part int, seq int, n_tokens long, doc_ids array<long>, doc_ends array<long>, levels array<binary>, bitmaps array<binary>, ranks array<binary>"


def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunk levels, continuation bitmaps and rank directories of ids (unsigned 32-bit)."""
    levels, bitmaps, ranks, left = [], [], [], ids.astype("<u4")
    while True:
        levels.append((left & 0xFF).astype("u1").tobytes())
        left = left >> 8
        more = left > 0
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(more) // BLOCK) * BLOCK, "u1")
        padded[: len(more)] = more
        counts = padded.reshape(-1, BLOCK).sum(1, dtype="<u4")
        bitmaps.append(bits.tobytes())
        ranks.append(np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4").tobytes() if len(counts) else b"")
        left = left[more]
        if not len(left):
            return levels, bitmaps, ranks


def unpack(levels: list[bytes], bitmaps: list[bytes], n: int) -> np.ndarray:
    """All ids of a segment."""
    out = np.frombuffer(levels[0], "u1").astype("<u4")
    at = np.arange(n)
    for k in range(1, len(levels)):
        at = at[np.unpackbits(np.frombuffer(bitmaps[k - 1], "u1"), count=len(at), bitorder="little").astype(bool)]
        out[at] |= np.frombuffer(levels[k], "u1").astype("<u4") << np.uint32(8 * k)
    return out


def token_at(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], i: int) -> int:
    """One id: a chunk of each level, found through the rank directories."""
    out = 0
    for k, level in enumerate(levels):
        out |= level[i] << (8 * k)
        bits = bitmaps[k]
        if not bits[i >> 3] >> (i & 7) & 1:
            break
        block, byte = i // BLOCK, i >> 3
        before = int.from_bytes(bits[block * BLOCK // 8 : byte], "little").bit_count() + (bits[byte] & ((1 << (i & 7)) - 1)).bit_count()
        i = int(np.frombuffer(ranks[k], "<u4", 1, 4 * block)[0]) + before
    return out


def _segments(tokenizer: str, end_id: int, size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext


        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        ids, docs, ends, n = [], [], [], 0

        def row() -> pa.RecordBatch:
            levels, bitmaps, ranks = pack(np.frombuffer(b"".join(ids), "<u4"))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.list_(pa.binary())] * 3]
            values = [part, seq, n, docs, ends, levels, bitmaps, ranks]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                got = enc.ids(text.as_py() or "") + end
                ids.append(got)
                n += len(got) // 4
                docs.append(doc)
                ends.append(n)
                if n >= size:
                    yield row()
                    ids, docs, ends, n, seq = [], [], [], 0, seq + 1
        if docs:
            yield row()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, segment: int = SEGMENT) -> None:
    """Encode ``docs`` (doc_id, text) and write them at ``path`` in ascending doc_id order."""
    tune(docs.sparkSession)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_segments(tokenizer, end_id, segment), SCHEMA).write.option("compression", "none").parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """Each segment's first token number: part, seq, base, n_tokens.  One short row a segment meets in the window."""
    w = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(SCHEMA).parquet(path).select("part", "seq", "n_tokens").withColumn("base", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))


def read_documents(spark: SparkSession, path: str, **columns: Callable[[Column], Column]) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens and ``columns`` of the ids.

    Each of ``columns`` makes a column from the ids (little-endian unsigned 32-bit
    integers); without any, the ids themselves come.  They are made before the
    rows meet the segments' places, so what is moved there is as narrow as they are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                raw = unpack(r["levels"], r["bitmaps"], r["n_tokens"]).tobytes()
                begin = [0, *r["doc_ends"][:-1]]
                for k in range(0, len(begin), 1000):
                    a, z = begin[k : k + 1000], r["doc_ends"][k : k + 1000]
                    m = len(a)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["part"]] * m, pa.int32()), pa.array([r["seq"]] * m, pa.int32()), pa.array(r["doc_ids"][k : k + 1000], pa.int64()), pa.array(a, pa.int64()), pa.array([y - x for x, y in zip(a, z)], pa.int64()), pa.array([raw[4 * x : 4 * y] for x, y in zip(a, z)], pa.binary())],
                        ["part", "seq", "doc_id", "at", "n_tokens", "ids"],
                    )

    tune(spark)
    rows = spark.read.schema(SCHEMA).parquet(path).mapInArrow(run, "part int, seq int, doc_id long, at long, n_tokens long, ids binary")
    made = [f(F.col("ids")).alias(name) for name, f in (columns or {"ids": lambda ids: ids}).items()]
    base = starts(spark, path).select("part", "seq", "base")
    rows = rows.select("part", "seq", "doc_id", "at", "n_tokens", *made)
    return rows.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", *(columns or ["ids"]))


def read_tokens(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """Random access: for each ``position`` (a token's number over all files) its ``token``; no other token is decoded.

    Positions meet their segment by an equal-width bucket of token numbers, so no side is broadcast.  Null or out of range positions give a null token.
    """
    width = SEGMENT
    where = starts(spark, path).withColumn("bucket", F.explode(F.sequence(F.floor(F.col("base") / width), F.floor((F.col("base") + F.col("n_tokens") - 1) / width))))
    p = positions.select("position").withColumn("bucket", F.floor(F.col("position") / width))
    hit = p.join(where, (p.bucket == where.bucket) & (p.position >= where.base) & (p.position < where.base + where.n_tokens), "left").select("position", "part", "seq", (F.col("position") - F.col("base")).alias("at"))
    store = spark.read.schema(SCHEMA).parquet(path).select("part", "seq", "levels", "bitmaps", "ranks")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                out += [(p["position"], token_at(r["levels"], r["bitmaps"], r["ranks"], p["at"])) for p in r["wanted"]]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["position", "token"])

    known = hit.where("part is not null")
    # Blocks of 4,096 token places bound what one row gathers, however often a position is asked for.
    wanted = known.distinct().groupBy("part", "seq", F.floor(F.col("at") / 4096).alias("block")).agg(F.collect_list(F.struct("position", "at")).alias("wanted"))
    tokens = wanted.join(store, ["part", "seq"]).select("levels", "bitmaps", "ranks", "wanted").mapInArrow(run, "position long, token long")
    return positions.select("position").join(tokens, "position", "left")


def encoded_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, **columns: Callable[[Column], Column]) -> DataFrame:
    """Write the ids of all documents to a new place in the shared folder and read them back from there."""
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_documents(spark, path, **columns)
