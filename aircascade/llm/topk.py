"""Exact top-k search by a Voronoi kNN join.

Vectors are scored by the inner product of floor(1024 * x).  Pivots, made from a
bounded sample, split all vectors into cells; their number grows with the root of
the number of vectors up to ``MOST_PIVOTS``.  A cell is summed up by its radius,
its range of norms, its widest angle to the pivot and the k vectors next to the
pivot.  For a query q and a vector x in the cell of pivot p,

* q.x <= q.p + |q||x - p|,
* q.x <= |q||x|,
* q.x <= |q||x| cos(angle(q, p) - angle(x, p)) where that angle is positive.

The scores of q with the cells' nearest vectors give a score that its k-th best
reaches at least, and a query goes only to the cells whose bound isn't below it.
Every vector goes to its own cell, once for each block of queries asked there,
and not at all if no query can use it.  Blocks of queries and vectors are solved
locally, and the blocks' best are merged.

Only summaries reach the driver: pivots, k vectors and a few numbers for each
cell; none grows beyond what ``MOST_PIVOTS`` allows.  Where vectors lie without
any clusters, no bound excludes a cell, and each query meets each vector.

Defined results: vectors that are null or hold a null or non-finite component
take no part; shorter vectors count as padded with zeros; a null vec_id takes no
part.  Repeated vec_ids are candidates row by row, but never of the query with
their id; a query that occurs in several rows is asked once, with its smallest
vector.  Ties go to the smaller vec_id.  A score beyond 64 bits is an error.  An
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .common import stored, tune

SCALE, K = 1024, 10
#: Fewest and most pivots, and how many vectors of the sample each is made from.
LEAST_PIVOTS, MOST_PIVOTS, SAMPLED = 8, 128, 32
#: Queries of a block and vectors of a block.
QUERY_BLOCK, VECTOR_BLOCK = 8192, 32768


def matrix(column, dim: int) -> np.ndarray:
    """An Arrow column of float lists as scaled integers, exact in float64; shorter lists are padded."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype("f8") * SCALE)
    sizes = np.asarray(column.value_lengths(), dtype="i8") if n else np.zeros(0, "i8")
    if (sizes == dim).all():
        return flat.reshape(n, dim)
    out, begin = np.zeros((n, dim)), np.cumsum([0, *sizes])
    for i in range(n):
        out[i, : sizes[i]] = flat[begin[i] : begin[i + 1]]
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in float64 while that is exact, else in Python integers."""
    most = max(np.abs(q).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * max(q.shape[1], 1)
    if most < 2**53:
        return (q @ x.T).astype("i8")
    return np.array([[sum(int(a) * int(b) for a, b in zip(u, v)) for v in x] for u in q], object).reshape(len(q), len(x))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores; ``ids`` ascend, so equal scores go to the smaller id."""
    if len(scores) > 4 * k and scores.dtype != object:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return at[np.argsort(-scores[at], kind="stable")[:k]]
    return np.array(sorted(range(len(scores)), key=lambda i: -scores[i])[:k], "i8")


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part; components are floats as they come, or doubles."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kind = vectors.schema["embedding"].dataType.elementType
    e = F.col("embedding") if isinstance(kind, (FloatType, DoubleType)) else F.col("embedding").cast("array<double>")
    return vectors.select("vec_id", e.alias("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)


def pivots_of(sample: np.ndarray, n: int) -> np.ndarray:
    """n pivots at most: points of the sample that lie far apart, moved to the middle of what is nearest to them."""
    if not len(sample):
        return sample
    p, far = [sample[0]], np.full(len(sample), np.inf)
    while len(p) < n:
        far = np.minimum(far, ((sample - p[-1]) ** 2).sum(1))
        if not far.max() > 0:
            break
        p.append(sample[int(far.argmax())])
    p = np.array(p)
    for _ in range(5):
        cell = ((sample * sample).sum(1)[:, None] - 2 * (sample @ p.T) + (p * p).sum(1)).argmin(1)
        p = np.array([sample[cell == c].mean(0) if (cell == c).any() else p[c] for c in range(len(p))])
    return np.unique(p, axis=0)


def _angle(products: np.ndarray, norms: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Angles from inner products and norms; 0 where a norm is 0."""
    both = norms * others
    return np.arccos(np.clip(np.divide(products, both, out=np.ones_like(products), where=both > 0), -1, 1))


class Bounds:
    """What the summaries of all cells tell about a query."""

    def __init__(self, p: np.ndarray, cells: list[dict], near: np.ndarray, near_ids: np.ndarray, k: int):
        """``cells`` have cell, radius, least and most (norms) and angle; ``near`` are vectors next to pivots."""
        self.p, self.k, self.near, self.ids = p, k, near, near_ids
        self.norms = np.sqrt((p * p).sum(1))
        self.radius, self.least, self.most, self.angle = (np.zeros(len(p)) for _ in range(4))
        self.there = np.zeros(len(p), bool)
        for c in cells:
            i = c["cell"]
            self.there[i] = True
            self.radius[i], self.least[i], self.most[i], self.angle[i] = c["radius"], c["least"], c["most"], c["angle"]
        self.angle[self.norms == 0] = np.pi

    def needed(self, ids: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each query needs each cell, and how far from the pivot a vector of it must lie at least to be of use."""
        norm, qp = np.sqrt((q * q).sum(1))[:, None], q @ self.p.T
        sure = q @ self.near.T if len(self.near) else np.zeros((len(q), 0))
        sure[ids[:, None] == self.ids] = -np.inf
        floor = -np.sort(-sure, axis=1)[:, self.k - 1 : self.k] if sure.shape[1] >= self.k else np.full((len(q), 1), -np.inf)
        # More than what rounding may do to distances, angles and products.
        floor = floor - 1e-6 * norm * (self.norms.max() + self.most.max()) - 1e-3
        turn = np.cos(np.maximum(0, _angle(qp, norm, self.norms[None, :]) - self.angle))
        bound = np.minimum(qp + norm * self.radius, norm * self.most)
        bound = np.minimum(bound, norm * turn * np.where(turn >= 0, self.most, self.least))
        with np.errstate(divide="ignore", invalid="ignore"):
            far = np.where(norm > 0, (floor - qp) / norm, -np.inf)
        return (bound >= floor) & self.there, far


def celled(rows: DataFrame, p: np.ndarray, dim: int) -> DataFrame:
    """vec_id, embedding, cell, far (from the pivot), norm, angle (to the pivot)."""
    p2, norms = (p * p).sum(1), np.sqrt((p * p).sum(1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1), dim)
            x2, xp = (x * x).sum(1), x @ p.T
            cell = (p2 - 2 * xp).argmin(1)
            at = np.arange(len(x))
            far = np.sqrt(((x - p[cell]) ** 2).sum(1))
            norm = np.sqrt(x2)
            columns = [pa.array(cell.astype("i4")), pa.array(far), pa.array(norm), pa.array(_angle(xp[at, cell], norm, norms[cell]))]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], ["vec_id", "embedding", "cell", "far", "norm", "angle"])

    kind = rows.schema["embedding"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, embedding {kind}, cell int, far double, norm double, angle double")


def summed_up(cells: DataFrame, p: np.ndarray, dim: int, k: int) -> tuple[Bounds, dict[int, int]]:
    """The bounds from all cells' summaries, and the cells' numbers of vectors."""

    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, far = b.column(0).to_numpy(), b.column(1).to_numpy()
            order = np.lexsort((far, cell))
            place = np.arange(len(order)) - np.searchsorted(cell[order], cell[order])
            yield b.take(pa.array(order[place < k]))

    kind = cells.schema["embedding"].dataType.simpleString()
    # k rows a cell and batch go on, so the window sees few rows of even the largest cell.
    w = Window.partitionBy("cell").orderBy("far", "vec_id")
    few = cells.select("cell", "far", "vec_id", "embedding").mapInArrow(nearest, f"cell int, far double, vec_id long, embedding {kind}")
    near = few.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).select("vec_id", "embedding").toArrow()
    rows = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"), F.min("norm").alias("least"), F.max("norm").alias("most"), F.max("angle").alias("angle")).collect()
    return Bounds(p, [r.asDict() for r in rows], matrix(near["embedding"], dim), near["vec_id"].to_numpy(), k), {r["cell"]: r["n"] for r in rows}


def routed(queries: DataFrame, bounds: Bounds, dim: int) -> DataFrame:
    """vec_id, embedding of each query, and ``to``: the cells that it needs, each with the least distance from the pivot that is of use."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            need, far = bounds.needed(b.column(0).to_numpy(), matrix(b.column(1), dim))
            q, cell = np.nonzero(need)
            to = pa.StructArray.from_arrays([pa.array(cell.astype("i4")), pa.array(far[q, cell])], ["cell", "far"])
            ends = np.append(0, np.cumsum(need.sum(1)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), to)], ["vec_id", "embedding", "to"])

    kind = queries.schema["embedding"].dataType.simpleString()
    return queries.select("vec_id", "embedding").mapInArrow(run, f"vec_id long, embedding {kind}, to array<struct<cell:int,far:double>>")


def search(vectors: DataFrame, every: int = 100, k: int = K, pivots: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    tune(spark)
    rows = usable(vectors)
    dim, total = rows.agg(F.max(F.size("embedding")), F.count("*")).first()
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n = pivots or min(MOST_PIVOTS, max(LEAST_PIVOTS, round(total**0.5 / 8)))
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLED * n).select("embedding").toArrow()
    p = pivots_of(matrix(some["embedding"], dim), n)
    cells = stored(celled(rows, p, dim), "cells")
    bounds, sizes = summed_up(cells, p, dim, k)
    queries = cells.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = stored(routed(queries, bounds, dim), "asked")
    to = asked.select("vec_id", "embedding", F.explode("to").alias("to")).select("vec_id", "embedding", "to.cell", "to.far")
    wanted = {r["cell"]: r for r in to.groupBy("cell").agg(F.count("*").alias("n"), F.min("far").alias("far")).collect()}

    # Numbers of each cell, as literals: blocks of vectors and of queries (0: nobody asks), and the least distance of use.
    at = range(len(p))
    x_blocks = F.array([F.lit(-(-sizes.get(c, 1) // VECTOR_BLOCK)) for c in at])
    q_blocks = F.array([F.lit(-(-wanted[c]["n"] // QUERY_BLOCK) if c in wanted else 0) for c in at])
    least = F.array([F.lit(float(wanted[c]["far"]) if c in wanted else float("inf")) for c in at])
    own = lambda a: F.get(a, F.col("cell"))
    q = to.withColumn("q_block", F.pmod(F.xxhash64("vec_id"), own(q_blocks)).cast("int")).withColumn("x_block", F.explode(F.sequence(F.lit(0), own(x_blocks) - 1)))
    q = q.select("cell", "q_block", "x_block", "vec_id", "embedding")
    x = cells.where((own(q_blocks) > 0) & (F.col("far") >= own(least)))
    x = x.withColumn("x_block", F.pmod(F.xxhash64("vec_id", F.lit(7)), own(x_blocks)).cast("int")).withColumn("q_block", F.explode(F.sequence(F.lit(0), own(q_blocks) - 1)))
    x = x.select("cell", "q_block", "x_block", "vec_id", "embedding")

    def solve(left, right):
        ids = right["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, xs = ids[order], matrix(right["embedding"], dim)[order]
        asked, qs = left["vec_id"].to_numpy(), matrix(left["embedding"], dim)
        q_out, v_out, s_out = [], [], []
        for a in range(0, len(asked), 128):  # bounds the scores held at once
            scores = _products(qs[a : a + 128], xs)
            for i, me in enumerate(asked[a : a + 128]):
                others = np.flatnonzero(ids != me)
                at = others[_best(ids[others], scores[i][others], k)]
                q_out += [me] * len(at)
                v_out += ids[at].tolist()
                s_out += [int(s) for s in scores[i][at]]
        return pa.table({"query_id": pa.array(q_out, pa.int64()), "vec_id": pa.array(v_out, pa.int64()), "score": pa.array(s_out, pa.int64())})

    keys = ["cell", "q_block", "x_block"]
    found = q.groupBy(keys).cogroup(x.groupBy(keys)).applyInArrow(solve, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same search in DuckDB's SQL.
SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.e, x.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
