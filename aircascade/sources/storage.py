"""Stored tables whose arrays are dense or sparse, whichever is smaller, and that are compared with what was meant before they count.

An array column is stored sparse (its size, and places and values of what isn't zero)
if less than half of its elements are not zero; one aggregate over the table decides for all
columns.  The choice is kept as metadata of the column and undone on reading.

A table is written to a staging folder, read back as a reader would, and summed up
by an order-free checksum.  Where that isn't the checksum of the rows that were
meant, the folder goes and the write is tried again; only a table that agrees is renamed to
its final name, so a reader never sees a part of one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Attempts before a write is given up.
ATTEMPTS = 5
#: The key of a column's metadata that tells that it is stored sparse.
SPARSE = "sparse"


def array_columns(df: DataFrame) -> dict[str, str]:
    """The columns that are arrays of numbers, at any depth, and their types."""
    return {c: t for c, t in df.dtypes if re.fullmatch(r"(array<)+(tinyint|smallint|int|bigint|float|double)>+", t)}


def _flat(c: Column, kind: str) -> Column:
    for _ in range(kind.count("array<") - 1):
        c = F.flatten(c)
    return c


def _full(x: Column) -> Column:
    """An element that must be kept: not zero, or null."""
    return x.isNull() | (x != 0)


def fill(df: DataFrame) -> DataFrame:
    """column, n, nonzero, sparse of each array column, by one aggregate; arrays of arrays are looked at but stay dense."""
    kinds = array_columns(df)
    if not kinds:
        return df.sparkSession.createDataFrame([], "column string, n long, nonzero long, sparse boolean")
    flat = {c: _flat(F.col(c), t) for c, t in kinds.items()}
    sums = [s.alias(f"{c}|{what}") for c, a in flat.items() for what, s in (("n", F.sum(F.size(a))), ("nonzero", F.sum(F.size(F.filter(a, _full)))))]
    one = df.select(*kinds).agg(*sums)
    count = lambda c, what: F.coalesce(F.col(f"`{c}|{what}`"), F.lit(0))
    rows = [F.struct(F.lit(c).alias("column"), count(c, "n").alias("n"), count(c, "nonzero").alias("nonzero"), ((2 * count(c, "nonzero") < count(c, "n")) & F.lit(t.count("array<") == 1)).alias("sparse")) for c, t in kinds.items()]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def encoded(df: DataFrame, sparse: list[str]) -> DataFrame:
    """``df`` with the columns of ``sparse`` as (size, idx, value), marked in their metadata."""
    out = {}
    for c in sparse:
        pairs = F.filter(F.transform(c, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: _full(p["x"]))
        whole = F.struct(F.size(c).alias("size"), F.transform(pairs, lambda p: p["i"]).alias("idx"), F.transform(pairs, lambda p: p["x"]).alias("value"))
        out[c] = F.when(F.col(c).isNotNull(), whole)
    df = df.withColumns(out)
    for c in sparse:
        df = df.withMetadata(c, {**(df.schema[c].metadata or {}), SPARSE: True})
    return df


def _dense(s: Column, element: str) -> Column:
    """The array behind (size, idx, value): each value brings the run of zeros before it, and the last run follows."""
    zero, none = F.lit(0).cast(element), F.array().cast(f"array<{element}>")
    ends = F.concat(s["idx"], F.array(s["size"]))

    def run(end: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(ends, i - 1)).otherwise(-1)
        return F.concat(F.array_repeat(zero, end - before - 1), F.when(i < F.size(s["idx"]), F.array(F.get(s["value"], i))).otherwise(none))

    return F.when(s.isNotNull(), F.flatten(F.transform(ends, run)))


def decoded(df: DataFrame) -> DataFrame:
    """Columns that ``encoded`` made, as the arrays they were; elements that aren't stored are zero."""
    sparse = [f for f in df.schema if (f.metadata or {}).get(SPARSE)]
    return df.withColumns({f.name: _dense(F.col(f.name), f.dataType["value"].dataType.elementType.simpleString()) for f in sparse})


def checksum(df: DataFrame) -> tuple:
    """The number of rows and two sums of their hashes: equal for tables that hold the same rows in any order.  -0.0 counts as 0.0."""
    even = lambda c, t: F.transform(c, lambda x: x + F.lit(0.0)) if t in ("array<double>", "array<float>") else F.col(c)
    columns = [even(c, t) for c, t in sorted(df.dtypes)]
    hashes = [F.xxhash64(*columns, F.lit(k)) for k in (0, 1)]
    total = [F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string") for h in hashes]
    return tuple(df.agg(F.count("*"), *total).first())


def write_audited(df: DataFrame, path: str, attempts: int = ATTEMPTS, after_write: Callable[[str], None] | None = None) -> int:
    """Write ``df`` to the new table ``path``, audited, and give its rows.  ``after_write`` is called with each staging folder (tests damage it).

    ``df`` is computed for the choice of columns, the checksum and the write, so a dear one should be stored or persisted first.
    """
    spark = df.sparkSession
    sparse = [r["column"] for r in fill(df).where("sparse").collect()]  # one row a column
    want, seen = checksum(df), []
    for _ in range(attempts):
        staging = f"{path}._staging_{uuid.uuid4().hex}"
        encoded(df, sparse).write.parquet(staging)
        if after_write:
            after_write(staging)
        have = checksum(read_audited(spark, staging))
        if have == want:
            _renamed(spark, staging, path)
            return want[0]
        seen.append(have)
        _deleted(spark, staging)
    raise ValueError(f"{path}: {attempts} writes read back otherwise than meant: {want} wanted, {seen} found")


def read_audited(spark: SparkSession, path: str) -> DataFrame:
    return decoded(spark.read.parquet(path))


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _renamed(spark: SparkSession, staging: str, path: str) -> None:
    to, fs = _folder(spark, path)
    if fs.exists(to):
        _deleted(spark, staging)
        raise FileExistsError(path)
    if not fs.rename(_folder(spark, staging)[0], to):
        raise OSError(f"{staging} could not be renamed to {path}")


def _deleted(spark: SparkSession, path: str) -> None:
    p, fs = _folder(spark, path)
    fs.delete(p, True)
