"""Long traces and sparse tables of arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import traces


def to_sparse(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, idx, value of the non-zero elements."""
    return df.select(*keys, F.posexplode(column).alias("idx", "value")).where("value <> 0")


def to_dense(df: DataFrame, sparse: DataFrame, keys: list[str], length: int, column: str) -> DataFrame:
    """Arrays of ``length`` for all keys of ``df``; elements that ``sparse`` doesn't have are 0."""
    m = sparse.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("_s"))
    rows = df.select(*keys).join(m, keys, "left").withColumn("_m", F.map_from_entries(F.coalesce("_s", F.expr("cast(array() as array<struct<idx:int,value:double>>)"))))
    dense = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.coalesce(F.element_at("_m", i), F.lit(0.0)))
    return rows.select(*keys, dense.alias(column))


def is_sparse(df: DataFrame, column: str) -> DataFrame:
    """One row: elements, non-zero ones, and whether the sparse form is the smaller."""
    n = df.select(F.sum(F.size(column)).alias("n"), F.sum(F.size(F.filter(column, lambda x: x != 0))).alias("nonzero"))
    return n.withColumn("sparse", 2 * F.col("nonzero") < F.col("n"))


def long_bins(df: DataFrame, keys: list[str], arrival_ns: str, trace: str) -> DataFrame:
    """keys, bin, value: traces on a common axis, one row a bin, of traces that hold a signal."""
    rows = df.where(traces.total(F.col(trace)) > 0).select(*keys, traces.shift_bins(F.col(arrival_ns)).alias("_s"), F.posexplode(trace).alias("_k", "value"))
    return rows.select(*keys, (F.col("_s") + F.col("_k")).alias("bin"), "value")


def extended(df: DataFrame, group: list[str], arrival_ns: str, trace: str) -> DataFrame:
    """Add ``long_trace``: the trace behind its shift, as long as the latest of its group needs."""
    rows = df.withColumn("_s", traces.shift_bins(F.col(arrival_ns)))
    rows = rows.withColumn("_l", F.max("_s").over(Window.partitionBy(*group)) + F.size(trace))
    zeros = F.array_repeat(F.lit(0.0), F.col("_l"))
    return rows.withColumn("long_trace", F.when(traces.total(F.col(trace)) > 0, traces.placed(F.col(trace), F.col("_s"), F.col("_l"))).otherwise(zeros)).drop("_s", "_l")
