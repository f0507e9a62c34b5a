"""Numbers and running totals over the order of a whole table, without one task that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that the rows are dealt to, at least.
RANGES = 64
#: Rows a range on average, at most; a table of more than RANGES times as many gets more ranges.
ROWS = 1_000_000


def _range_of(rows: DataFrame, by: str, size: int) -> Column:
    """The range of a value of ``by``: how many cuts, values picked by their hash, are no larger.  Nulls come first.

    One cut for ``size`` rows, or RANGES - 1, is what the driver holds.
    """
    keys = rows.select(by).where(F.col(by).isNotNull())
    cuts = [r[0] for r in keys.orderBy(F.xxhash64(by), by).limit(max(RANGES, -(-rows.count() // size)) - 1).orderBy(by).collect()]

    def below(low: int, high: int) -> Column:
        """By halves, in plain comparisons: an array's filter would compute ``by``, where that is an expression, once a cut."""
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(F.col(by) < cuts[mid], below(low, mid)).otherwise(below(mid + 1, high))

    return F.when(F.col(by).isNotNull(), below(0, len(cuts))).otherwise(0)


def in_order(rows: DataFrame, by: str, place: str, total: str | None = None, before: dict[str, str] | None = None, size: int = ROWS) -> DataFrame:
    """Add ``place``, a row's number from 0 in the order of ``by``.

    ``total`` names a column for the number of all rows; ``before`` maps new columns
    to those whose running total in front of a row they hold.  Windows run within a
    range, and ranges hold about ``size`` rows however many there are; what meets in
    one task, and is broadcast, is one row of sums a range.
    The order of rows with equal ``by`` is open.
    """
    before = before or {}
    rows = rows.withColumn("_range", _range_of(rows, by, size))
    sums = rows.groupBy("_range").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_sum_{name}") for name, c in before.items()])
    ahead, all_ = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    so_far = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    sums = sums.select("_range", F.sum("_n").over(all_).alias("_all"), so_far("_n", ahead).alias("_n"), *[so_far(f"_sum_{name}", ahead).alias(f"_sum_{name}") for name in before])
    here = Window.partitionBy("_range").orderBy(by)
    added = {place: F.row_number().over(here) - 1 + F.col("_n")}
    added |= {name: so_far(c, here.rowsBetween(Window.unboundedPreceding, -1)) + F.col(f"_sum_{name}") for name, c in before.items()}
    if total:
        added[total] = F.col("_all")
    return rows.join(F.broadcast(sums), "_range").withColumns(added).drop("_range", "_n", "_all", *[f"_sum_{name}" for name in before])
