"""Mixing sources to target weights by hash-threshold histograms; DataFrame functions only.

Each document has a fixed pseudo-random place (60 bits from the md5 of its
doc_id).  A source's target is a number of whole passes over it plus a rest, and
the rest is met by the documents below a threshold on that place.  Words are
summed by source and by the place's leading 12 bits; the running sum shows the
one bucket in which the budget ends, and only that bucket is refined by the next
12 bits, down to a single place.  Nothing is sorted, and the last pass is a
filter.  Thresholds are nested: a larger budget takes a superset.  The document
at the boundary is taken if that brings the sum nearer to the target.

Defined results: a null text has size 0; a null source is a source of its own,
the last; rows that share a doc_id share a place and are taken together; a null
doc_id has a place of its own; a very long text counts like any other; an empty
table gives no rows.  Columns other than doc_id, text and source are ignored,
whatever their names; ``repeated`` returns them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

BITS, STEP = 60, 12
#: No document is taken more often than this.
MOST_PASSES = 3


def place(doc_id: Column) -> Column:
    """A document's place, from 0 to 2^60 - 1."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and place, written once: later passes read these narrow rows and no texts."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return stored(docs.select("doc_id", "source", size.alias("size"), place(F.col("doc_id")).alias("place")), "mix")


def targets(rows: DataFrame) -> DataFrame:
    """source, source_size, target: weights 1, 2, 3, repeating, shared until no target is above its cap."""
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row a source meets in these windows.
    s = s.withColumn("w", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    by = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    all_, before, on = Window.partitionBy(F.lit(1)), by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    share = (F.sum("source_size").over(all_) - MOST_PASSES * F.coalesce(F.sum("source_size").over(before), F.lit(0))).cast("double") / F.sum("w").over(on).cast("double")
    s = s.withColumn("share", share).withColumn("cap", F.col("source_size") * F.lit(float(MOST_PASSES)))
    s = s.withColumn("above", F.col("share") * F.col("w") > F.col("cap"))
    last = F.max(F.when(~F.col("above"), F.col("share"))).over(all_)
    return s.select("source", "source_size", F.when(F.col("above"), F.col("cap")).otherwise(last * F.col("w")).alias("target"))


def thresholds(rows: DataFrame) -> DataFrame:
    """source, source_size, target, passes, below: a document is taken ``passes`` times, and once more if its place is below ``below``."""
    t = targets(rows)
    t = t.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    t = stored(t.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-targets")
    edge, rows_left = t.select("source", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"), "rest").where("rest > 0"), rows  # whole passes have no boundary
    for shift in range(BITS - STEP, -1, -STEP):
        e = edge.select(F.col("source").alias("_s"), F.col("prefix").alias("_p"), "before", "rest")
        hit = F.col("source").eqNullSafe(F.col("_s"))
        if shift + STEP < BITS:
            hit &= F.shiftright("place", shift + STEP) == F.col("_p")
        if shift + 2 * STEP == BITS:  # all further passes read just the boundary buckets
            rows_left = stored(rows_left.join(e, hit).select("source", "size", "place"), "mix-edge")
        if shift + STEP == BITS:
            sums = rows_left.groupBy("source", F.shiftright("place", shift).alias("prefix")).agg(F.sum("size").alias("n"))
            sums = sums.join(e.drop("_p"), hit)
        else:
            sums = rows_left.join(e, hit).groupBy("source", F.shiftright("place", shift).alias("prefix"), "before", "rest").agg(F.sum("size").alias("n"))
        w = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 rows a source at most
        sums = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(w), F.lit(0)))
        edge = sums.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest"))).select("source", "prefix", "before", "rest", "n")
        edge = stored(edge, "mix-bucket")
    nearer = F.col("before") + F.col("n") - F.col("rest") < F.col("rest") - F.col("before")
    edge = edge.select(F.col("source").alias("_s"), (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("below"))
    return t.join(edge, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "source_size", "target", "passes", F.coalesce("below", F.lit(0)).alias("below"))


def copies(rows: DataFrame, t: DataFrame) -> DataFrame:
    """Add source_size, target and copies to rows that have ``source`` and ``place``."""
    t = t.withColumnRenamed("source", "_s")
    out = rows.drop("source_size", "target", "copies").join(t, F.col("source").eqNullSafe(F.col("_s")), "left")
    return out.withColumn("copies", F.col("passes") + (F.col("place") < F.col("below")).cast("long")).drop("_s", "passes", "below")


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    rows = sized(docs)
    return copies(rows, thresholds(rows)).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def repeated(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, with its own columns."""
    # Written, so that Spark knows its size: one row a source is broadcast as a rule, and no text moves.
    t = stored(thresholds(sized(docs)), "mix-thresholds")
    rows = docs.select(F.struct("*").alias("row")).select("row", "row.source", place(F.col("row.doc_id")).alias("place"))
    return copies(rows, t).where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS place FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s0),
s2 AS (SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0) AS DOUBLE) / CAST(sum(w) OVER o AS DOUBLE) AS share
  FROM s1 WINDOW b AS (ORDER BY CAST(source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  o AS (ORDER BY CAST(source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
s3 AS (SELECT source, source_size, CASE WHEN share * w > source_size * CAST(3 AS DOUBLE) THEN source_size * CAST(3 AS DOUBLE)
  ELSE max(share) FILTER (WHERE NOT share * w > source_size * CAST(3 AS DOUBLE)) OVER () * w END AS target FROM s2),
t AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM s3),
g AS (SELECT d.source, place, sum(size) AS n FROM d GROUP BY d.source, place),
c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef FROM g),
x AS (SELECT c.source, c.place, t.target - t.passes * t.source_size AS rest, bef, n FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source),
y AS (SELECT source, place, bef + n <= rest OR (bef <= rest AND bef + n - rest < rest - bef) AS more FROM x)
SELECT d.doc_id, d.size, t.source_size, t.target, CAST(d.size * (t.passes + CASE WHEN y.more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN y ON d.source IS NOT DISTINCT FROM y.source AND d.place = y.place"""
