"""Tables in the order of their numbers, with an index of their files: a slice opens only the files it needs.

A chunk is appended as files that each hold a run of the chunk's rows in order.
The index has a row a file: its first row's key, its rows, and the number of its first row
in the whole table.  An append adds its own files' rows to the index, on top of the
largest number so far; nothing is counted again.  Only what the index lists is read, so an append that
failed before its index was written has left nothing, and is written over when it runs again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

INDEX = "path string, n long, start long, chunk int"


def index_of(spark: SparkSession, table: str) -> DataFrame:
    """path, n, start, chunk of each file."""
    try:
        return spark.read.schema(INDEX).parquet(f"{table}/index")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], INDEX)


def append_ordered(rows: DataFrame, table: str, by: list[str], files: int) -> int:
    """Append ``rows`` in the order of ``by`` as about ``files`` files; gives the chunk's number.  Keys must be unique in a chunk for numbers to be stable."""
    spark = rows.sparkSession
    last = index_of(spark, table).agg(F.max("chunk"), F.max(F.col("start") + F.col("n"))).first()
    chunk, base = (-1 if last[0] is None else last[0]) + 1, last[1] or 0
    data = f"{table}/data/chunk={chunk}"
    rows.repartitionByRange(files, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(data)
    new = spark.read.parquet(data).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"), F.min(F.struct(*by)).alias("low"))
    ahead = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)  # a row a file of this chunk
    new = new.select("path", "n", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) + F.lit(base)).cast("long").alias("start"))
    new.coalesce(1).write.mode("overwrite").parquet(f"{table}/index/chunk={chunk}")
    return chunk


def sliced_rows(spark: SparkSession, table: str, by: list[str], start: int, stop: int, step: int = 1) -> DataFrame:
    """The rows numbered from ``start`` to before ``stop``, with ``gidx``; only files that hold some of them are opened."""
    if step != 1:
        raise ValueError("a slice has step 1")
    if start < 0 or stop < start:
        raise ValueError("a slice goes from a number that isn't negative to one that isn't smaller")
    index = index_of(spark, table)
    need = index.where((F.col("start") < stop) & (F.col("start") + F.col("n") > start) & (F.lit(stop) > start))
    paths = [r["path"] for r in need.select("path").collect()]  # as many as the slice has files
    if not paths:
        some = index.select("path").limit(1).collect()
        if not some:
            raise ValueError(f"{table} is empty")
        return spark.read.parquet(some[0]["path"]).where("false").withColumn("gidx", F.lit(0).cast("long"))
    rows = spark.read.parquet(*paths).withColumn("_path", F.col("_metadata.file_path"))
    at = F.row_number().over(Window.partitionBy("_path").orderBy(*by)) - 1
    rows = rows.withColumn("_at", at).join(need.select(F.col("path").alias("_path"), "start"), "_path")
    rows = rows.withColumn("gidx", F.col("start") + F.col("_at")).drop("_path", "_at", "start")
    return rows.where((F.col("gidx") >= start) & (F.col("gidx") < stop))
