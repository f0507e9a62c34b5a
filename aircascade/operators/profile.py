"""What a table holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BYTES = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8, "boolean": 1, "timestamp": 8, "date": 4}


def profile(df: DataFrame) -> DataFrame:
    """column, type, n, nulls, low, high, mean_length of each column, in one pass."""
    aggs, cast = [F.count("*").alias("n")], "double"
    for c, t in df.dtypes:
        array, text = t.startswith("array"), t == "string"
        low = F.array_min(c) if array else F.length(c) if text else F.col(c)
        high = F.array_max(c) if array else F.length(c) if text else F.col(c)
        numeric = lambda x, t=t: x.cast("long").cast(cast) if t in ("boolean", "timestamp") else x.cast(cast)
        length = F.size(c) if array else F.length(c) if text else F.lit(1)
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}|nulls"), F.min(numeric(low)).alias(f"{c}|low"), F.max(numeric(high)).alias(f"{c}|high"), F.avg(F.when(F.col(c).isNotNull(), length)).alias(f"{c}|len")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col("n"), F.col(f"`{c}|nulls`").alias("nulls"), F.col(f"`{c}|low`").alias("low"), F.col(f"`{c}|high`").alias("high"), F.col(f"`{c}|len`").alias("mean_length")) for c, t in df.dtypes]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def sizes(df: DataFrame, unit: str = "MB") -> DataFrame:
    """column, size: the values' bytes in ``unit`` (B, KB, MB, GB), and ``total``."""
    units = {"B": 1, "KB": 1 << 10, "MB": 1 << 20, "GB": 1 << 30}
    if unit not in units:
        raise ValueError(f"unknown unit {unit!r}; known: {', '.join(units)}")

    def size(c: str, t: str):
        if t == "string":
            return F.octet_length(c)
        if t.startswith("array<"):
            return F.size(c) * _BYTES.get(t[6:-1], 8)
        return F.lit(_BYTES.get(t, 8))

    one = df.agg(*[F.sum(size(c, t)).alias(c) for c, t in df.dtypes])
    tall = one.unpivot([], df.columns, "column", "bytes")
    total = tall.agg(F.lit("total").alias("column"), F.sum("bytes").alias("bytes"))
    return tall.unionByName(total).select("column", (F.col("bytes") / units[unit]).alias("size"))


def listing(tables: dict[str, DataFrame]) -> DataFrame:
    """table, column, type, metadata of named tables; a column's level is the table it is in."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, f.name, f.dataType.simpleString(), str(f.metadata or "")) for name, df in tables.items() for f in df.schema]
    return spark.createDataFrame(rows, "table string, column string, type string, metadata string")


def level_counts(events: DataFrame, hits: DataFrame, traces: DataFrame) -> DataFrame:
    """file_name, n_events, n_hits, n_traces."""
    n = lambda df, name: df.groupBy("file_name").agg(F.count("*").alias(name))
    out = n(events, "n_events").join(n(hits, "n_hits"), "file_name", "left").join(n(traces, "n_traces"), "file_name", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_hits", "n_traces")})


def levels(tables: dict[str, DataFrame], known: dict[str, DataFrame], by: str = "file_name") -> DataFrame:
    """table, level, matches, n_rows of ``tables`` of unknown level: those of ``known`` that have as many rows in every file.

    A table without rows matches levels without rows.  ``level`` is the only match; null if there is none, or
    more than one.  Only the file's name is read of each table, and one grouped count of all tables is what is compared.
    """
    spark = next(iter([*tables.values(), *known.values()])).sparkSession
    count = lambda df, name: df.groupBy(F.col(by).alias("_f")).agg(F.count("*").alias("n")).withColumn("name", F.lit(name))
    all_ = lambda dfs: reduce(DataFrame.unionByName, [count(df, name) for name, df in dfs.items()])
    mine, theirs = all_(tables), all_(known).withColumnRenamed("name", "level")
    files = theirs.groupBy("level").agg(F.count("*").alias("level_files"))
    each = F.explode(F.array(*map(F.lit, known))).alias("level")
    same = mine.select("name", "_f", "n", each).join(theirs.withColumnRenamed("n", "m"), ["level", "_f"], "left")
    same = same.groupBy("name", "level").agg(F.count("*").alias("files"), F.count_if(F.col("n") == F.col("m")).alias("equal"), F.sum("n").alias("n_rows"))
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, tables))).alias("name")).select("name", each)
    all_pairs = names.join(same, ["name", "level"], "left").join(files, "level", "left").na.fill(0, ["files", "equal", "n_rows", "level_files"])
    fits = (F.col("equal") == F.col("files")) & (F.col("files") == F.col("level_files"))
    out = all_pairs.groupBy("name").agg(F.array_sort(F.collect_list(F.when(fits, F.col("level")))).alias("matches"), F.max("n_rows").alias("n_rows"))
    return out.select(F.col("name").alias("table"), F.when(F.size("matches") == 1, F.get("matches", 0)).alias("level"), F.array_join("matches", ",").alias("matches"), "n_rows")
