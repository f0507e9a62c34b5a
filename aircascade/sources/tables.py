"""Side tables and stored tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names
from ..functions.shower_depth import bin_exponent


def energy_grid(spark: SparkSession) -> DataFrame:
    """bin, mid, low, high in EeV: 51 bins of a tenth of a decade from 10^16 eV on."""
    at = F.lit(16.0) + F.col("id") / 10 - 18
    ten = F.lit(10.0)
    return spark.range(51).select(F.col("id").cast("int").alias("bin"), F.pow(ten, at).alias("mid"), F.pow(ten, at - F.lit(0.05)).alias("low"), F.pow(ten, at + F.lit(0.05)).alias("high"))


def energy_index(spark: SparkSession) -> DataFrame:
    """energy_index (0..40, of file names), bin, mid."""
    idx = spark.range(41).select(F.col("id").cast("int").alias("energy_index"), bin_exponent(F.col("id")).cast("int").alias("bin"))
    return idx.join(F.broadcast(energy_grid(spark)), "bin").select("energy_index", "bin", "mid")


def read_detectors(spark: SparkSession, path: str) -> DataFrame:
    """xxyy, x_cm, y_cm, z_cm from CSV or Parquet."""
    if path.endswith(".csv"):
        return spark.read.schema("xxyy int, x_cm double, y_cm double, z_cm double").csv(path, header=True)
    return spark.read.parquet(path).select("xxyy", "x_cm", "y_cm", "z_cm")


def parse_depths(lines: DataFrame) -> DataFrame:
    """dir, file_idx, n_events, zenith_deg, xmax of lines (path, line_no, value); the slant depth is xmax / cos(zenith)."""
    rows = lines.where((F.trim("value") != "") & ~F.startswith(F.trim("value"), F.lit("#"))).withColumn("v", F.split(F.trim("value"), r"\s+"))
    v = lambda i: F.get("v", i)
    zenith = v(2).cast("double")
    return rows.select("path", "line_no", names.directory(F.col("path")).alias("dir"), v(0).alias("file_idx"), v(1).cast("int").alias("n_events"), zenith.alias("zenith_deg"), (v(3).cast("double") / F.cos(F.radians(zenith))).alias("xmax"))


def read_depths(spark: SparkSession, path: str, glob: str = "DAT*_xmax.txt") -> DataFrame:
    files = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path, wholetext=True)
    lines = files.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\n")).alias("line_no", "value"))
    return parse_depths(lines)


def first_depths(depths: DataFrame, keys: list[str]) -> DataFrame:
    """The first depth of each key, by path and line."""
    return depths.groupBy(*keys).agg(F.min_by("xmax", F.struct("path", "line_no")).alias("xmax0"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None, mode: str = "errorifexists", floats: bool = False, skip: list[str] | None = None) -> int:
    """Write a Parquet table and count it back; doubles become floats with ``floats``, columns of ``skip`` are left out.

    An error, if the table then holds another number of rows than the write put out
    (with ``append``: than it held before and the write put out).  Mode ``ignore``
    may write nothing and isn't compared.
    """
    df = df.drop(*(skip or []))
    if floats:
        df = as_floats(df)
    if partition_by:
        df = df.repartition(*partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    before, put = _rows_at(df.sparkSession, path) if mode == "append" else 0, Observation()
    # Counted in the last stage of the write, so a task that runs again isn't counted twice.
    w = df.observe(put, F.count(F.lit(1)).alias("n")).write.mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    have = df.sparkSession.read.parquet(path).count()
    if mode != "ignore" and have != before + put.get["n"]:
        raise ValueError(f"{path} holds {have} rows, not {before + put.get['n']}")
    return have


def _rows_at(spark: SparkSession, path: str) -> int:
    """Rows of a table, 0 where there is none."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def as_floats(df: DataFrame) -> DataFrame:
    """Doubles as floats, in arrays too."""
    return df.select([F.col(c).cast(t.replace("double", "float")).alias(c) if "double" in t else F.col(c) for c, t in df.dtypes])


def compact(spark: SparkSession, paths: list[str], out: str, files: int, skip: list[str] | None = None) -> int:
    """Merge stored tables into one with ``files`` files."""
    parts = [spark.read.option("mergeSchema", "true").parquet(p) for p in paths]  # each with partitions of its own
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return write_table(both.drop(*(skip or [])).repartition(files), out)


def append(df: DataFrame, path: str, info: dict[str, str] | None = None) -> None:
    """Append rows; ``info`` is kept as metadata of the columns."""
    for c, text in (info or {}).items():
        df = df.withMetadata(c, {"info": text})
    df.write.mode("append").parquet(path)


def narrowed(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Unsigned integer columns in the smallest signed type that holds them; a negative value is an error."""
    columns = columns or [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint")]
    ends = df.agg(*[F.min(c).alias(f"min_{c}") for c in columns], *[F.max(c).alias(f"max_{c}") for c in columns]).first()
    out = {}
    for c in columns:
        low, high = ends[f"min_{c}"], ends[f"max_{c}"]
        if low is not None and low < 0:
            raise ValueError(f"{c} holds negative numbers")
        if high is not None:
            out[c] = F.col(c).cast(narrow_type(high))
    return df.withColumns(out)


def narrow_type(high: int) -> str:
    """The smallest type whose largest value lies above ``high``."""
    return next((t for t, bits in (("byte", 7), ("short", 15), ("int", 31)) if high < (1 << bits) - 1), "long")


def per_file(events: DataFrame) -> DataFrame:
    """file_name, n, start, file_no: events of each file, their first global number and the file's own number.

    One row of sums a file meets in the window (fine up to some millions of files), so the events are read once.
    """
    n = events.groupBy("file_name").agg(F.count("*").alias("n"))
    w = Window.orderBy("file_name")
    ahead = w.rowsBetween(Window.unboundedPreceding, -1)
    return n.withColumns({"start": F.coalesce(F.sum("n").over(ahead), F.lit(0)), "file_no": F.row_number().over(w) - 1})


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); without one a local session gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="aircascade-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
