"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: One or more ASCII white space characters.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small, as one row may be a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is set, a local session (tests) gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = found.get() if found.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="aircascade-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings (dots as double underscores) that hold meanwhile."""
    names = {k: "spark.sql." + k.replace("__", ".") for k in values}
    before = {k: spark.conf.get(n, None) for k, n in names.items()}
    for k, n in names.items():
        spark.conf.set(n, values[k])
    try:
        yield
    finally:
        for k, n in names.items():
            spark.conf.unset(n) if before[k] is None else spark.conf.set(n, before[k])


def shuffles_dropped(spark: SparkSession):
    """Shuffle files of a job that runs meanwhile go as soon as it has ended."""
    return _settings(spark, classic__shuffleDependency__fileCleanup__enabled="true")


def bloom_filters(spark: SparkSession):
    """Let Spark filter the large side of a join by a Bloom filter of the small side's keys, of 8 MB at most, before rows move.

    Where the small side is above 64 MB Spark goes without, and all rows of the large side move.
    """
    bloom = "optimizer__runtime__bloomFilter__"
    return _settings(spark, **{f"{bloom}enabled": "true", f"{bloom}applicationSideScanSizeThreshold": "0", f"{bloom}creationSideThreshold": "64MB"})


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: this cuts the lineage and outlives executors.

    The shuffles behind a written table aren't needed any more, so their files are dropped.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` gave; nothing that is still to run may read it."""
    spark = df.sparkSession
    shared = shared_dir(spark).removeprefix("file:").rstrip("/")
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if shared in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def salted_join(many: DataFrame, few: DataFrame, key: str, how: str = "inner", salts: int = 8) -> DataFrame:
    """Join on ``key``, of which ``few`` has each value once; rows of ``many`` that share a value are dealt over ``salts`` tasks."""
    salt = "_salt"
    # Spark takes the repeated side for as small as it was before, so it is told not to broadcast it.
    few = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    spread = F.pmod(F.xxhash64(*many.columns), F.lit(salts)).cast("int")
    return many.withColumn(salt, spread).join(few, [key, salt], how).drop(salt)


def words(text: Column) -> Column:
    """The words of a text as an array; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")
