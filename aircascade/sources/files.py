"""File manifests: which files are read, in which groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators.ordering import in_order


def manifest(spark: SparkSession, dirs: str | list[str], globs: str | list[str] = "*", keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """path, name, dir of the files below ``dirs`` that match one of ``globs`` (lists or comma strings), each once.

    Only paths are read, no content; empty files are left out.  A missing directory is an error.  ``keep``
    is a hook that filters the manifest.
    """
    as_list = lambda x: [p.strip() for p in x.split(",") if p.strip()] if isinstance(x, str) else list(x)
    glob = ",".join(as_list(globs))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"{{{glob}}}").load(as_list(dirs))
    files = files.select("path").distinct()
    files = files.withColumns({"name": names.base_name(F.col("path")), "dir": names.directory(F.col("path"))})
    return keep(files) if keep else files


def numbered(files: DataFrame) -> DataFrame:
    """Add ``n`` (place by path, from 0) and ``total``."""
    return in_order(files, "path", "n", total="total")


def sliced(files: DataFrame, start: int = 0, stop: int | None = None) -> DataFrame:
    f = numbered(files).where(F.col("n") >= start)
    return (f if stop is None else f.where(F.col("n") < stop)).drop("n", "total")


def divided(files: DataFrame, parts: int) -> DataFrame:
    """Add ``part``: ``parts`` runs of equal length, cut at total/parts * i rounded half to even."""
    f = numbered(files)
    cuts = F.transform(F.sequence(F.lit(1), F.lit(parts)), lambda i: F.bround(F.col("total") / parts * i))
    return f.withColumn("part", F.size(F.filter(cuts, lambda c: c <= F.col("n")))).drop("n", "total")


def grouped(files: DataFrame, group: Callable[[Column], Column], jobs: int | None = None) -> DataFrame:
    """Add ``group_id`` by a function of the name, and with ``jobs`` a ``job_id``."""
    f = files.withColumn("group_id", group(F.col("name")))
    return f.withColumn("job_id", names.slot(F.col("group_id"), jobs)) if jobs else f


def outputs(groups: DataFrame, pattern: str) -> DataFrame:
    """job_id, group_id, output, inputs: what each group of files writes (``pattern`` takes the group's number) and its files by name."""
    inputs = F.transform(F.array_sort(F.collect_list(F.struct("name", "path"))), lambda f: f["path"]).alias("inputs")
    return groups.groupBy("job_id", "group_id").agg(inputs).select("job_id", "group_id", F.format_string(pattern, "group_id").alias("output"), "inputs")


def until_date(files: DataFrame, last: int = 160603) -> DataFrame:
    return files.where(names.date_at_most(F.col("name"), last))


def not_ingested(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files of the manifest whose name isn't among ``done`` (file_name)."""
    return files.join(done.select(F.col("file_name").alias("name")).distinct(), "name", "left_anti")
