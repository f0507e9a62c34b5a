"""Dumps of any size: sections and line numbers by a segmented scan over splits of files.

A file is never held whole.  Spark deals its splits to tasks, each of which reads its
lines in order; a line knows its split and its place in it.

1. One pass sums up each split: how many lines it has, where its last line with text
   and its marker lines are.  That is a row a split and a row a marker.
2. Running sums over the splits of a file give each split its first line's number,
   and each run of lines behind a marker the numbers of its first event.
3. The second pass adds those to its own places.  It joins lines with a row a split,
   and about two a marker, which Spark broadcasts while they are small; no window, and no
   shuffle then, touches a line.

Both passes read the same listing, so their splits are the same; where they are not
after all (the cluster changed its split size between them), lines find no
split, and the job fails.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names
from ..schema import SECTIONS
from .tables import work_path

SPLIT = ["file_name", "block", "length"]


def opens(line: Column) -> Column:
    """The section that a marker line opens; null for other lines.  Those are told by what every marker holds, in two searches and not one for each marker."""
    out = None
    for marker, section in SECTIONS.items():
        test = F.contains(line, F.lit(marker))
        out = F.when(test, section) if out is None else out.when(test, section)
    return F.when(F.contains(line, F.lit("DATA")) | F.contains(line, F.lit("badsdinfo")), out)


def split_columns(rows: DataFrame, parts: bool = False) -> DataFrame:
    """file_name, block, length, value of text rows with their ``_metadata``: the split that a line comes from.

    With ``parts`` a folder is a dump, and its files are the dump's parts in the order of their names.
    """
    path, start, length = (F.col(f"_metadata.{c}") for c in ("file_path", "file_block_start", "file_block_length"))
    name, block = (names.directory(path), F.struct(names.base_name(path).alias("part"), start.alias("start"))) if parts else (path, start)
    return rows.select(*(c.alias(n) for c, n in zip((name, block, length), SPLIT)), "value")


def placed(rows: DataFrame) -> DataFrame:
    """SPLIT, pos, line: ``pos`` rises by one from line to line of a split.  ``rows`` (SPLIT, value) must come straight from the scan."""
    # The pattern costs more than all else: only lines that end in what it finds, at their end or in front of a last line break, meet it.
    ends = reduce(Column.__or__, (F.endswith(F.col("value"), F.lit("\r" + x)) for x in ("", "\x85", "\u2028", "\u2029")))
    line = F.when(ends, F.regexp_replace("value", r"\r$", "")).otherwise(F.col("value"))
    return rows.select(*SPLIT, F.monotonically_increasing_id().alias("pos"), line.alias("line"))


def split_lines(spark: SparkSession, paths: str | list[str], parts: bool = False) -> DataFrame:
    return placed(split_columns(spark.read.option("lineSep", "\n").text(paths), parts))


def written(df: DataFrame, name: str) -> DataFrame:
    """A small table, written, so that Spark knows its size when it plans the joins."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def summed_splits(lines: DataFrame) -> DataFrame:
    """SPLIT, first (pos), n, before (lines of the file's earlier splits), end (the file's last line with text), width (its lines for one marker) of each split, and its marks (pos, section)."""
    text = F.trim("line") != ""
    mark = opens(F.col("line"))
    per = lines.withColumn("mark", F.when(mark.isNotNull(), F.struct("pos", mark.alias("section"))))
    per = per.groupBy(*SPLIT).agg(F.min("pos").alias("first"), F.count("*").alias("n"), F.max(F.when(text, F.col("pos"))).alias("last"), F.array_sort(F.collect_list("mark")).alias("marks"))
    per = written(per, "splits")
    w = Window.partitionBy("file_name").orderBy("block")
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.withColumn("before", before)
    file = Window.partitionBy("file_name")
    end = F.max(F.col("before") + F.col("last") - F.col("first")).over(file)
    width = F.ceil(F.sum("n").over(file) / F.greatest(F.sum(F.size("marks")).over(file), F.lit(1)))
    return per.withColumns({"end": F.coalesce(end, F.lit(-1)), "width": width}).drop("last")


def runs(splits: DataFrame) -> DataFrame:
    """file_name, part, at, section, base, behind: the runs of lines behind a file's markers, each in every part of the file that it reaches into.

    ``at`` is the marker's line, ``base`` the first event's number, ``behind`` the number of lines.
    A part is ``width`` lines, a file's lines over its markers: so there are at most about two rows
    a marker, and lines meet as many runs as there are lines, however the markers lie.
    """
    m = splits.select("file_name", "before", "first", "end", "width", F.explode("marks").alias("m"))
    m = m.select("file_name", (F.col("before") + F.col("m.pos") - F.col("first")).alias("at"), F.col("m.section").alias("section"), "end", "width")
    behind = Window.partitionBy("file_name").orderBy("at")
    m = m.withColumn("behind", F.coalesce(F.lead("at").over(behind), F.col("end") + 1) - F.col("at") - 1)
    so_far = Window.partitionBy("file_name", "section").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("base", F.coalesce(F.sum("behind").over(so_far), F.lit(0))).where("behind > 0")
    part = lambda line: F.floor(line / F.col("width"))
    parts = F.explode(F.sequence(part(F.col("at") + 1), part(F.col("at") + F.col("behind"))))
    return m.select("file_name", parts.alias("part"), "at", "section", "base", "behind")


def numbered(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """file_name, line_no, line, width; blank lines at a file's end are left out."""
    known = splits.select(*SPLIT, "first", "n", "before", "end", "width")
    rows = lines.join(known, SPLIT, "left").withColumn("_at", F.col("pos") - F.col("first"))
    moved = F.raise_error(F.concat(F.lit("the splits changed between two passes over "), F.col("file_name")))
    right = F.col("n").isNotNull() & (F.col("_at") >= 0) & (F.col("_at") < F.col("n"))
    rows = rows.withColumn("line_no", F.when(right, F.col("before") + F.col("_at")).otherwise(moved.cast("long")))
    # A line without a split must reach the check above, so its missing end keeps it.
    return rows.where(F.col("line_no") <= F.coalesce("end", F.lit(1 << 62))).select("file_name", "line_no", "line", F.coalesce("width", F.lit(1)).alias("width"))


def tagged_splits(lines: DataFrame) -> DataFrame:
    """file_name, section, event_idx, line of lines (SPLIT, pos, line), as ``dumps.tagged`` gives them for numbered lines.

    Runs the first pass at once.
    """
    splits = written(summed_splits(lines), "splits")
    found = written(runs(splits), "runs")
    rows = numbered(lines, splits).where(opens(F.col("line")).isNull()).withColumn("part", F.floor(F.col("line_no") / F.col("width")))
    within = (F.col("line_no") > F.col("at")) & (F.col("line_no") <= F.col("at") + F.col("behind"))
    found = found.withColumnsRenamed({"file_name": "_file", "part": "_part"})
    rows = rows.join(found, (F.col("file_name") == F.col("_file")) & (F.col("part") == F.col("_part")) & within)
    at = F.col("base") + F.col("line_no") - F.col("at") - 1
    # The line depends on its run, so that no filter on its numbers is moved in front of the join, where lines of all sections are.
    return rows.select("file_name", "section", at.cast("int").alias("event_idx"), F.when(F.col("at").isNotNull(), F.col("line")).alias("line"))


def read_tagged(spark: SparkSession, paths: str | list[str], parts: bool = False) -> DataFrame:
    """file_name, section, event_idx, line of dump files, dealt by splits; with ``parts`` of folders that each hold a dump in parts."""
    return tagged_splits(split_lines(spark, paths, parts))
