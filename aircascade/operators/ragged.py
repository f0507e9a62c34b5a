"""Variable-length datasets: keyed event, hit and trace tables instead of arrays with offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import traces
from ..schema import EVENT
from . import hits as H


def offsets(events: DataFrame, rows: DataFrame, mask=None, event: list[str] = EVENT) -> DataFrame:
    """event, n, start, stop: rows of each event (those of ``mask`` only) and their range in the file; empty events have n = 0."""
    n = rows.groupBy(*event).agg((F.count("*") if mask is None else F.count_if(mask)).alias("n"))
    out = events.select(*event).join(n, event, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    *file, key = event
    w = Window.partitionBy(*file).orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.withColumn("stop", F.sum("n").over(w)).withColumn("start", F.col("stop") - F.col("n")).select(*event, "n", "start", "stop")


def trace_rows(hits: DataFrame, waveforms: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """event, hit_idx, fold_idx and both layers' calibrated traces (float) of good hits; waveforms must match by position."""
    w = hits.select(*event, "hit_idx", "isgood", "nfold", "vem_low", "vem_up")
    rows = H.positional_match(w, waveforms.select(*event, "wf_idx", "fadc_low", "fadc_up"), event).where(F.col("isgood") > H.GOOD)
    trace = [traces.calibrated(F.col(f"fadc_{s}"), F.col(f"vem_{s}")).cast("array<float>").alias(f"time_traces_{s}") for s in ("low", "up")]
    return rows.select(*event, "hit_idx", "fold_idx", *trace)


def hit_features(hits: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """The hit level: arrival_times[2] in counter units, pulse_area[2], detector_positions[3], status, nfold, detector_ids of good hits."""
    rows = H.good_hits(hits)
    return rows.select(
        *event, "hit_idx", F.array("reltime_low", "reltime_up").alias("arrival_times"), F.array("pulsa_low", "pulsa_up").alias("pulse_area"),
        F.array("x", "y", "z").alias("detector_positions"), F.col("isgood").alias("status"), "nfold", F.col("xxyy").alias("detector_ids"),
    )


def matched(hits: DataFrame, waveforms: DataFrame, event: list[str] = EVENT) -> tuple[DataFrame, DataFrame]:
    """Waveforms that belong to hits, numbered by position, and events without a match.  Events whose counts agree pass as they are."""
    want = hits.groupBy(*event).agg(F.sum("nfold").alias("want"))
    have = waveforms.groupBy(*event).agg(F.count("*").alias("have"))
    odd = want.join(have, event, "full").where(F.coalesce("want", F.lit(0)) != F.coalesce("have", F.lit(0))).select(*event)
    fixed, broken = H.greedy_match(hits.join(odd, event, "left_semi"), waveforms.join(odd, event, "left_semi"), event)
    plain = waveforms.join(odd, event, "left_anti")
    return plain.unionByName(fixed.drop("raw_wf_idx")), broken


def hit_traces(trace: DataFrame, column: str, event: list[str] = EVENT) -> DataFrame:
    """One row a hit: its traces in order of their folds, and joined to one long trace."""
    rows = trace.groupBy(*event, "hit_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("fold_idx", column))), lambda x: x[column]).alias("folds"))
    return rows.withColumn("long_trace", F.flatten("folds"))


def globally_numbered(events: DataFrame, files: DataFrame) -> DataFrame:
    """Events with ``gidx``, their number over all files; ``files`` comes from per_file.  No window runs over the events of all files."""
    dense = F.row_number().over(Window.partitionBy("file_name").orderBy("event_idx")) - 1
    return events.withColumn("_d", dense).join(files.select("file_name", "start"), "file_name").withColumn("gidx", F.col("start") + F.col("_d")).drop("_d", "start")


def event_slice(numbered: DataFrame, start: int, stop: int) -> DataFrame:
    return numbered.where((F.col("gidx") >= start) & (F.col("gidx") < stop))


def located(indices: DataFrame, files: DataFrame) -> DataFrame:
    """gidx, file_no, file_name, local_idx of global numbers; out of range gives nulls.  ``files`` comes from per_file.

    Files meet numbers by equal-width buckets, so neither side must be small.
    """
    width = 1 << 16
    f = files.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("n") - 1) / width))))
    i = indices.select("gidx").withColumn("bucket", F.floor(F.col("gidx") / width))
    hit = (i.bucket == f.bucket) & (i.gidx >= f.start) & (i.gidx < f.start + f.n)
    return i.join(f, hit, "left").select("gidx", "file_no", "file_name", (F.col("gidx") - F.col("start")).alias("local_idx"))
