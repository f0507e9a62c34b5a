"""Data checks: each gives the rows that break a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import EVENT


def fold_counts(hits: DataFrame, waveforms: DataFrame, key: list[str] = EVENT) -> DataFrame:
    """key, expected, actual, surplus, percent where hits' nfold and waveforms disagree (per event, or per file)."""
    e = hits.groupBy(*key).agg(F.sum("nfold").alias("expected"))
    a = waveforms.groupBy(*key).agg(F.count("*").alias("actual"))
    both = e.join(a, key, "full").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("expected", "actual")})
    both = both.where("expected <> actual").withColumn("surplus", F.col("actual") - F.col("expected"))
    return both.withColumn("percent", F.when(F.col("actual") > 0, F.col("surplus") / F.col("actual") * 100))


def wrong_owner(traces: DataFrame, waveforms: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Rows of ``traces`` (event, wf_idx, xxyy of the hit) whose waveform is of another detector, or missing."""
    w = waveforms.select(*event, "wf_idx", F.col("xxyy").alias("wf_xxyy"))
    return traces.join(w, [*event, "wf_idx"], "left").where(~F.col("xxyy").eqNullSafe(F.col("wf_xxyy")))


def wrong_offsets(offsets: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Events whose range doesn't begin where the one before ends (the first at 0), or ends before it begins."""
    *file, key = event
    w = Window.partitionBy(*file).orderBy(key)
    before = F.coalesce(F.lag("stop").over(w), F.lit(0))
    return offsets.withColumn("before", before).where((F.col("start") != F.col("before")) | (F.col("stop") < F.col("start")) | (F.col("stop") - F.col("start") != F.col("n")))


def wrong_counts(events: DataFrame, rows: DataFrame, stated: str, event: list[str] = EVENT) -> DataFrame:
    """Events whose ``stated`` number isn't that of their rows."""
    n = rows.groupBy(*event).agg(F.count("*").alias("found"))
    out = events.select(*event, stated).join(n, event, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return out.where(F.col(stated) != F.col("found"))


def differences(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str], tolerance: float = 1e-5) -> DataFrame:
    """column, most, same: the largest difference of each column over matching keys."""
    both = a.alias("a").join(b.alias("b"), keys)
    most = both.agg(*[F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))).alias(c) for c in columns])
    tall = most.unpivot([], columns, "column", "most")
    return tall.withColumn("same", F.coalesce(F.col("most") <= tolerance, F.lit(True)))


def faulty_files(events: DataFrame, hits: DataFrame, waveforms: DataFrame, stated: str = "nhits", event: list[str] = EVENT) -> DataFrame:
    """file_name, n_faulty, first_event, reason of the files in which some event's levels disagree.

    Rules for an event: it stands once, it has as many hits as it states, and its waveforms are as many as
    its hits' nfold.  The three levels meet in one grouped sum, in which each row is a few counters.
    """
    file = event[0]
    zero = {c: F.lit(0).cast("long") for c in ("e", "stated", "h", "folds", "w")}
    level = lambda df, **counters: df.select(*event, *[counters.get(c, z).cast("long").alias(c) for c, z in zero.items()])
    rows = level(events, e=F.lit(1), stated=F.col(stated)).unionByName(level(hits, h=F.lit(1), folds=F.col("nfold"))).unionByName(level(waveforms, w=F.lit(1)))
    sums = rows.groupBy(*event).agg(*[F.sum(c).alias(c) for c in zero])
    wrong = F.when(F.col("e") == 0, "rows without an event").when(F.col("e") > 1, "an event twice").when(F.col("h") != F.col("stated"), "other hits than stated").when(F.col("w") != F.col("folds"), "other waveforms than folds")
    sums = sums.withColumn("reason", wrong).where(F.col("reason").isNotNull())
    first = F.min(F.struct(*event[1:], "reason")).alias("first")
    return sums.groupBy(file).agg(F.count("*").alias("n_faulty"), first).select(file, "n_faulty", F.col(f"first.{event[-1]}").alias("first_event"), "first.reason")


def without_files(tables: dict[str, DataFrame], wrong: DataFrame, file: str = "file_name") -> dict[str, DataFrame]:
    """All levels without the files of ``wrong``: a faulty file goes as a whole."""
    gone = wrong.select(file)
    return {name: df.join(gone, file, "left_anti") for name, df in tables.items()}
