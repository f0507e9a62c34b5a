"""Operators on hits and their waveforms.  ``event`` names the columns of an event's key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import EVENT

GOOD = 2


def first_hits(hits: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """The first hit of each detector in an event.  Hits are dealt by their event alone, as all that follows needs them."""
    w = Window.partitionBy(*event).orderBy("xxyy", "hit_idx")
    rows = hits.withColumns({"_n": F.row_number().over(w), "_before": F.lag("xxyy").over(w)})
    return rows.where((F.col("_n") == 1) | ~F.col("xxyy").eqNullSafe(F.col("_before"))).drop("_n", "_before")


def good_hits(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("isgood") > GOOD)


def tile_hits(hits: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Hits that count for tiles: the first of each detector, if that one is good.

    The order matters: a later good hit doesn't bring back a detector whose first is not.
    """
    return good_hits(first_hits(hits, event))


def duplicates(hits: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Detectors with more than one hit in an event, and how many."""
    return hits.groupBy(*event, "xxyy").agg(F.count("*").alias("n")).where("n > 1")


def surviving(events: DataFrame, hits: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Events that have a hit left."""
    return events.join(hits.select(*event), event, "left_semi")


def loudest(hits: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """hit_idx and xxyy of each event's hit with the largest mean signal, the first of equals."""
    signal = (F.col("pulsa_low") + F.col("pulsa_up")) / 2
    best = F.max_by(F.struct("hit_idx", "xxyy", signal.alias("signal")), F.struct(signal.alias("s"), (-F.col("hit_idx")).alias("i")))
    return hits.groupBy(*event).agg(best.alias("b")).select(*event, "b.*")


def first_waveforms(hits: DataFrame, waveforms: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Each hit with the first waveform of its detector in its event."""
    w = Window.partitionBy(*event, "xxyy").orderBy("wf_idx")
    first = waveforms.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return hits.join(first.hint("merge"), [*event, "xxyy"])  # waveforms are wider than Spark takes them for


def without_waveform(hits: DataFrame, waveforms: DataFrame, event: list[str] = EVENT) -> DataFrame:
    return hits.join(waveforms.select(*event, "xxyy"), [*event, "xxyy"], "left_anti")


def _started(hits: DataFrame, event: list[str]) -> DataFrame:
    """Hits that own waveforms, with the place in their event of the first (hits own waveforms in their order)."""
    w = Window.partitionBy(*event).orderBy("hit_idx").rowsBetween(Window.unboundedPreceding, -1)
    return hits.withColumn("_start", F.coalesce(F.sum("nfold").over(w), F.lit(0))).where("nfold > 0")


def folds(hits: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """One row for each waveform that a hit has: fold_idx within the hit, wf_idx within the event."""
    rows = _started(hits, event).withColumn("fold_idx", F.explode(F.sequence(F.lit(0), F.col("nfold") - 1)))
    return rows.withColumn("wf_idx", (F.col("_start") + F.col("fold_idx")).cast("int")).drop("_start")


def positional_match(hits: DataFrame, waveforms: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Hits with their waveforms where counts agree: hit k owns the next nfold waveforms.

    They meet by their event, as both are dealt, and a hit takes the waveforms of its range: a join
    by the waveform's number as well would move both sides again, a row a waveform.
    """
    rows = _started(hits, event).drop("xxyy").join(waveforms.hint("merge"), event)
    rows = rows.where((F.col("wf_idx") >= F.col("_start")) & (F.col("wf_idx") < F.col("_start") + F.col("nfold")))
    return rows.withColumn("fold_idx", (F.col("wf_idx") - F.col("_start")).cast("int")).drop("_start")


def greedy_match(hits: DataFrame, waveforms: DataFrame, event: list[str] = EVENT) -> tuple[DataFrame, DataFrame]:
    """Match hits to waveforms in order by detector, skipping surplus waveforms.

    Gives the matched waveforms, numbered anew as ``wf_idx`` with their old number
    as ``raw_wf_idx``, and the events in which some hit stays without its waveforms.
    Waveforms move once: an event's are walked where they meet its hits, as arrays.
    """
    ordered = F.array_sort(F.collect_list(F.struct("hit_idx", "xxyy", "nfold")))
    flat = F.flatten(F.transform(ordered, lambda h: F.when(h["nfold"] > 0, F.array_repeat(h["xxyy"], h["nfold"])).otherwise(F.array().cast("array<int>"))))
    exp = hits.select(*event, "hit_idx", F.col("xxyy").cast("int").alias("xxyy"), "nfold").groupBy(*event).agg(flat.alias("exp"))
    rest = [c for c in waveforms.columns if c not in (*event, "wf_idx")]
    act = waveforms.groupBy(*event).agg(F.array_sort(F.collect_list(F.struct(F.col("wf_idx").alias("raw_wf_idx"), *rest))).alias("act"))
    ids = F.transform("act", lambda w: w["xxyy"].cast("int"))
    both = exp.join(act.hint("merge"), event, "left").withColumn("taken", _walked(F.col("exp"), ids))
    whole = F.size("taken") == F.size("exp")
    broken = both.where(~whole).select(*event, F.size("exp").alias("expected"), F.size("taken").alias("matched"))
    found = both.where(whole).select(*event, F.posexplode(F.transform("taken", lambda i: F.get("act", i))).alias("wf_idx", "w"))
    return found.select(*event, "w.raw_wf_idx", "wf_idx", *[F.col(f"w.{c}").alias(c) for c in rest]), broken


def _walked(exp: Column, ids: Column) -> Column:
    """The places in ``ids`` that a walk over it takes: each that is what ``exp`` waits for.  Lists that agree are taken as they are."""
    ids = F.coalesce(ids, F.array().cast("array<int>"))
    place = F.transform(ids, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    step = lambda taken, p: F.when(F.get(exp, F.size(taken)) == p["x"], F.concat(taken, F.array(p["i"]))).otherwise(taken)
    return F.when(exp == ids, F.transform(ids, lambda x, i: i)).otherwise(F.aggregate(place, F.array().cast("array<int>"), step))


def relative_arrival(hits: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Good hits with ``rel_ns``: mean arrival after the event's earliest, in ns."""
    mean = (F.col("reltime_low") + F.col("reltime_up")) / 2
    rows = good_hits(hits).withColumn("_mean", mean)
    return rows.withColumn("rel_ns", (F.col("_mean") - F.min("_mean").over(Window.partitionBy(*event))) * 4000).drop("_mean")


def quality_cuts(events: DataFrame, least_cluster: int = 4, most_zenith: float = 55.0, least_border: float | None = None, most_chi2: float | None = None) -> DataFrame:
    """Documented selection presets; options that are None are not applied."""
    ok = (F.col("nstclust") >= least_cluster) & (F.col("geom2_theta") + 0.5 <= most_zenith)
    if least_border is not None:
        ok &= F.col("bdist") >= least_border
    if most_chi2 is not None:
        ok &= (F.col("comb_ndof") > 0) & (F.col("comb_chi2") / F.col("comb_ndof") <= most_chi2)
    return events.where(ok)
