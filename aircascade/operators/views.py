"""Tables that event displays draw."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics, traces
from ..schema import EVENT


def arrival_order(df: DataFrame, arrival: str, keys: list[str] = EVENT, tie: list[str] | None = None, step: float = 0.05) -> DataFrame:
    """Add ``rank`` (from 0) by arrival within an event, and the vertical ``lift`` of its trace."""
    w = Window.partitionBy(*keys).orderBy(arrival, *(tie or []))
    return df.withColumn("rank", F.row_number().over(w) - 1).withColumn("lift", F.col("rank") * step)


def colour_scale(df: DataFrame, trace: str, keys: list[str] = EVENT) -> DataFrame:
    """keys, low, high: least positive and largest value of an event's traces; high is above low in any case."""
    positive = F.filter(trace, lambda x: x > 0)
    s = df.groupBy(*keys).agg(F.min(F.array_min(trace)).alias("_min"), F.min(F.array_min(positive)).alias("_pos"), F.max(F.array_max(trace)).alias("high"))
    s = s.withColumn("low", F.when((F.col("_min") <= 0) & F.col("_pos").isNotNull(), F.col("_pos")).otherwise(F.col("_min")))
    return s.select(*keys, "low", F.when(F.col("high") <= F.col("low"), F.col("low") + 1).otherwise(F.col("high")).alias("high"))


def footprint(hits: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Good hits: position, marker size by signal, and arrival after the earliest."""
    mean = (F.col("reltime_low") + F.col("reltime_up")) / 2
    rows = hits.where(F.col("isgood") > 2).withColumn("_t", mean)
    signal = (F.col("pulsa_low") + F.col("pulsa_up")) / 2
    return rows.select(*event, "hit_idx", "x", "y", signal.alias("signal"), physics.marker_size(signal).alias("size"), ((F.col("_t") - F.min("_t").over(Window.partitionBy(*event))) * physics.TO_NS).alias("rel_ns"))


def toy_arrivals(df: DataFrame, arrival: str, group: list[str], scale: float = 5000.0) -> DataFrame:
    """Arrivals scaled to 0..scale within a group; zeros stand for missing ones and stay 0."""
    w = Window.partitionBy(*group)
    t = F.when(F.col(arrival) != 0, F.col(arrival))
    rows = df.withColumn("_t", t).withColumn("_t", F.col("_t") - F.min("_t").over(w))
    return rows.withColumn("scaled", F.coalesce(F.try_divide(F.col("_t"), F.max("_t").over(w)), F.lit(0.0)) * scale).drop("_t")


def waveform_list(waveforms: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Waveforms with their start in bins, and the event's first start taken off."""
    rows = waveforms.withColumn("start_bin", physics.trace_start_bin(F.col("clkcnt"), F.col("mclkcnt")))
    return rows.withColumn("rel_bin", F.col("start_bin") - F.min("start_bin").over(Window.partitionBy(*event)))


def frames(tile: DataFrame, trace: str, arrival: str, keys: list[str] = EVENT) -> DataFrame:
    """keys, i, j, bin, value, log_value: what each frame of a film shows, with axes swapped for display."""
    rows = tile.where(traces.total(F.col(trace)) > 0).select(*keys, F.col("j").alias("i"), F.col("i").alias("j"), physics_bins(arrival).alias("_s"), F.posexplode(trace).alias("_k", "value"))
    return rows.select(*keys, "i", "j", (F.col("_s") + F.col("_k")).alias("bin"), "value", F.log10(F.col("value") + 1).alias("log_value"))


def physics_bins(arrival: str):
    return traces.shift_bins(F.col(arrival))


def titles(events: DataFrame) -> DataFrame:
    """Events with zenith and azimuth of their axis in degrees."""
    x, y, z = (F.get("shower_axis", k) for k in range(3))
    return events.withColumns({"zenith_deg": physics.zenith_deg(x, y, z), "azimuth_deg": physics.azimuth_deg(x, y)})
