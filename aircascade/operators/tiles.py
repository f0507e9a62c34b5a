"""Square tiles of detectors around an event's loudest one.

Everything runs on the long form, one row a cell; dense arrays are made last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics, traces
from ..schema import BINS, EVENT
from . import hits as H


@dataclass(frozen=True)
class ArrayLayout:
    """What differs between detector arrays: id base, pitch and reference height in metres, where positions come from, and id order."""

    base: int = 100
    pitch_m: float = 1200.0
    height_m: float = 1370.0
    extent_z_m: float = 30.0
    positions_from_hits: bool = False
    swapped_hit_ids: bool = False


#: The denser array: ids of hits are yyxx, positions come with the hits, and the pitch differs.
DENSE_ARRAY = ArrayLayout(pitch_m=2080.0, positions_from_hits=True, swapped_hit_ids=True)


def laid_out(hits: DataFrame, layout: ArrayLayout) -> DataFrame:
    """Hits with ids in the order of the layout's grid."""
    return hits.withColumn("xxyy", physics.swapped_id(F.col("xxyy"), layout.base)) if layout.swapped_hit_ids else hits


def centred(hits: DataFrame, layout: ArrayLayout = ArrayLayout(), bad: DataFrame | None = None, carry: dict[str, Column] | None = None, event: list[str] = EVENT) -> DataFrame:
    """One row an event: x0 and y0 of its loudest hit, its hits' ids and columns ``carry`` as arrays (_ids, _hits), and with ``bad`` the list _bad.

    ``hits`` holds a detector of an event once (tile_hits).  Hits are dealt by their event and in the order
    of their detectors then, so windows gather them as they lie; an aggregate with a list would sort them again.
    """
    w = Window.partitionBy(*event)
    loudest = F.max(F.struct(((F.col("pulsa_low") + F.col("pulsa_up")) / 2).alias("s"), (-F.col("hit_idx")).alias("i"), "xxyy")).over(w)
    got = {"_n": F.row_number().over(w.orderBy("xxyy", "hit_idx")), "_loudest": loudest}
    if carry:
        got["_hits"] = F.collect_list(F.struct(F.col("xxyy").alias("_id"), *[c.alias(name) for name, c in carry.items()])).over(w)
    at = hits.select(*event, *[c.alias(name) for name, c in got.items()]).where("_n = 1")
    centre = F.col("_loudest.xxyy")
    at = at.select(*event, physics.grid_x(centre, layout.base).alias("x0"), physics.grid_y(centre, layout.base).alias("y0"), *([F.col("_hits._id").alias("_ids"), "_hits"] if carry else []))
    if bad is not None:
        at = at.join(bad.groupBy(*event).agg(F.collect_set("xxyy").alias("_bad")), event, "left")
    return at


def _id_at(i: Column, j: Column, n: int, layout: ArrayLayout) -> Column:
    half = (n - 1) // 2
    return ((F.col("x0") - half + i) * layout.base + F.col("y0") - half + j).cast("int")


def _hit_at(xxyy: Column) -> Column:
    """The hit at a detector, null without one: place 0 is none, and so is what lies before the first."""
    return F.get("_hits", F.array_position("_ids", xxyy).cast("int") - 1)


def cells(hits: DataFrame, n: int, layout: ArrayLayout = ArrayLayout(), bad: DataFrame | None = None, carry: dict[str, Column] | None = None, event: list[str] = EVENT) -> DataFrame:
    """event, i, j, xxyy: the n x n cells around each event's loudest hit.  ``n`` below 3 has no extent and is an error.

    With ``bad`` cells have ``good`` (their event doesn't list the detector as bad), and the columns
    ``carry`` of the hit at their detector, nulls without one.  An event's hits and bad detectors
    meet before its cells are made, so no cell is sorted or shuffled.
    """
    if n < 3:
        raise ValueError("a tile needs a side of 3 at least")
    at = centred(hits, layout, bad, carry, event)
    grid = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(n) for j in range(n)]))
    cell = at.withColumn("_c", grid).select(*at.columns, "_c.i", "_c.j")
    cell = cell.withColumn("xxyy", _id_at(F.col("i"), F.col("j"), n, layout))
    out = [*event, "i", "j", "xxyy"]
    if bad is not None:
        out.append((~F.coalesce(F.array_contains("_bad", F.col("xxyy")), F.lit(False))).alias("good"))
    if carry:
        hit = _hit_at(F.col("xxyy"))
        out += [hit[name].alias(name) for name in carry]
    return cell.select(*out)


def dense(hits: DataFrame, n: int, layout: ArrayLayout, carry: dict[str, Column], event: list[str] = EVENT) -> DataFrame:
    """One row an event, each column of ``carry`` as an n x n array, 0 without a hit: what ``nested`` makes of cells, for columns that need no detector's state.

    Arrays are filled from the event's hits; no cell is made a row.
    """
    at = centred(hits, layout, None, carry, event)
    side = F.sequence(F.lit(0), F.lit(n - 1))
    fill = lambda name: F.transform(side, lambda i: F.transform(side, lambda j: F.coalesce(_hit_at(_id_at(i, j, n, layout))[name], F.lit(0))))
    return at.select(*event, *[fill(name).alias(name) for name in carry])


def geometry(cell: DataFrame, detectors: DataFrame) -> DataFrame:
    """Add position in metres, ``exists`` and ``state`` to cells with ``good``; cells without a detector have null positions.

    ``detectors`` is a catalogue of fixed, small size; its join is broadcast if
    Spark's size check allows it.
    """
    d = detectors.select("xxyy", *[(F.col(f"{c}_cm") * 1e-2).alias(f"{c}_m") for c in "xyz"], F.lit(True).alias("_on"))
    out = cell.join(d, "xxyy", "left").withColumn("exists", F.col("_on").isNotNull()).drop("_on")
    return out.withColumn("state", F.col("exists") & F.col("good"))


def normalised(cell: DataFrame, n: int, layout: ArrayLayout = ArrayLayout(), event: list[str] = EVENT) -> DataFrame:
    """Add x_norm, y_norm, z_norm: positions from the central cell in units of the tile's extent; 0 where no detector is."""
    half = (n - 1) // 2
    extent = half * layout.pitch_m
    # A window, not a join with an aggregate: that would compute the cells twice.
    w = Window.partitionBy(*event)
    out = cell.withColumns({f"{c}_mid": F.max(F.when((F.col("i") == half) & (F.col("j") == half), F.col(f"{c}_m"))).over(w) for c in "xy"})
    norm = {f"{c}_norm": F.when(F.col("exists"), (F.col(f"{c}_m") - F.col(f"{c}_mid")) / extent).otherwise(0.0) for c in "xy"}
    norm["z_norm"] = F.when(F.col("exists"), (F.col("z_m") - layout.height_m) / layout.extent_z_m).otherwise(0.0)
    return out.withColumns(norm)


def normalised_cores(events: DataFrame, cell: DataFrame, n: int, layout: ArrayLayout = ArrayLayout(), event: list[str] = EVENT) -> DataFrame:
    """Events with shower_core, std_recon_shower_core and its error (arrays) in tile units; those present are changed, the combined fit's core is not."""
    half = (n - 1) // 2
    extent = half * layout.pitch_m
    mid = cell.where((F.col("i") == half) & (F.col("j") == half)).select(*event, "x_m", "y_m")
    out = events.join(mid, event)
    x, y = F.coalesce("x_m", F.lit(0.0)), F.coalesce("y_m", F.lit(0.0))
    get = F.get
    new = {
        "shower_core": lambda c: F.array((get(c, 0) - x) / extent, (get(c, 1) - y) / extent, get(c, 2) / layout.extent_z_m),
        "std_recon_shower_core": lambda c: F.array((get(c, 0) - x) / extent, (get(c, 1) - y) / extent),
        "std_recon_shower_core_err": lambda c: F.array(get(c, 0) / extent, get(c, 1) / extent),
    }
    return out.withColumns({name: f(name) for name, f in new.items() if name in events.columns}).drop("x_m", "y_m")


def reading_columns(layers: str = "both") -> dict[str, Column]:
    """The readings of a hit: arrival times in ns, signals, nfold.  ``layers`` is "both" (columns _low and _up) or "mean"."""
    h = {}
    if layers == "mean":
        h["arrival_times"] = physics.arrival_ns(physics.layer_mean(F.col("reltime_low"), F.col("reltime_up")))
        h["total_signals"] = physics.layer_mean(F.col("pulsa_low"), F.col("pulsa_up"))
    else:
        for s in ("low", "up"):
            h[f"arrival_times_{s}"] = physics.arrival_ns(F.col(f"reltime_{s}"))
            h[f"total_signals_{s}"] = F.col(f"pulsa_{s}")
    return h | {"nfold": F.col("nfold")}


def readings(cell: DataFrame, layers: str = "both", mask_all: bool = False) -> DataFrame:
    """Cells that carry ``reading_columns`` with zeros where no hit is.

    Arrival times are 0 where the detector's state is false; with ``mask_all`` signals are too.
    """
    keep = lambda name: "arrival" in name or (mask_all and "signal" in name)
    return cell.withColumns({name: F.coalesce(F.when(F.col("state"), F.col(name)) if keep(name) else F.col(name), F.lit(0)) for name in reading_columns(layers)})


def traces_of(hits: DataFrame, waveforms: DataFrame, layers: str = "both", event: list[str] = EVENT) -> DataFrame:
    """event, xxyy and calibrated traces of each hit's first waveform."""
    w = H.first_waveforms(hits, waveforms, event)
    if layers == "mean":
        return w.select(*event, "xxyy", traces.mean_trace(F.col("fadc_low"), F.col("fadc_up"), F.col("vem_low"), F.col("vem_up")).alias("time_traces"))
    return w.select(*event, "xxyy", *[traces.calibrated(F.col(f"fadc_{s}"), F.col(f"vem_{s}")).alias(f"time_traces_{s}") for s in ("low", "up")])


def with_traces(cell: DataFrame, trace: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Attach traces to cells, last of all as they are wide; zeros without a hit."""
    names = [c for c in trace.columns if c.startswith("time_traces")]
    none = F.array_repeat(F.lit(0.0), BINS)
    return cell.join(trace.hint("merge"), [*event, "xxyy"], "left").withColumns({c: F.coalesce(c, none) for c in names})


def filled_traces(arrays: DataFrame, trace: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Add traces to events whose ``xxyy`` is the n x n array of their cells' ids; zeros without a hit.  An event's few traces move, not those of all its cells."""
    names = [c for c in trace.columns if c.startswith("time_traces")]
    lists = trace.groupBy(*event).agg(F.collect_list(F.struct("xxyy", *names)).alias("_t"))
    out = arrays.join(lists.hint("merge"), event, "left").withColumn("_ids", F.col("_t.xxyy"))
    none = F.array_repeat(F.lit(0.0), BINS)
    at = lambda id_: F.get("_t", F.array_position("_ids", id_).cast("int") - 1)
    fill = lambda name: F.transform("xxyy", lambda row: F.transform(row, lambda id_: F.coalesce(at(id_)[name], none)))
    return out.withColumns({name: fill(name) for name in names}).drop("_t", "_ids")


def nested(cell: DataFrame, n: int, columns: list[str], event: list[str] = EVENT) -> DataFrame:
    """One row an event, each of ``columns`` as an n x n array."""
    rows = cell.groupBy(*event).agg(F.array_sort(F.collect_list(F.struct("i", "j", *columns))).alias("c"))
    pick = lambda name: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.transform(F.slice("c", i * n + 1, n), lambda x: x[name]))
    return rows.select(*event, *[pick(c).alias(c) for c in columns])


def full(cell: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """event, full: whether every cell of the tile has a working detector."""
    return cell.groupBy(*event).agg(F.bool_and("state").alias("full"))
