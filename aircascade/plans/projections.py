"""Event-level columns: simulated shower parameters and the standard reconstruction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import physics as P
from ..functions import shower_depth
from ..schema import EVENT


@dataclass(frozen=True)
class EventOptions:
    """Which columns are made, and in which units: ``metres`` for cores as in tiles, else counter units and cm."""

    shower_params: bool = True
    standard_recon: bool = True
    combined_fit: bool = True
    fixed_curvature_fit: bool = True
    metres: bool = True


def shower_params(options: EventOptions = EventOptions()) -> dict[str, Column]:
    c = F.col
    scale = 1e-2 if options.metres else 1.0
    return {
        "mass_number": P.mass_number(c("mc_parttype")),
        "energy": c("mc_energy"),
        "shower_axis": P.axis(c("mc_theta"), c("mc_phi")),
        "shower_core": F.array(*[c(f"mc_core_{k}") * scale for k in "xyz"]),
    }


def _core(prefix: str, options: EventOptions) -> tuple[Column, Column]:
    c = F.col
    if options.metres:
        core = F.array(P.core_to_metres(c(f"{prefix}_xcore"), "x"), P.core_to_metres(c(f"{prefix}_ycore"), "y"))
        return core, F.array(P.core_to_metres(c(f"{prefix}_dxcore"), "dx"), P.core_to_metres(c(f"{prefix}_dycore"), "dy"))
    return F.array(P.core_in_units(c(f"{prefix}_xcore"), "x"), P.core_in_units(c(f"{prefix}_ycore"), "y")), F.array(f"{prefix}_dxcore", f"{prefix}_dycore")


#: Output name (behind std_recon_) and raw column of those that are taken as they are, with the type of whole numbers.
_PLAIN = {
    "yymmdd": ("yymmdd", "long"), "hhmmss": ("hhmmss", "long"), "usec": ("usec", "long"), "nofwf": ("nofwf", "int"), "nsd": ("nstclust", "int"),
    "nsclust": ("nsclust", "int"), "nhits": ("nhits", "int"), "nborder": ("nborder", None), "energy": ("ldf_energy", None), "ldf_scale": ("ldf_sc", None),
    "ldf_scale_err": ("ldf_dsc", None), "ldf_chi2": ("ldf_chi2", None), "ldf_ndof": ("ldf_ndof", None), "s800": ("ldf_s800", None),
    "geom_chi2": ("geom2_chi2", None), "geom_ndof": ("geom2_ndof", None), "curvature": ("geom_a", None), "curvature_err": ("geom_da", None),
    "border_distance": ("bdist", None), "border_distance_tshape": ("tdist", None),
}
_COMBINED = {"combined_energy": "comb_energy", "combined_scale": "comb_sc", "combined_scale_err": "comb_dsc", "combined_chi2": "comb_chi2", "combined_ndof": "comb_ndof", "combined_s800": "comb_s800"}


def standard_recon(options: EventOptions = EventOptions()) -> dict[str, Column]:
    c = F.col
    out = {name: c(raw).cast(kind) if kind else c(raw) for name, (raw, kind) in _PLAIN.items()}
    out["qtot"] = F.array("qtot_low", "qtot_up")
    out["shower_core"], out["shower_core_err"] = _core("ldf", options)
    fits = {"": "geom2"}
    if options.fixed_curvature_fit:
        fits["_fixed_curve"] = "geom1"
        out |= {"geom_chi2_fixed_curve": c("geom1_chi2"), "geom_ndof_fixed_curve": c("geom1_ndof")}
    if options.combined_fit:
        fits["_combined"] = "comb"
        out |= {name: c(raw) for name, raw in _COMBINED.items()}
        out["combined_shower_core"], out["combined_shower_core_err"] = _core("comb", options)
    for end, fit in fits.items():
        out[f"shower_axis{end}"] = P.fitted_axis(c(f"{fit}_theta"), c(f"{fit}_phi"))
        out[f"shower_axis_err{end}"] = P.axis_error(c(f"{fit}_theta"), c(f"{fit}_dtheta"), c(f"{fit}_dphi"))
    return {f"std_recon_{name}": column for name, column in out.items()}


def event_columns(events: DataFrame, options: EventOptions = EventOptions()) -> DataFrame:
    """The key and the chosen columns; what isn't chosen is never computed or read."""
    out = (shower_params(options) if options.shower_params else {}) | (standard_recon(options) if options.standard_recon else {})
    ids = [c for c in events.columns if c.startswith("id_") or c in ("ta_obs_date", "xmax")]
    return events.select(*EVENT, *ids, *[column.alias(name) for name, column in out.items()])


def with_depth(events: DataFrame, depths: DataFrame | None, index: DataFrame, model: str = shower_depth.DEFAULT_MODEL, seed: int = 1, same_dir: bool = False, literal_log10e: bool = False) -> DataFrame:
    """Add ``xmax``: the file's depth scaled with energy, or a drawn one where there is none.

    ``depths`` comes from parse_depths (None: no column); ``index`` from
    energy_index.  With ``same_dir`` the depth must come from the event file's directory.
    """
    from ..functions import names
    from ..sources.tables import first_depths

    if depths is None:
        return events
    keys = ["dir", "file_idx"] if same_dir else ["file_idx"]
    name = names.base_name(F.col("file_name"))
    rows = events.withColumns({"file_idx": names.simulation_index(name), "dir": names.directory(F.col("file_name"))})
    rows = rows.withColumn("energy_index", F.expr("try_cast(right(file_idx, 2) as int)"))
    rows = rows.join(first_depths(depths, keys), keys, "left").join(index.select("energy_index", "mid"), "energy_index", "left")
    mass = P.mass_number(F.col("mc_parttype"))
    known = shower_depth.scaled_depth(F.col("xmax0"), F.col("mc_energy"), F.col("mid"), model)
    drawn = shower_depth.drawn_depth(shower_depth.log10_energy(F.col("mc_energy"), literal_log10e), mass, [F.col(k) for k in EVENT], seed, model)
    return rows.withColumn("xmax", F.coalesce(known, drawn)).drop("xmax0", "mid", "energy_index", "file_idx", "dir")
