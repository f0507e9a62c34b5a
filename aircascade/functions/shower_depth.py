"""Depth of the shower maximum: lookup values scaled with energy, or drawn from a Gumbel model."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Generalized Gumbel parameters by hadronic model; for each power of lgE - 19 the coefficients of 1, ln A, (ln A)^2.
GUMBEL = {
    "QGSJetII": {"mu": ((758.444, -10.692, -1.253), (48.892, 0.02, 0.179), (-2.346, 0.348, -0.086)), "sigma": ((39.033, 7.452, -2.176), (4.390, -1.688, 0.170)), "lambda": ((0.857, 0.686, -0.040), (0.179, 0.076, -0.0130))},
    "QGSJetII-04": {"mu": ((758.65, -12.3571, -1.24539), (56.5943, -1.01244, 0.228689), (-0.534683, -0.17284, -0.019159)), "sigma": ((35.4234, 6.75921, -1.46182), (-0.796042, 0.201762, -0.0142452)), "lambda": ((0.671545, 0.373902, 0.075325), (0.0304335, 0.0473985, -0.000564531))},
    "Sibyll2.1": {"mu": ((770.104, -15.873, -0.960), (58.668, -0.124, -0.023), (-1.423, 0.977, -0.191)), "sigma": ((31.717, 1.335, -0.601), (-1.912, 0.007, 0.086)), "lambda": ((0.683, 0.278, 0.012), (0.008, 0.051, 0.003))},
    "Sibyll2.3d": {"mu": ((785.852, -15.5994, -1.06906), (60.5929, -0.786014, 0.200728), (-0.689462, -0.294794, 0.0399432)), "sigma": ((41.0345, -2.17329, -0.306202), (-0.309466, -1.16496, 0.225445)), "lambda": ((0.799493, 0.235235, 0.00856884), (0.0632135, -0.0012847, 0.000330525))},
    "EPOS1.99": {"mu": ((780.013, -11.488, -1.906), (61.911, -0.098, 0.038), (-0.405, 0.163, -0.095)), "sigma": ((28.853, 8.104, -1.924), (-0.083, -0.961, 0.215)), "lambda": ((0.538, 0.524, 0.047), (0.009, 0.023, 0.010))},
    "EPOS-LHC": {"mu": ((775.457, -10.3991, -1.75261), (58.5306, -0.827668, 0.231144), (-1.40781, 0.225624, -0.10008)), "sigma": ((32.2632, 3.94252, -0.864421), (1.27601, -1.81337, 0.231914)), "lambda": ((0.641093, 0.219762, 0.171124), (0.0726131, 0.0353188, -0.0131158))},
}
#: Change of the mean depth with a decade of energy, by model.
ELONGATION = {"QGSJet01": 49.7, "QGSJetII": 45.8, "EPOS1.99": 62.2, "Sibyll2.1": 57.7, "Sibyll2.1*": 57.9, "EPOS-LHC": 55.6, "EPOS-LHC*": 56.3, "QGSJetII-04": 54.4, "QGSJetII-04*": 54.4}
DEFAULT_MODEL = "QGSJetII-04"


def gumbel_parameters(log10e: Column, mass: Column, model: str = DEFAULT_MODEL) -> tuple[Column, Column, Column]:
    """Location, scale and shape at log10(E/eV) for a mass number."""
    if model not in GUMBEL:
        raise ValueError(f"unknown model {model!r}; known: {', '.join(GUMBEL)}")
    le, la = log10e - 19, F.log(mass)

    def in_energy(rows: tuple) -> Column:
        out = None
        for power, (c0, c1, c2) in enumerate(rows):
            term = F.lit(c0) + F.lit(c1) * la + F.lit(c2) * la * la
            for _ in range(power):
                term = term * le
            out = term if out is None else out + term
        return out

    p = GUMBEL[model]
    return in_energy(p["mu"]), in_energy(p["sigma"]), in_energy(p["lambda"])


#: Candidates of a draw, of which the first that fits counts; that none does happens once in 10^11 draws.
CANDIDATES = 8


def _uniform(digest: Column, k: int) -> Column:
    """The k-th number of three in (0, 1) that an md5 gives, of 40 bits each."""
    return (F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 10).cast("double") + 0.5) / float(1 << 40)


def _with(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), 0)


def _log_gamma_draw(shape: Column, said: Column) -> Column:
    """ln of a Gamma(shape, 1/shape) number, drawn by squeezed normals from digests of ``said``.

    Candidates are tried in order, and none behind the first that fits.
    """

    def drawn(s: Column) -> Column:
        d, c = s["d"], s["c"]

        def tried(t: Column) -> Column:
            x, v = t["x"], t["v"]
            fits = (1 + c * x > 0) & (F.log(t["u"]) < x * x / 2 + d - d * v + d * F.log(v))
            return F.when(fits, F.log(d * v))

        def cubed(t: Column) -> Column:
            x = t["x"]
            v = F.greatest((1 + c * x) * (1 + c * x) * (1 + c * x), F.lit(1e-300))
            return _with(F.struct(x.alias("x"), t["u"].alias("u"), v.alias("v")), tried)

        def candidate(i: Column) -> Column:
            normal = lambda h: F.struct((F.sqrt(-2 * F.log(_uniform(h, 0))) * F.cos(F.lit(2 * math.pi) * _uniform(h, 1))).alias("x"), _uniform(h, 2).alias("u"))
            return _with(F.md5(F.concat_ws("|", said, i.cast("string"))), lambda h: _with(normal(h), cubed))

        first = F.aggregate(F.sequence(F.lit(1), F.lit(CANDIDATES)), F.lit(None).cast("double"), lambda found, i: F.coalesce(found, candidate(i)))
        # From shape + 1 down to shape, and to a mean of 1.
        return F.coalesce(first, F.log(d)) + F.log(_uniform(F.md5(F.concat_ws("|", said, F.lit("0"))), 0)) / s["shape"] - F.log(s["shape"])

    with_d = lambda k: F.struct(k.alias("shape"), (k + 1 - F.lit(1 / 3)).alias("d"))
    with_c = lambda s: F.struct(s["shape"].alias("shape"), s["d"].alias("d"), (1 / F.sqrt(9 * s["d"])).alias("c"))
    return _with(shape, lambda k: _with(with_d(k), lambda s: _with(with_c(s), drawn)))


def drawn_depth(log10e: Column, mass: Column, keys: list[Column], seed: int = 1, model: str = DEFAULT_MODEL) -> Column:
    """A random depth from the model; the same for the same key and seed, however the rows are split."""
    mu, sigma, shape = gumbel_parameters(log10e, mass, model)
    said = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return mu - sigma * _log_gamma_draw(shape, said)


def draw_sql(source: str, model: str = DEFAULT_MODEL) -> str:
    """CTEs that add ``drawn`` to ``source`` (le: lgE - 19, la: ln A, said: key and seed), as ``drawn``, in DuckDB's SQL."""
    terms = {k: " + ".join(f"(({a}) + ({b}) * la + ({c}) * la * la)" + " * le" * n for n, (a, b, c) in enumerate(v)) for k, v in GUMBEL[model].items()}
    u = lambda h, k: f"((CAST('0x' || substr({h}, {1 + 10 * k}, 10) AS BIGINT) + 0.5) / 1099511627776.0)"
    h = "md5(said || '|' || i)"
    x = f"(sqrt(-2 * ln({u(h, 0)})) * cos(2 * pi() * {u(h, 1)}))"
    return f"""d1 AS (SELECT *, {terms['mu']} AS mu, {terms['sigma']} AS sigma, {terms['lambda']} AS shape, {terms['lambda']} + 1 - 1 / CAST(3 AS DOUBLE) AS dd FROM {source}),
d2 AS (SELECT *, list_transform(range(1, {CANDIDATES + 1}), lambda i: {{'x': {x}, 'u': {u(h, 2)}}}) AS tries FROM d1),
d3 AS (SELECT *, list_transform(tries, lambda t: {{'v': greatest(pow(1 + t.x / sqrt(9 * dd), 3), 1e-300), 'x': t.x, 'u': t.u}}) AS vs FROM d2),
d4 AS (SELECT *, list_filter(vs, lambda t: t.v > 1e-300 AND ln(t.u) < t.x * t.x / 2 + dd - dd * t.v + dd * ln(t.v)) AS fit FROM d3),
drawn AS (SELECT *, mu - sigma * (coalesce(ln(dd * fit[1].v), ln(dd)) + ln({u("md5(said || '|0')", 0)}) / shape - ln(shape)) AS drawn FROM d4)"""


def scaled_depth(depth: Column, energy: Column, bin_energy: Column, model: str = DEFAULT_MODEL) -> Column:
    """A bin's depth moved to the event's energy; null where it is missing or 0."""
    if model not in ELONGATION:
        raise ValueError(f"unknown model {model!r}; known: {', '.join(ELONGATION)}")
    return F.when(depth.isNotNull() & (depth != 0), depth + F.lit(ELONGATION[model]) * F.log10(energy / bin_energy))


def log10_energy(energy: Column, literal: bool = False) -> Column:
    """log10(E/eV) of an energy in EeV; ``literal`` gives energy + 18 instead."""
    return energy + 18 if literal else F.log10(energy) + 18


def bin_exponent(index: Column) -> Column:
    """Position on the energy grid of a file's energy index: 0..25 lie above 10^18 eV, the rest below."""
    return F.when(index <= 25, index + 20).otherwise(index - 20)
