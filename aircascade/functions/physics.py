"""Physics columns of events and hits: Column -> Column, without any DataFrame logic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Array origin in counter units, pitch in metres, counter units to ns, bin width in ns, zenith correction in degrees.
ORIGIN = {"x": -12.2435, "y": -16.4406}
PITCH_M, TO_NS, BIN_NS, ZENITH_OFFSET = 1200, 4000, 20, 0.5
#: Fixed value: time to distance factor.
TIME_TO_DISTANCE = 0.249827048333
#: Fixed value: what positions of the toy format are divided by.
TOY_SCALE = 4800


def mass_number(particle: Column) -> Column:
    """Mass number of a simulation's particle code: 14 is a proton, else hundreds are the mass."""
    return F.when(particle == 14, 1).otherwise(F.floor(particle / 100)).cast("int")


def axis(theta: Column, phi: Column) -> Column:
    """Unit vector that points back to the source; angles in radians."""
    back = phi + F.lit(math.pi)
    return F.array(F.sin(theta) * F.cos(back), F.sin(theta) * F.sin(back), F.cos(theta))


def fitted_axis(theta_deg: Column, phi_deg: Column, offset: float = ZENITH_OFFSET) -> Column:
    """The axis of a fit in degrees, with the zenith correction."""
    return axis(F.radians(theta_deg + F.lit(offset)), F.radians(phi_deg))


def axis_error(theta_deg: Column, dtheta: Column, dphi: Column) -> Column:
    """Pointing error in degrees; without the zenith correction."""
    s = F.sin(F.radians(theta_deg))
    return F.sqrt(dtheta * dtheta + s * s * dphi * dphi)


def core_to_metres(v: Column, coordinate: str) -> Column:
    """Fitted core in metres; errors (dx, dy) are scaled without a shift."""
    return F.lit(float(PITCH_M)) * (v + F.lit(ORIGIN.get(coordinate, 0.0)))


def core_in_units(v: Column, coordinate: str) -> Column:
    """Fitted core in counter units."""
    return v + F.lit(ORIGIN[coordinate])


def grid_x(xxyy: Column, base: int = 100) -> Column:
    return F.floor(xxyy / base).cast("int")


def grid_y(xxyy: Column, base: int = 100) -> Column:
    return F.pmod(xxyy, F.lit(base)).cast("int")


def swapped_id(yyxx: Column, base: int = 100) -> Column:
    """Grid code with its halves exchanged."""
    return (F.pmod(yyxx, F.lit(base)) * base + F.floor(yyxx / base)).cast("int")


def arrival_ns(reltime: Column) -> Column:
    return reltime * TO_NS


def layer_mean(low: Column, up: Column) -> Column:
    return (low + up) / 2


def hit_position_cm(v: Column) -> Column:
    return v * PITCH_M * 100


def trace_start_bin(clkcnt: Column, mclkcnt: Column) -> Column:
    """Start of a waveform in bins within its second."""
    return clkcnt / mclkcnt * F.lit(1e9) / BIN_NS


def event_time(yymmdd: Column, hhmmss: Column, usec: Column) -> Column:
    """Timestamp of packed date and time numbers and microseconds."""
    d, t = yymmdd.cast("long"), hhmmss.cast("long")
    part = lambda v, k: F.pmod(F.floor(v / k), F.lit(100)).cast("int")
    return F.make_timestamp(part(d, 10000) + 2000, part(d, 100), part(d, 1), part(t, 10000), part(t, 100), part(t, 1) + (usec / F.lit(1e6)).cast("decimal(8,6)"))


def zenith_deg(x: Column, y: Column, z: Column) -> Column:
    norm = F.sqrt(x * x + y * y + z * z)
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z / norm))))


def azimuth_deg(x: Column, y: Column) -> Column:
    a = F.degrees(F.atan2(y, x))
    return F.when(a > 0, a).otherwise(a + 360)


def reduced_chi2(chi2: Column, ndof: Column) -> Column:
    return F.when(ndof > 0, chi2 / ndof)


def status_bits(flags: Column, first: int, last: int) -> Column:
    """Bits first..last of a detector's status flags, as a number."""
    return F.shiftrightunsigned(flags, first).bitwiseAND((1 << (last - first + 1)) - 1)


def lateral_distribution(r_m: Column, theta_deg: Column) -> Column:
    """Shape of the lateral distribution (up to scale): powers of r/91.6 with a zenith dependent slope."""
    eta = F.lit(3.97) - F.lit(1.79) * (F.lit(1.0) / F.cos(F.radians(theta_deg)) - 1)
    x = r_m / F.lit(91.6)
    return F.pow(x, F.lit(-1.2)) * F.pow(1 + x, -(eta - F.lit(1.2))) * F.pow(1 + F.pow(r_m / 1000, F.lit(2.0)), F.lit(-0.6))


def attenuation(theta_deg: Column, depth: float = 920.0, first: float = 500.0, second: float = 594.0) -> Column:
    """Loss of signal on the longer way of an inclined shower."""
    s = F.lit(1.0) / F.cos(F.radians(theta_deg)) - 1
    return F.exp(-(F.lit(depth / first) * s) - F.lit(depth / second) * s * s)


def signal_at(scale: Column, r_m: float, theta_deg: Column) -> Column:
    """Signal of a fitted scale at a distance (600 and 800 m are the usual ones)."""
    return scale * lateral_distribution(F.lit(float(r_m)), theta_deg)


def energy_from_s600(scale: Column, theta_deg: Column) -> Column:
    """Energy in EeV of the signal at 600 m, made vertical."""
    return F.lit(0.203) * signal_at(scale, 600, theta_deg) / attenuation(theta_deg)


def curvature_delay(a: Column, r: Column, density: Column) -> Column:
    """Delay of the shower front behind a plane."""
    return F.lit(0.80) * a * F.pow(1 + r / 30, F.lit(1.5)) * F.pow(density, F.lit(-0.5))


def unit_vector(x: Column, y: Column) -> tuple[Column, Column]:
    n = F.sqrt(x * x + y * y)
    return x / n, y / n


def perpendicular(x: Column, y: Column) -> tuple[Column, Column]:
    ux, uy = unit_vector(x, y)
    return -uy, ux


def tile_to_display(p: Column, n: int) -> Column:
    """Normalised position (-1..1) to the index scale of an n-cell side."""
    return (p + 1) * (n - 1) / 2


def marker_size(total: Column) -> Column:
    return 100 * F.log10(total) + 1


def toy_position(v: Column) -> Column:
    """A position or core of the toy format, in units of its array's half side."""
    return v / TOY_SCALE
