"""Array columns: time traces and fixed-size records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numbers(line: Column, kind: str = "double") -> Column:
    """Blank-separated numbers of a line; an empty line gives an empty array.

    Lines are cut at single blanks, which costs a third of a pattern; only lines that have
    other blanks, so that a piece is no number, are cut by the pattern.
    """
    text = F.trim(line)
    quick = F.split(text, " ").try_cast(f"array<{kind}>")
    any_blanks = F.split(text, r"\s+").cast(f"array<{kind}>")
    # In an array of one, so that it is computed once.
    once = F.get(F.transform(F.array(quick), lambda v: F.when(F.exists(v, lambda x: x.isNull()), any_blanks).otherwise(v)), 0)
    return F.when(text == "", F.array().cast(f"array<{kind}>")).otherwise(once)


def records(values: Column, size: int) -> Column:
    """Cut an array into records of ``size``; a rest that fills no record is left out."""
    n = F.floor(F.size(values) / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: F.slice(values, k * size + 1, size))
    return F.when(n > 0, cut).otherwise(F.slice(cut, 1, 0))


def whole_records(values: Column, size: int) -> Column:
    return F.size(values) % size == 0


def calibrated(fadc: Column, vem: Column) -> Column:
    return F.transform(fadc, lambda x: x / vem)


def mean_trace(low: Column, up: Column, vem_low: Column, vem_up: Column) -> Column:
    return F.zip_with(low, up, lambda a, b: (a / vem_low + b / vem_up) / 2)


def total(trace: Column) -> Column:
    return F.aggregate(trace, F.lit(0.0), lambda a, x: a + x)


def is_filled(trace: Column) -> Column:
    return F.exists(trace, lambda x: x != 0)


def log_trace(trace: Column) -> Column:
    return F.transform(trace, lambda x: F.log10(x + 1))


def positive_points(trace: Column) -> Column:
    """(bin, value) of the positive bins."""
    points = F.transform(trace, lambda v, k: F.struct(k.alias("bin"), v.alias("value")))
    return F.filter(points, lambda p: p["value"] > 0)


def shift_bins(arrival_ns: Column, bin_ns: int = 20) -> Column:
    return F.ceil(arrival_ns / bin_ns).cast("int")


def placed(trace: Column, shift: Column, length: Column) -> Column:
    """A trace on a longer axis: ``shift`` zeros before it, zeros up to ``length`` behind it."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n.cast("int"))
    return F.concat(zeros(shift), trace.cast("array<double>"), zeros(length - shift - F.size(trace)))
