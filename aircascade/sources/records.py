"""Lines of whole numbers in Arrow batches: counted and cut by whole buffers, where columns of Spark would make a string of each number.

The rules are those of ``traces.numbers``: a line's blanks at its ends don't count, and numbers are
cut at white space of any kind.  Buffers hold about ``CHUNK`` bytes of text, whatever a batch holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut at once, or one line.
CHUNK = 1 << 19
_GAP, _WHOLE = re.compile(r"[ \t\n\x0b\f\r]+"), re.compile(r"[+-]?[0-9]+")


def chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows whose ``line`` holds about ``CHUNK`` bytes, one row at least."""
    size = pc.fill_null(pc.cast(pc.binary_length(batch.column("line")), pa.int64()), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def _trimmed(lines: pa.Array) -> pa.Array:
    return pc.ascii_trim(pc.fill_null(lines.cast(pa.string()), ""), characters=" ")


def _bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings, and where each string starts and the last one ends."""
    at = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8))[at[0] : at[-1]], at - at[0]


def counts(lines: pa.Array) -> np.ndarray:
    """How many numbers each line has, as many as its pieces between white space; 0 for an empty one."""
    text = _trimmed(lines)
    a, at = _bytes(text)
    blank = (a == 32) | ((a >= 9) & (a <= 13))
    gap = blank.copy()
    gap[1:] &= ~blank[:-1]
    first = at[:-1][np.diff(at) > 0]
    gap[first] = blank[first]  # a gap doesn't run on from line to line
    n = np.diff(np.searchsorted(np.flatnonzero(gap), at))
    return np.where(np.diff(at) > 0, n + 1, 0)


def _cut_slowly(line: str) -> np.ndarray:
    pieces = _GAP.split(line)
    wrong = next((p for p in pieces if not _WHOLE.fullmatch(p) or not -(1 << 31) <= int(p) < 1 << 31), None)
    if wrong is not None:
        raise ValueError(f"{wrong!r} is no whole number of 32 bits")
    return np.array([int(p) for p in pieces], np.int32)


def _cut_plain(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The numbers of bytes with one blank behind each, and where those blanks are; none, if there is anything but short runs of digits and single blanks."""
    blank = a == 32
    digit = (a - np.uint8(48)) * ~blank
    if digit.max() > 9:
        return None
    ends = np.flatnonzero(blank)
    length = np.empty_like(ends)
    length[0], length[1:] = ends[0], ends[1:] - ends[:-1] - 1
    if length.min() < 1 or length.max() > 9:
        return None
    two = digit.copy()
    two[1:] += digit[:-1] * np.uint8(10)  # 99 at most; in front of a number of one digit is a blank, which counts 0
    out = two.take(ends - 1).astype(np.int32)
    long, k = np.flatnonzero(length > 2), 3
    while len(long):
        out[long] += digit.take(ends.take(long) - k).astype(np.int32) * np.int32(10 ** (k - 1))
        k += 1
        long = long[length.take(long) >= k]
    return out, ends


def cut(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lines, one after the other, and how many each line has."""
    text = _trimmed(lines)
    n = np.zeros(len(text), np.int64)
    full = np.flatnonzero(pc.binary_length(text).to_numpy(zero_copy_only=False) > 0)
    if not len(full):
        return np.empty(0, np.int32), n
    if len(full) < len(text):
        text = text.take(pa.array(full))
    a, at = _bytes(pc.binary_join_element_wise(text, "", " "))
    plain = _cut_plain(a)
    if plain is None:
        parts = [_cut_slowly(x) for x in text.to_pylist()]
        n[full] = [len(p) for p in parts]
        return np.concatenate(parts), n
    values, ends = plain
    n[full] = np.diff(np.searchsorted(ends, at))
    return values, n


def whole_records(lines: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records of ``size`` numbers as the rows of a matrix, the line of each and its place there; lines that don't divide into records give none."""
    values, n = cut(lines)
    odd = n % size != 0
    if odd.any():
        values, n = values[~np.repeat(odd, n)], np.where(odd, 0, n)
    per = n // size
    return values.reshape(-1, size), np.repeat(np.arange(len(n)), per), np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)


def lists(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * np.int32(width)), pa.array(np.ascontiguousarray(matrix).ravel()))
