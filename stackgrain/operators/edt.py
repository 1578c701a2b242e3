"""Exact Euclidean distance transform of binary volumes (scan_id, z, y, x, is_pore).

The squared distance to the nearest solid voxel is found axis by axis: along z by window functions, then along y and x
by taking, on each line, the least of g(y') + (y - y')^2 (by the lower envelope of these parabolas, which is linear in
the line). Integers keep it exact; there is no halo and no block error, and each axis costs one shuffle by line. Outside the volume is not solid. A scan without a solid voxel gets nulls. Scans
have to be whole boxes: a place without a row hands no distance on from one axis to the next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slices import whole_lines

FAR = 1 << 60


#: Offsets tried one by one before a line goes to the envelope: near solid they settle most lines at once.
OFFSETS = 16


def least_along(g: np.ndarray, weight: float = 1) -> np.ndarray:
    """For lines in rows: the least of g(j) + weight * (i - j)^2 over j. Far entries are FAR.

    The nearest offsets are tried on all lines; a line is settled when the next offset alone exceeds all its values. The
    others, and no line without a single near entry, go to the lower envelope, which takes one pass along the line."""
    best, n = g.copy(), g.shape[1]
    left = np.nonzero((g < FAR).any(axis=1) & (g > 0).any(axis=1))[0]
    now, own = best[left], g[left]
    for d in range(1, n):
        add = weight * d * d
        if not len(left) or add >= now.max(initial=0):
            break
        if d > OFFSETS:
            open_ = now.max(axis=1) > add
            now[open_] = lower_envelope(own[open_], weight)
            break
        np.minimum(now[:, d:], own[:, :-d] + add, out=now[:, d:])
        np.minimum(now[:, :-d], own[:, d:] + add, out=now[:, :-d])
    best[left] = now
    return best


def lower_envelope(g: np.ndarray, weight: float = 1) -> np.ndarray:
    """least_along for lines that have near entries, by the lower envelope of their parabolas.

    Entries are put on each line's stack from left to right. An entry rules from the first place where it is strictly
    less than the one below it; what would never rule is taken off. All lines take a step together, and only lines that
    still take something off go on, so the work is linear in the number of entries."""
    lines, n = g.shape
    whole = g.dtype.kind == "i"
    height = (g if whole else g / weight) + np.arange(n) ** 2
    place, start = np.zeros((lines, n), np.int64), np.zeros((lines, n), np.int64)
    top = np.full(lines, -1)
    for q in range(n):
        own = np.nonzero(g[:, q] < FAR)[0]
        begin = np.zeros(len(own), np.int64)
        at = np.nonzero(top[own] >= 0)[0]  # those with something on the stack
        while len(at):
            line = own[at]
            below = place[line, top[line]]
            rise, run = height[line, q] - height[line, below], 2 * (q - below)
            begin[at] = (rise // run if whole else np.minimum(np.floor(rise / run), n)).astype(np.int64) + 1
            off = begin[at] <= start[line, top[line]]
            top[line[off]] -= 1
            at = at[off]
            empty = top[own[at]] < 0
            begin[at[empty]] = 0
            at = at[~empty]
        rules = begin < n
        line, begin = own[rules], begin[rules]
        top[line] += 1
        place[line, top[line]], start[line, top[line]] = q, begin
    used = np.arange(n) <= top[:, None]
    line, k = np.nonzero(used)
    ruler = np.zeros((lines, n), np.int64)
    ruler[line, start[line, k]] = place[line, k]  # places rise along a line, so the last one set rules on
    ruler = np.maximum.accumulate(ruler, axis=1)
    step = np.arange(n) - ruler
    return np.take_along_axis(g, ruler, axis=1) + (step * step if whole else weight * step * step)


def _line_pass(df: DataFrame, axis: str, weight: float) -> DataFrame:
    keys = [c for c in ("scan_id", "z", "y", "x") if c != axis]
    kinds = dict(df.dtypes)
    kind = np.float64 if kinds["g"] == "double" else np.int64

    def run(t: pa.RecordBatch, line: np.ndarray) -> pa.RecordBatch:
        at = t.column(axis).to_numpy()
        start = np.nonzero(np.append(True, line[1:] != line[:-1]))[0]
        at = at - np.minimum.reduceat(at, start)[line]
        own = t.column("g").fill_null(kind(FAR)).to_numpy()
        length = np.maximum.reduceat(at, start) + 1
        best = np.empty(len(own), kind)
        # Lines of about one length together, so that a long one does not widen all others.
        size = np.ceil(np.log2(length)).astype(np.int64)
        for k in np.unique(size):
            pick = np.nonzero(size == k)[0]
            number = np.full(len(start), -1)
            number[pick] = np.arange(len(pick))
            here = np.nonzero(number[line] >= 0)[0]
            g = np.full((len(pick), int(length[pick].max())), FAR, kind)
            g[number[line[here]], at[here]] = own[here]
            best[here] = least_along(g, weight)[number[line[here]], at[here]]
        return pa.RecordBatch.from_arrays([*(t.column(k) for k in keys), t.column(axis), pa.array(best, mask=best >= FAR)], names=[*keys, axis, "g"])

    return whole_lines(df, keys, run, ", ".join(f"{c} {kinds[c]}" for c in (*keys, axis, "g")))


def edt(volume: DataFrame, spacing: tuple[float, float, float] = (1, 1, 1)) -> DataFrame:
    """(scan_id, z, y, x, is_pore, edt2): squared distances, bigint for unit spacing and double otherwise."""
    whole = all(s == 1 for s in spacing)
    wz, wy, wx = (1, 1, 1) if whole else (float(s) ** 2 for s in spacing)
    line = Window.partitionBy("scan_id", "y", "x").orderBy("z")
    solid = F.when(~F.col("is_pore"), F.col("z"))
    below = F.last(solid, ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first(solid, ignorenulls=True).over(line.rowsBetween(0, Window.unboundedFollowing))
    step = F.least(F.col("z") - below, above - F.col("z"))
    g = (step * step).cast("long") if whole else step * step * F.lit(wz)
    df = volume.select("scan_id", "z", "y", "x", g.alias("g"))
    for axis, weight in (("y", wy), ("x", wx)):
        df = _line_pass(df, axis, weight)
    return df.select("scan_id", "z", "y", "x", (F.col("g").isNull() | (F.col("g") > 0)).alias("is_pore"), F.col("g").alias("edt2"))
