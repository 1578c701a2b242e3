"""Local thickness: for each pore voxel twice the largest whole radius of a ball inside the pore space that covers it.

A voxel c at distance at least k = floor(edt) from solid gives a ball of radius k; balls that lie inside a neighbour's
ball are dropped first. The rest spread axis by axis, as distances do. A ball of radius k has the room k^2 at its centre,
and a step of d along an axis takes d^2 of it; where some is left (or none is lacking), the ball covers the voxel. Of the
balls that reach a voxel only those stay that no other ball beats in both radius and room, since the axes to come take the
same from all of them. After z and y, the pass along x keeps the largest radius of each pore voxel. So no ball is expanded:
each axis costs one shuffle by line, and the rows grow with the voxels times the few balls that stay at one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slices import once, whole_lines

VOXEL = ["scan_id", "z", "y", "x"]


def ball_centres(distances: DataFrame) -> DataFrame:
    """(scan_id, z, y, x, k) of the balls that no face neighbour's ball contains."""
    df = distances.where("edt2 >= 1").select("scan_id", "z", "y", "x", F.floor(F.sqrt("edt2")).cast("long").alias("k"))
    df = df.withColumn("best", F.lit(0).cast("long"))
    for axis in "zyx":
        w = Window.partitionBy("scan_id", *(c for c in "zyx" if c != axis)).orderBy(axis)
        for move in (F.lag, F.lead):
            next_to = F.abs(move(axis).over(w) - F.col(axis)) == 1
            df = df.withColumn("best", F.greatest("best", F.when(next_to, move("k").over(w))))
    return df.where("best <= k").drop("best")


def unbeaten(place: np.ndarray, k: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The (k, room) of each place that no other one there reaches in both, by place and then from the largest k down.
    All are whole numbers from 0 on."""
    if not len(place):
        return place, k, room
    top_k, top = int(k.max()), int(room.max())
    bits_k, bits = top_k.bit_length(), top.bit_length()
    if int(place.max()).bit_length() + bits_k + bits > 63:
        raise ValueError(f"a radius of {top_k} is too large")
    packed = np.sort((place << (bits_k + bits)) | ((top_k - k) << bits) | (top - room))
    room = top - (packed & ((1 << bits) - 1))
    k = top_k - ((packed >> bits) & ((1 << bits_k) - 1))
    place = packed >> (bits_k + bits)
    new = np.append(True, place[1:] != place[:-1])
    score = (np.cumsum(new) - 1) * (top + 1) + room  # a later place beats all before it
    keep = np.append(True, score[1:] > np.maximum.accumulate(score)[:-1])
    return place[keep], k[keep], room[keep]


def along(line: np.ndarray, at: np.ndarray, k: np.ndarray, room: np.ndarray, low: np.ndarray, high: np.ndarray, most: int = 1 << 18):
    """The unbeaten balls of all places of the lines, low..high, that balls at some of them reach: arrays of line, place,
    k and room, ordered by line and place. Lines come in order; about so many steps are held at a time."""
    if not len(line):
        return line, at, k, room
    reach = np.sqrt(room.astype(np.float64)).astype(np.int64)
    first, last = np.maximum(at - reach, low), np.minimum(at + reach, high)
    steps = last - first + 1
    base = int(first.min())
    span = int(last.max()) - base + 1
    found = []
    part = np.cumsum(steps) // most
    starts = np.nonzero(np.append(True, line[1:] != line[:-1]))[0]
    cuts = [i for j, i in enumerate(starts) if j and part[i] != part[starts[j - 1]]]
    for i, j in zip([0, *cuts], [*cuts, len(line)], strict=True):
        n = steps[i:j]
        own = np.repeat(np.arange(i, j), n)
        to = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        place, *ball = unbeaten((line[own] - line[i]) * span + to - base, k[own], room[own] - (to - at[own]) ** 2)
        found.append((place // span + line[i], place % span + base, *ball))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _spread(balls: DataFrame, axis: str) -> DataFrame:
    """Balls (scan_id, z, y, x, k, room, <axis>_lo, <axis>_hi, ...) along an axis, whose bounds go."""
    keys = [c for c in VOXEL if c != axis]
    names = [c for c in balls.columns if c not in (f"{axis}_lo", f"{axis}_hi")]
    same = [c for c in names if c not in (axis, "k", "room")]

    def run(t: pa.RecordBatch, line: np.ndarray) -> pa.RecordBatch:
        number, place, k, room = along(line, *(t.column(c).to_numpy() for c in (axis, "k", "room", f"{axis}_lo", f"{axis}_hi")))
        start = pa.array(np.searchsorted(line, number))
        made = {axis: pa.array(place), "k": pa.array(k), "room": pa.array(room)} | {c: t.column(c).take(start) for c in same}
        return pa.RecordBatch.from_arrays([made[c] for c in names], names=names)

    kinds = dict(balls.dtypes)
    return whole_lines(balls, keys, run, ", ".join(f"{c} {kinds[c]}" for c in names))


def _largest(rows: DataFrame, kind: str) -> DataFrame:
    """(scan_id, z, y, x, edt2, diameter) of the rows with k = 0, from the balls on their lines along x."""

    def run(t: pa.RecordBatch, line: np.ndarray) -> pa.RecordBatch:
        at, k, room, low, high = (t.column(c).to_numpy() for c in ("x", "k", "room", "x_lo", "x_hi"))
        ball = k > 0
        number, place, widest, _ = along(*(a[ball] for a in (line, at, k, room, low, high)))
        base = min(int(at.min()), int(place.min(initial=at[0])))
        span = max(int(at.max()), int(place.max(initial=at[0]))) - base + 1
        covered, pore = number * span + place - base, (line * span + at - base)[~ball]
        i = np.searchsorted(covered, pore)  # the first of a place has its largest radius
        hit = np.append(covered, -1)[i] == pore
        diameter = np.where(hit, 2 * np.append(widest, 0)[i], 0)
        own = t.select([*VOXEL, "edt2"]).filter(pa.array(~ball))
        return pa.RecordBatch.from_arrays([*own.columns, pa.array(diameter)], names=[*VOXEL, "edt2", "diameter"])

    scan = dict(rows.dtypes)["scan_id"]
    return whole_lines(rows, ["scan_id", "z", "y"], run, f"scan_id {scan}, z long, y long, x long, edt2 {kind}, diameter long")


def opening(distances: DataFrame) -> DataFrame:
    """(scan_id, z, y, x, edt2, diameter) of the pore voxels; distances as edt() gives them, used three times and so
    computed once and kept. Voxels that have no row are no obstacle. Scans without solid, whose distances are null, have
    no rows."""
    kind = dict(distances.dtypes)["edt2"]
    distances = once(distances)
    box = distances.groupBy("scan_id").agg(*(f(c).cast("long").alias(f"{c}_{n}") for c in "zyx" for f, n in ((F.min, "lo"), (F.max, "hi"))))
    place = [F.col("scan_id"), *(F.col(c).cast("long").alias(c) for c in "zyx")]
    balls = ball_centres(distances).select(*place, "k", (F.col("k") * F.col("k")).alias("room")).join(box, "scan_id")
    for axis in "zy":
        balls = _spread(balls, axis)
    none = [F.lit(0).cast("long").alias(c) for c in ("k", "room", "x_lo", "x_hi")]
    pores = distances.where("is_pore and edt2 is not null").select(*place, *none, "edt2")
    return _largest(balls.withColumn("edt2", F.lit(None).cast(kind)).unionByName(pores), kind)
