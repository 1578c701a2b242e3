"""Neighbourhood filters on slices (scan_id, z, y, x, v): medians, contrast, variance, gradients, boundaries.

With `tile` a slice is cut into tiles of so many voxels a side, for slices that a task cannot hold; without, it is
worked on whole. Both give the same values (variances and blurs up to rounding)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import around, per_slice, tile_of, whole_lines


def _windows(a: np.ndarray, size: int, mode: str) -> np.ndarray:
    """size x size windows around each pixel; mode is numpy's name of the border rule."""
    h = size // 2
    return sliding_window_view(np.pad(a, h, mode=mode), (size, size))


def median(gray: DataFrame, size: int = 5, border: str = "symmetric", tile: int | None = None) -> DataFrame:
    """Adds median. border: symmetric repeats the edge pixel and mirrors; edge repeats it alone."""

    def kernel(a: np.ndarray) -> dict[str, np.ndarray]:
        return {"median": np.median(_windows(a.astype(np.float64), size, border), axis=(2, 3))}

    return around(gray, ["v"], kernel, {"median": "double"}, size // 2, tile)


def _box_mean(a: np.ndarray, size: int) -> np.ndarray:
    """Means of size x size windows with mirrored borders, by summed areas."""
    padded = np.pad(a, size // 2, mode="symmetric")
    area = np.pad(padded.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    return (area[size:, size:] - area[:-size, size:] - area[size:, :-size] + area[:-size, :-size]) / size**2


def local_variance(gray: DataFrame, size: int = 7, tile: int | None = None) -> DataFrame:
    """Adds variance of v / 255 in windows with mirrored borders, at least 0."""

    def kernel(a: np.ndarray) -> dict[str, np.ndarray]:
        f = a / 255.0
        return {"variance": np.maximum(_box_mean(f * f, size) - _box_mean(f, size) ** 2, 0)}

    return around(gray, ["v"], kernel, {"variance": "double"}, size // 2, tile)


def _sobel(f: np.ndarray) -> np.ndarray:
    p = np.pad(f, 1, mode="symmetric")
    dx, dy = p[:, 2:] - p[:, :-2], p[2:] - p[:-2]
    gx = dx[:-2] + 2 * dx[1:-1] + dx[2:]
    gy = dy[:, :-2] + 2 * dy[:, 1:-1] + dy[:, 2:]
    return np.sqrt(gx * gx + gy * gy)


def gradient(gray: DataFrame, tile: int | None = None) -> DataFrame:
    """Adds gradient, the Sobel magnitude of v / 255 with mirrored borders."""
    return around(gray, ["v"], lambda a: {"gradient": _sobel(a / 255.0)}, {"gradient": "double"}, 1, tile)


def gaussian(gray: DataFrame, sigma: float, truncate: float = 4.0, tile: int | None = None) -> DataFrame:
    """Adds smooth: v blurred by a normal kernel cut off at truncate sigmas, borders mirrored; sigma 0 changes nothing."""
    h = int(truncate * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-h, h + 1) / sigma) ** 2) if sigma > 0 else np.ones(1)
    weights = weights / weights.sum()

    def along(a: np.ndarray, axis: int) -> np.ndarray:
        pad = [(h, h) if k == axis else (0, 0) for k in (0, 1)]
        return sliding_window_view(np.pad(a, pad, mode="symmetric"), 2 * h + 1, axis=axis) @ weights

    return around(gray, ["v"], lambda a: {"smooth": along(along(a.astype(np.float64), 0), 1)}, {"smooth": "double"}, h, tile)


def _shift(mask: np.ndarray, dy: int, dx: int, outside: bool) -> np.ndarray:
    h = max(abs(dy), abs(dx))
    p = np.pad(mask, h, constant_values=outside)
    return p[h + dy : h + dy + mask.shape[0], h + dx : h + dx + mask.shape[1]]


CROSS = ((0, 0), (0, 1), (0, -1), (1, 0), (-1, 0))


def disk(r: int) -> list[tuple[int, int]]:
    return [(y, x) for y in range(-r, r + 1) for x in range(-r, r + 1) if y * y + x * x <= r * r]


def _dilate(mask: np.ndarray, shape) -> np.ndarray:
    return np.logical_or.reduce([_shift(mask, y, x, False) for y, x in shape])


def _erode(mask: np.ndarray, shape) -> np.ndarray:
    return np.logical_and.reduce([_shift(mask, y, x, True) for y, x in shape])


def _boundary(pore: np.ndarray, distance: int) -> np.ndarray:
    zone = (_dilate(pore, CROSS) & ~pore) | (pore & ~_erode(pore, CROSS))
    return _dilate(zone, disk(distance)) if distance > 0 else zone


def boundary_zone(labels: DataFrame, pore: int = 0, distance: int = 3, tile: int | None = None) -> DataFrame:
    """Adds boundary: voxels on both sides of the pore surface, widened by a disk."""
    kernel = lambda a: {"boundary": _boundary(a == pore, distance)}
    return around(labels, ["label"], kernel, {"boundary": "boolean"}, 1 + max(0, distance), tile, fill=-1)


def _maps(hist: np.ndarray, clip: float) -> np.ndarray:
    """For histograms in rows: the running sums of the clipped histograms, as fractions."""
    total = hist.sum(axis=1, keepdims=True)
    limit = np.maximum(1.0, clip * total)
    over = np.maximum(hist - limit, 0).sum(axis=1, keepdims=True)
    return (np.minimum(hist, limit) + over / hist.shape[1]).cumsum(axis=1) / np.maximum(total, 1)


def _levels(f: np.ndarray, bins: int) -> np.ndarray:
    return np.minimum((f * (bins - 1) + 0.5).astype(np.int64), bins - 1)


def _mixed(own: Callable[[int, int], np.ndarray], wy: np.ndarray, wx: np.ndarray) -> np.ndarray:
    """The values of a pixel's level in the four maps around it, mixed by their distances."""
    top = own(0, 0) * (1 - wx) + own(0, 1) * wx
    return top * (1 - wy) + (own(1, 0) * (1 - wx) + own(1, 1) * wx) * wy


def clahe_array(f: np.ndarray, tile: int, clip: float, bins: int = 256) -> np.ndarray:
    """Contrast-limited adaptive equalisation of a slice of fractions.

    The slice is cut into tiles; each tile's histogram is clipped at clip times its pixels (at least one), the excess
    spread evenly, and its running sum taken as the map; each pixel mixes the maps of the four tile centres around it."""
    rows, cols = (max(1, -(-n // tile)) for n in f.shape)
    level = _levels(f, bins)
    y, x = np.indices(f.shape)
    cell = (y // tile) * cols + x // tile
    hist = np.bincount((cell * bins + level).ravel(), minlength=rows * cols * bins).reshape(rows * cols, bins).astype(np.float64)
    maps = _maps(hist, clip).reshape(rows, cols, bins)

    def near(place: np.ndarray, n: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        at = (place + 0.5) / tile - 0.5
        low = np.floor(at).astype(np.int64)
        return (np.clip(low, 0, n - 1), np.clip(low + 1, 0, n - 1)), np.clip(at - low, 0, 1)

    ys, wy = near(y, rows)
    xs, wx = near(x, cols)
    return _mixed(lambda i, j: maps[ys[i], xs[j], level], wy, wx)


def clahe_tiled(gray: DataFrame, tile: int, clip: float, scale: float = 255.0, bins: int = 256) -> DataFrame:
    """clahe_array on v / scale without a task that holds a slice: histograms by tile, and pixels sorted by the
    four tiles around them, whose maps a task makes for some regions at a time. Slices start at (0, 0)
    and have no gaps longer than a tile."""
    kinds = dict(gray.dtypes)
    key = f"scan_id {kinds['scan_id']}, z {kinds['z']}"
    level = F.least(F.floor(F.col("v") / scale * (bins - 1) + 0.5), F.lit(bins - 1)).cast("int")
    cell = [tile_of(F.col(c), tile).alias(f"t{c}") for c in "yx"]
    hist = gray.groupBy("scan_id", "z", *cell, level.alias("level")).agg(F.count("*").alias("n"))
    # A tile's counts stay sparse until a task makes its map: at most as many as it has pixels, or levels.
    maps = hist.groupBy("scan_id", "z", "ty", "tx").agg(F.collect_list("level").alias("levels"), F.collect_list("n").alias("counts"))
    last = gray.groupBy("scan_id", "z").agg(*(tile_of(F.max(c), tile).alias(f"m{c}") for c in "yx"))
    # A region (ly, lx) lies between the centres of tiles ly, ly + 1 and lx, lx + 1; at the slice's border both are the same.
    regions = maps.join(last, ["scan_id", "z"])
    for c in "yx":
        at, end = F.col(f"t{c}"), F.col(f"m{c}")
        sides = F.array(F.struct(at.alias("low"), F.lit(0).alias("side")), F.struct((at - 1).alias("low"), F.lit(1).alias("side")))
        first = F.when(at == 0, F.array(F.struct(F.lit(-1).cast("long").alias("low"), F.lit(0).alias("side")))).otherwise(F.array())
        final = F.when(at == end, F.array(F.struct(at.alias("low"), F.lit(1).alias("side")))).otherwise(F.array())
        regions = regions.withColumn("s", F.explode(F.concat(sides, first, final))).withColumns({f"l{c}": F.col("s.low"), f"s{c}": F.col("s.side")}).drop("s")
    regions = regions.select("scan_id", "z", "ly", "lx", (F.col("sy") * 2 + F.col("sx")).alias("side"), "levels", "counts")
    low = [tile_of(F.col(c) - tile / 2 + 0.5, tile).alias(f"l{c}") for c in "yx"]
    pixels = gray.select("scan_id", "z", "y", "x", "v", *low)
    by = ["scan_id", "z", "ly", "lx"]
    rows = pixels.unionByName(regions, allowMissingColumns=True)

    def run(t: pa.RecordBatch, line: np.ndarray) -> pa.RecordBatch:
        side = t.column("side").fill_null(-1).to_numpy()
        pixel, corner = np.nonzero(side < 0)[0], np.nonzero(side >= 0)[0]
        own = t.take(pa.array(pixel))
        level = _levels(own.column("v").to_numpy() / scale, bins)
        wy, wx = ((own.column(c).to_numpy() + 0.5) / tile - 0.5 - own.column(f"l{c}").to_numpy() for c in "yx")
        given = t.take(pa.array(corner)).select(["levels", "counts"])
        size = np.diff(given.column("levels").offsets.to_numpy())
        start = np.append(0, np.cumsum(size))
        levels, counts = (given.column(c).flatten().to_numpy() for c in ("levels", "counts"))
        got = np.zeros(len(pixel))
        lines = int(line[-1]) + 1
        for at in range(0, lines, 1024):  # dense maps of so many regions at a time
            end = min(lines, at + 1024)
            i, j = np.searchsorted(line[corner], (at, end))
            h = np.zeros((j - i, bins))
            h[np.repeat(np.arange(j - i), size[i:j]), levels[start[i] : start[j]]] = counts[start[i] : start[j]]
            m = _maps(h, clip)
            place = np.zeros((end - at, 4), np.int64)
            place[line[corner[i:j]] - at, side[corner[i:j]]] = np.arange(j - i)
            k, n = np.searchsorted(line[pixel], (at, end))
            if k < n:
                region, lev = line[pixel[k:n]] - at, level[k:n]
                got[k:n] = _mixed(lambda sy, sx: m[place[region, 2 * sy + sx], lev], wy[k:n], wx[k:n])  # noqa: B023
        return pa.RecordBatch.from_arrays([*(own.column(c) for c in ("scan_id", "z", "y", "x")), pa.array(got)], names=["scan_id", "z", "y", "x", "clahe"])

    return whole_lines(rows, by, run, f"{key}, y {kinds['y']}, x {kinds['x']}, clahe double")


def clahe(gray: DataFrame, tile: int = 61, clip: float = 0.01, by_tiles: bool = False) -> DataFrame:
    """Adds clahe, fractions of 0..1. An own form of the published method: no bit-wise parity with other libraries.
    by_tiles: no task holds a whole slice."""
    if by_tiles:
        return clahe_tiled(gray, tile, clip)
    return per_slice(gray, ["v"], lambda a: {"clahe": clahe_array(a / 255.0, tile, clip)}, {"clahe": "double"})


def preprocess(gray: DataFrame, tile: int = 61, clip: float = 0.01, size: int = 5, part: int | None = None) -> DataFrame:
    """The preprocessing of a slice: contrast, median, back to 0..255. Adds pre. part: the side of the tiles of the
    median, for slices that no task shall hold."""
    if part is not None:
        inside = gray.withColumn("v", F.least(F.greatest(F.col("v").cast("double"), F.lit(0.0)), F.lit(255.0)))
        m = median(clahe_tiled(inside, tile, clip).withColumnRenamed("clahe", "v"), size, tile=part)
        return m.select("scan_id", "z", "y", "x", F.rint(F.round(F.col("median") * 255, 9)).cast("long").alias("pre"))

    def kernel(a: np.ndarray) -> dict[str, np.ndarray]:
        f = clahe_array(np.clip(a / 255.0, 0, 1), tile, clip)
        middle = np.median(_windows(f, size, "symmetric"), axis=(2, 3)) * 255
        return {"pre": np.rint(np.round(middle, 9)).astype(np.int64)}

    return per_slice(gray, ["v"], kernel, {"pre": "long"})
