"""Connected components of the target in each slice (eight neighbours), and how they persist along z."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slices import around as around_
from .slices import once, per_slice, tile_of, whole_lines
from .union import stars


def label_components(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers (0 outside, else 1, 2, ... in raster order of the first pixel) and sizes by pixel.

    Runs of a row are joined with the runs they touch in the row above; union-find over runs."""
    height, width = mask.shape
    flat = np.pad(mask, ((0, 0), (1, 1))).astype(np.int8)
    edge = np.diff(flat, axis=1)
    ys, starts = np.nonzero(edge == 1)
    ends = np.nonzero(edge == -1)[1]  # exclusive; both are in raster order
    parent = np.arange(len(ys))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(ys, np.arange(height + 1))
    for y in range(1, height):
        above, here = first[y - 1], first[y]
        for i in range(here, first[y + 1]):
            while above < here and ends[above] < starts[i]:
                above += 1
            k = above
            while k < here and starts[k] <= ends[i]:
                a, b = root(k), root(i)
                parent[max(a, b)] = min(a, b)
                k += 1
    roots = np.array([root(i) for i in range(len(ys))], np.int64)
    _, number = np.unique(roots, return_inverse=True)
    size = np.bincount(number, ends - starts) if len(ys) else np.empty(0)
    out, sizes = np.zeros(mask.shape, np.int64), np.zeros(mask.shape, np.int64)
    for y, s, e, n in zip(ys, starts, ends, number, strict=True):
        out[y, s:e] = n + 1
        sizes[y, s:e] = size[n]
    return out, sizes


def _tile_components(labels: DataFrame, target: int, tile: int) -> DataFrame:
    """(scan_id, z, y, x, label, node): node names a component inside one tile by its first pixel, (y << 32) + x, so that
    nodes of a slice are ordered as their pixels are; null outside the target. Coordinates are not negative."""
    kinds = dict(labels.dtypes)

    def run(t: pa.RecordBatch, line: np.ndarray) -> pa.RecordBatch:
        y, x, label = (t.column(c).to_numpy().astype(np.int64) for c in ("y", "x", "label"))
        start = np.nonzero(np.append(True, line[1:] != line[:-1]))[0]
        top, left = (np.minimum.reduceat(c, start) for c in (y, x))
        height, width = (np.maximum.reduceat(c, start) - low + 1 for c, low in ((y, top), (x, left)))
        end = np.append(start[1:], len(y))
        node, inside = np.zeros(len(y), np.int64), np.zeros(len(y), bool)
        # Tiles are stacked in one mask with an empty row between, so many pixels at a time.
        part = np.cumsum((height + 1) * width.max()) // (1 << 20)
        for own in np.split(np.arange(len(start)), np.nonzero(np.diff(part))[0] + 1):
            rows = slice(start[own[0]], end[own[-1]])
            base = np.append(0, np.cumsum(height[own] + 1))
            at = line[rows] - own[0]
            i, j = base[at] + y[rows] - top[own][at], x[rows] - left[own][at]
            mask = np.zeros((base[-1], width[own].max()), bool)
            mask[i, j] = label[rows] == target
            comp, _ = label_components(mask)
            number, first = np.unique(comp.ravel(), return_index=True)
            fy, fx = first // mask.shape[1], first % mask.shape[1]
            tile_ = np.searchsorted(base, fy, side="right") - 1
            name = np.zeros(int(number[-1]) + 1, np.int64)
            name[number] = ((top[own][tile_] + fy - base[tile_]) << 32) + left[own][tile_] + fx
            node[rows], inside[rows] = name[comp[i, j]], comp[i, j] > 0
        return pa.RecordBatch.from_arrays([*(t.column(k) for k in ("scan_id", "z", "y", "x", "label")), pa.array(node, mask=~inside)], names=["scan_id", "z", "y", "x", "label", "node"])

    tiles = [tile_of(F.col(c), tile).alias(f"t{c}") for c in "yx"]
    schema = ", ".join(f"{k} {kinds[k]}" for k in ("scan_id", "z", "y", "x", "label")) + ", node long"
    return whole_lines(labels.select("scan_id", "z", "y", "x", "label", *tiles), ["scan_id", "z", "ty", "tx"], run, schema)


def _tiled(labels: DataFrame, target: int, tile: int) -> DataFrame:
    """components() of slices that no task shall hold: tiles are labelled alone, pixels that touch across their borders
    give edges, edges are joined to components, and those are numbered by their first pixels."""
    slice_ = ["scan_id", "z"]
    found = once(_tile_components(labels, target, tile))
    inside = found.where("node is not null")
    at = lambda c: F.pmod(F.col(c), F.lit(tile))
    rim = inside.where((at("y") == 0) | (at("y") == tile - 1) | (at("x") == 0) | (at("x") == tile - 1)).select(*slice_, *(F.col(c).cast("long").alias(c) for c in "yx"), "node")
    # Four of the eight neighbours: the others are seen from the other side.
    steps = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((0, 1), (1, -1), (1, 0), (1, 1))))
    looks = rim.select(*slice_, "y", "x", F.col("node").alias("a"), F.explode(steps).alias("s")).select(
        *slice_, "a", tile_of(F.col("y"), tile).alias("ty"), tile_of(F.col("x"), tile).alias("tx"), (F.col("y") + F.col("s.dy")).alias("y"), (F.col("x") + F.col("s.dx")).alias("x")
    )
    across = looks.where((tile_of(F.col("y"), tile) != F.col("ty")) | (tile_of(F.col("x"), tile) != F.col("tx")))
    edges = across.join(rim.withColumnRenamed("node", "b"), [*slice_, "y", "x"]).select(*slice_, "a", "b").distinct()
    nodes = once(inside.groupBy(*slice_, "node").agg(F.count("*").alias("n")).join(stars(edges, slice_), [*slice_, "node"], "left").withColumn("root", F.coalesce("root", "node")))
    whole = nodes.groupBy(*slice_, "root").agg(F.sum("n").alias("comp_size"))
    numbered = whole.withColumn("comp", F.row_number().over(Window.partitionBy(*slice_).orderBy("root")).cast("long"))
    named = nodes.join(numbered, [*slice_, "root"]).select(*slice_, "node", "comp", "comp_size")
    return found.join(named, [*slice_, "node"], "left").select(*slice_, "y", "x", "label", "comp", "comp_size")


def components(labels: DataFrame, target: int = 1, tile: int | None = None) -> DataFrame:
    """(scan_id, z, y, x, label, comp, comp_size); both null outside the target. With tile no task holds more of a slice
    than so many pixels a side."""
    if tile is not None:
        return _tiled(labels, target, tile)

    def kernel(a: np.ndarray) -> dict[str, np.ndarray]:
        comp, size = label_components(a == target)
        return {"label": a, "comp": comp, "comp_size": size}

    found = per_slice(labels, ["label"], kernel, {"label": "long", "comp": "long", "comp_size": "long"}, fill=-1)
    inside = F.col("comp") > 0
    return found.withColumns({"comp_size": F.when(inside, F.col("comp_size")), "comp": F.when(inside, F.col("comp"))})


def neighbour_fractions(labels: DataFrame, target: int = 1, tile: int | None = None) -> DataFrame:
    """(scan_id, z, y, x, nb0, nb2) at target voxels: shares of classes 0 and 2 among the neighbours inside the slice."""

    def kernel(a: np.ndarray) -> dict[str, np.ndarray]:
        def around(m: np.ndarray) -> np.ndarray:
            p = np.pad(m.astype(np.float64), 1)
            total = sum(p[1 + dy : 1 + dy + m.shape[0], 1 + dx : 1 + dx + m.shape[1]] for dy in (-1, 0, 1) for dx in (-1, 0, 1))
            return total - m

        there = around(a >= 0)
        share = lambda c: np.where(there > 0, around(a == c) / np.maximum(there, 1), 0.0)
        return {"label": a, "nb0": share(0), "nb2": share(2)}

    shares = {"label": "long", "nb0": "double", "nb2": "double"}
    found = around_(labels, ["label"], kernel, shares, 1, tile, fill=-1)
    return found.where(F.col("label") == target).drop("label")


def overlaps(comps: DataFrame) -> DataFrame:
    """(scan_id, z, comp, prev): each component's choice in the slice before: the one it shares most pixels with, the
    lowest number of ties."""
    line = Window.partitionBy("scan_id", "y", "x").orderBy("z")
    before = comps.select("scan_id", "z", "comp", F.lag("comp").over(line).alias("prev"), (F.col("z") - F.lag("z").over(line)).alias("step"))
    shared = before.where("comp is not null and prev is not null and step = 1").groupBy("scan_id", "z", "comp", "prev").count()
    best = shared.groupBy("scan_id", "z", "comp").agg(F.max(F.struct("count", (-F.col("prev")).alias("p"))).alias("b"))
    return best.select("scan_id", "z", "comp", (-F.col("b.p")).alias("prev"))


def persistence(comps: DataFrame, mode: str = "compat", most: int = 40) -> DataFrame:
    """(scan_id, mean_life, median_life, max_life, n_lives).

    compat: lives are counted by component number over the whole stack, whatever the slice; tracked: by chains of
    choices, a chain living as many slices as it has components."""
    picks = overlaps(comps)
    if mode == "compat":
        lives = picks.groupBy("scan_id", "prev").agg((F.count("*") + 1).alias("life"))
    elif mode == "tracked":
        # Depth of each component in its chain of choices, by doubling over (slice, component).
        link = picks.select("scan_id", "z", "comp", (F.col("z") - 1).alias("pz"), "prev")
        here = comps.where("comp is not null").select("scan_id", "z", "comp").distinct()
        now = here.join(link, ["scan_id", "z", "comp"], "left").withColumn("depth", F.col("prev").isNotNull().cast("long"))
        for _ in range(most):
            names = {"scan_id": "scan2", "z": "z2", "comp": "c2", "pz": "pz2", "prev": "p2", "depth": "d2"}
            far = now.select(*(F.col(a).alias(b) for a, b in names.items()))
            j = now.join(far, F.expr("scan_id = scan2 and pz = z2 and prev = c2"), "left")
            deeper = F.col("depth") + F.coalesce("d2", F.lit(0))
            now = j.select("scan_id", "z", "comp", F.col("pz2").alias("pz"), F.col("p2").alias("prev"), deeper.alias("depth"))
            now = once(now)
            if now.where("prev is not null").isEmpty():
                break
        chosen = link.select("scan_id", F.col("pz").alias("z"), F.col("prev").alias("comp")).distinct()
        ends = now.join(chosen, ["scan_id", "z", "comp"], "left_anti")
        lives = ends.select("scan_id", (F.col("depth") + 1).alias("life")).where("life > 1")
    else:
        raise ValueError(f"unknown mode {mode}")
    found = lives.groupBy("scan_id").agg(
        F.avg("life").alias("mean_life"), F.percentile("life", F.lit(0.5)).alias("median_life"), F.max("life").cast("double").alias("max_life"), F.count("*").alias("n_lives")
    )
    scans = comps.select("scan_id").distinct()
    return scans.join(found, "scan_id", "left").na.fill(0)
