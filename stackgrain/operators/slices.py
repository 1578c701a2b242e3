"""Kernels over whole slices: voxels of a slice as one dense array, by grouping on (scan_id, z).

One task holds one slice, which is how big a slice may be; a shuffle brings its voxels together. Missing voxels are
filled. Results have one row for each voxel of the input.

Kernels over tiles: larger slices are cut into tiles of bounded size, each with a rim copied from its neighbours (as
wide as the kernel reaches), and only results of the tile itself are kept. At the slice's own border there is no rim, so a
kernel's border rule applies there as it does to the whole slice.

Kernels over whole lines, by sorting on their keys: a task reads its lines one after another, in batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Kernel = Callable[..., dict[str, np.ndarray]]


def per_slice(df: DataFrame, columns: list[str], kernel: Kernel, out: dict[str, str], fill: float | dict[str, float] = 0) -> DataFrame:
    """kernel gets one 2-D array (y, x) for each of columns and returns one for each of out (name: Spark type).

    The output has scan_id, z, y, x and the columns of out. fill: what stands for missing voxels, or one for each column."""
    kinds = dict(df.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in ("scan_id", "z", "y", "x")) + ", " + ", ".join(f"{k} {v}" for k, v in out.items())

    def run(t: pa.Table) -> pa.Table:
        y, x = t.column("y").to_numpy(), t.column("x").to_numpy()
        y0, x0 = y.min(), x.min()
        shape = (y.max() - y0 + 1, x.max() - x0 + 1)
        arrays = []
        for c in columns:
            values = t.column(c).to_numpy()
            dense = np.full(shape, fill[c] if isinstance(fill, dict) else fill, values.dtype)
            dense[y - y0, x - x0] = values
            arrays.append(dense)
        found = kernel(*arrays)
        own = {k: t.column(k) for k in ("scan_id", "z", "y", "x")}
        for k in out:
            got = found[k][y - y0, x - x0]
            own[k] = pa.array(got, mask=np.isnan(got)) if got.dtype.kind == "f" else pa.array(got)
        return pa.table(own)

    return df.select("scan_id", "z", "y", "x", *columns).groupBy("scan_id", "z").applyInArrow(run, schema)


def tile_of(place: Column, tile: int) -> Column:
    """The number of the tile that a coordinate, counted from the slice's first one, lies in."""
    return F.floor(place / tile)


def per_tile(df: DataFrame, columns: list[str], kernel: Kernel, out: dict[str, str], halo: int, tile: int, fill: float = 0) -> DataFrame:
    """per_slice for kernels that look at most `halo` voxels far, on tiles of tile x tile voxels: one task holds one tile
    and its rim, whatever the slice's size."""
    kinds = dict(df.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in ("scan_id", "z", "y", "x")) + ", " + ", ".join(f"{k} {v}" for k, v in out.items())
    box = df.groupBy("scan_id", "z").agg(*(f(c).cast("long").alias(f"{c}{n}") for c in "yx" for f, n in ((F.min, 0), (F.max, 1))))
    rows = df.select("scan_id", "z", "y", "x", *columns).join(box, ["scan_id", "z"])
    for c in "yx":
        at, last = F.col(c) - F.col(f"{c}0"), tile_of(F.col(f"{c}1") - F.col(f"{c}0"), tile)
        first = F.greatest(tile_of(at - halo, tile), F.lit(0))
        rows = rows.withColumn(f"t{c}", F.explode(F.sequence(first, F.least(tile_of(at + halo, tile), last))))

    def run(t: pa.Table) -> pa.Table:
        one = {k: t.column(k)[0].as_py() for k in ("ty", "tx", "y0", "y1", "x0", "x1")}
        low = {c: one[f"{c}0"] + one[f"t{c}"] * tile for c in "yx"}
        top, left = (max(one[f"{c}0"], low[c] - halo) for c in "yx")
        bottom, right = (min(one[f"{c}1"], low[c] + tile - 1 + halo) for c in "yx")
        y, x = t.column("y").to_numpy(), t.column("x").to_numpy()
        arrays = []
        for c in columns:
            values = t.column(c).to_numpy()
            dense = np.full((bottom - top + 1, right - left + 1), fill, values.dtype)
            dense[y - top, x - left] = values
            arrays.append(dense)
        found = kernel(*arrays)
        core = np.nonzero((y >= low["y"]) & (y < low["y"] + tile) & (x >= low["x"]) & (x < low["x"] + tile))[0]
        inner = t.take(pa.array(core))
        own = {k: inner.column(k) for k in ("scan_id", "z", "y", "x")}
        for k in out:
            got = found[k][y[core] - top, x[core] - left]
            own[k] = pa.array(got, mask=np.isnan(got)) if got.dtype.kind == "f" else pa.array(got)
        return pa.table(own)

    return rows.groupBy("scan_id", "z", "ty", "tx").applyInArrow(run, schema)


def around(df: DataFrame, columns: list[str], kernel: Kernel, out: dict[str, str], halo: int, tile: int | None, fill: float = 0) -> DataFrame:
    """A neighbourhood kernel on whole slices, or on tiles of so many voxels a side."""
    return per_slice(df, columns, kernel, out, fill) if tile is None else per_tile(df, columns, kernel, out, halo, tile, fill)


def once(df: DataFrame) -> DataFrame:
    """df computed once for its several uses: checkpointed where the session has a checkpoint folder, else kept by the
    executors and on their disks (Spark computes again what is lost)."""
    if df.sparkSession.sparkContext.getCheckpointDir():
        return df.checkpoint()
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def line_numbers(rows: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """The number, from 0, of each row's line: rows with equal keys that stand together."""
    new = np.zeros(rows.num_rows, np.int64)
    for k in keys:
        code = rows.column(k).dictionary_encode("encode").indices.to_numpy()
        new[1:] |= code[1:] != code[:-1]
    return np.cumsum(new)


#: Rows that are gathered before a kernel over lines is called, unless a single line has more. Few, so that a small task
#: already holds as many as any larger one, and memory does not follow the input.
ROWS = 1 << 15


def whole_lines(df: DataFrame, keys: list[str], kernel: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """kernel gets rows of whole lines (rows with equal keys, in no order inside a line) with their line numbers, and
    returns rows of the schema. About ROWS rows are held at a time, or the longest line if that is larger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, wait, size = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            wait.append(batch)
            size += batch.num_rows
            if size < ROWS:
                continue
            rows = pa.concat_batches(wait if held is None else [held, *wait])
            held, wait, size = None, [], 0
            line = line_numbers(rows, keys)
            cut = int(np.searchsorted(line, line[-1]))  # the last line may go on
            if cut:
                yield kernel(rows.slice(0, cut), line[:cut])
            held = rows.slice(cut)
        rest = wait if held is None else [held, *wait]
        if rest:
            rows = pa.concat_batches(rest)
            yield kernel(rows, line_numbers(rows, keys))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
