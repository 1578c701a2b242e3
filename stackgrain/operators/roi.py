"""Regions of interest and trimming of stacks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .binary import extents


def centre_crop(voxels: DataFrame, size: int) -> DataFrame:
    """The central size x size part of every slice, coordinates counted from its corner; too small a scan fails."""
    box = extents(voxels).select(
        "scan_id", F.floor((F.col("y1") + 1) / 2 - size // 2).cast("long").alias("top"), F.floor((F.col("x1") + 1) / 2 - size // 2).cast("long").alias("left"),
        F.when(F.least("y1", "x1") + 1 >= size, True).otherwise(F.raise_error(F.lit("the region does not fit")).cast("boolean")).alias("fits"),
    )
    j = voxels.join(box, "scan_id").where("fits")
    inside = F.col("y").between(F.col("top"), F.col("top") + size - 1) & F.col("x").between(F.col("left"), F.col("left") + size - 1)
    keep = [(F.col(c) - F.col({"y": "top", "x": "left"}[c])).alias(c) if c in "yx" else F.col(c) for c in voxels.columns]
    return j.where(inside).select(*keep)


def trim_slices(voxels: DataFrame, first: int, last: int) -> DataFrame:
    """Without the first and the last slices of each scan; z is counted anew."""
    slices = voxels.select("scan_id", "z").distinct()
    w = Window.partitionBy("scan_id").orderBy("z")
    rank = slices.select("*", (F.row_number().over(w) - 1).cast("long").alias("rank"), F.count("*").over(Window.partitionBy("scan_id")).alias("m"))
    kept = rank.where((F.col("rank") >= first) & (F.col("rank") < F.col("m") - last)).select("scan_id", "z", (F.col("rank") - first).alias("new"))
    j = voxels.join(kept, ["scan_id", "z"])
    return j.select(*(F.col("new").alias("z") if c == "z" else F.col(c) for c in voxels.columns))


def extract_roi(voxels: DataFrame, size: int = 650, first: int = 75, last: int = 75) -> DataFrame:
    return centre_crop(trim_slices(voxels, first, last), size)


def roi_stems(voxels: DataFrame, first: int = 75, last: int = 75) -> DataFrame:
    """(scan_id, z, stem) of what extract_roi gives: a slice's new number and the number that it had, as in
    ``roi_0000_slice0075``, for names of files."""
    slices = voxels.select("scan_id", F.col("z").alias("y"), F.lit(0).alias("x"), "z").distinct()
    kept = trim_slices(slices, first, last)
    return kept.select("scan_id", "z", F.format_string("roi_%04d_slice%04d", F.col("z"), F.col("y").cast("long")).alias("stem"))
