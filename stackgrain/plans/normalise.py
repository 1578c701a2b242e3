"""Folders of TIFF files, each of one page or a stack, brought to 8 bits with their mode at one level.

Percentiles, extremes and modes are those of a whole file. Three passes over its slices, which tasks read by ranges:
counts of the values, counts of the 8-bit levels, and the levels themselves, which go into one file again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackgrain.sources import volume

def _array(r: dict) -> np.ndarray:
    return np.frombuffer(r["data"], np.dtype(r["dtype"]).newbyteorder("<")).reshape(r["height"], r["width"])


def _levels(r: dict, method: str) -> np.ndarray:
    """A slice's 8-bit levels by the limits of its file; slices of 8 bits stay as they are."""
    a = _array(r)
    if r["is8"]:
        return a
    if method == "divide256":
        return np.clip(np.floor(a.astype(np.float64) / 256), 0, 255).astype(np.uint8)
    if r["hi"] <= r["lo"]:
        return np.zeros(a.shape, np.uint8)
    return np.clip((a.astype(np.float64) - r["lo"]) * 255 / (r["hi"] - r["lo"]), 0, 255).astype(np.uint8)


def _counted(slices: DataFrame, of: Callable[[dict], np.ndarray]) -> DataFrame:
    """(path, v, n): how often each value that `of` gives for a slice occurs in its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (r,) = batch.slice(i, 1).to_pylist()
                v, n = np.unique(of(r), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * len(v), pa.string()), pa.array(v.astype(np.float64)), pa.array(n)], names=["path", "v", "n"])

    return slices.mapInArrow(run, "path string, v double, n long").groupBy("path", "v").agg(F.sum("n").alias("n"))


def normalised(slices: DataFrame, method: str = "percentile", p_low: float = 0.5, p_high: float = 99.5, low: int = 100, high: int = 254, target: int = 200) -> DataFrame:
    """(path, z, height, width, dtype, data): decoded slices as 8-bit levels, by percentiles or extremes of their file or a
    division by 256, then scaled so that the file's most frequent level of low..high (the lowest of ties) becomes the
    target; files without one are not scaled. Slices that could not be decoded fail the query."""
    if method not in ("percentile", "minmax", "divide256"):
        raise ValueError(f"unknown method {method}")
    read = slices.select("path", "z", "height", "width", "dtype", F.when(F.col("problem").isNull(), F.col("data")).otherwise(F.raise_error(F.concat("path", F.lit(": "), "problem")).cast("binary")).alias("data"))
    is8 = (F.col("dtype") == "uint8").alias("is8")
    shares = F.percentile("v", F.array(F.lit(p_low / 100), F.lit(p_high / 100)), F.col("n"))
    ends = F.array(F.min("v"), F.max("v")) if method == "minmax" else shares
    wide = _counted(read.where("dtype <> 'uint8'"), _array).groupBy("path").agg(ends.alias("q"))
    limited = read.join(wide.select("path", F.round(F.col("q")[0], 9).alias("lo"), F.round(F.col("q")[1], 9).alias("hi")), "path", "left").withColumn("is8", is8)
    inside = F.when(F.col("v").between(low, high), F.struct("n", (-F.col("v")).alias("v")))
    modes = _counted(limited, lambda r: _levels(r, method)).groupBy("path").agg(F.coalesce(-F.max(inside)["v"], F.lit(0.0)).alias("mode"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (r,) = batch.slice(i, 1).to_pylist()
                a = _levels(r, method)
                if r["mode"] > 0:
                    a = np.clip(a.astype(np.float64) * target / r["mode"], 0, 255).astype(np.uint8)
                yield pa.RecordBatch.from_pylist([{"path": r["path"], "z": r["z"], "height": a.shape[0], "width": a.shape[1], "dtype": "uint8", "data": a.tobytes()}], schema=out)

    out = pa.schema([("path", pa.string()), ("z", pa.int64()), ("height", pa.int64()), ("width", pa.int64()), ("dtype", pa.string()), ("data", pa.binary())])
    return limited.join(modes, "path").mapInArrow(run, "path string, z long, height long, width long, dtype string, data binary")


def normalise_folder(spark: SparkSession, folder: str, to: str, suffix: str = "_norm8", method: str = "percentile", p_low: float = 0.5, p_high: float = 99.5) -> None:
    """Writes each TIFF file of a folder, normalised, into a mounted folder under its name with the suffix behind the stem:
    a stack stays a stack."""
    slices = volume.read_volumes(spark, folder).where(F.lower("path").rlike(r"\.tiff?$"))
    own = normalised(slices, method, p_low, p_high).withColumn("scan_id", F.col("path"))
    stem = F.regexp_extract("name", r"([^/]+?)(\.[^./]*)\.tif$", 1)
    kind = F.regexp_extract("name", r"(\.[^./]*)\.tif$", 1)
    pieces = volume.tiff_pieces(own).withColumn("name", F.concat(stem, F.lit(suffix), kind))
    volume.write_pieces(pieces, to)
