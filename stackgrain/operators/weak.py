"""Weak labels: a segmentation in which uncertain voxels are marked to be ignored; pairing of images and masks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import _boundary, _box_mean, _sobel
from .slices import per_slice


def weak_labels(
    gray_and_labels: DataFrame, window: int = 7, variance_percentile: float = 90, gradient_percentile: float = 90, distance: int = 3, pore: int = 0, ignore: int = 255
) -> DataFrame:
    """(scan_id, z, y, x, variance, gradient, boundary, weak) of voxels with v and label.

    A voxel is ignored if its local variance or its gradient lies above the slice's percentile, or near the pore
    surface. A criterion whose parameter is 0 or less is off."""

    def kernel(v: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        f = v / 255.0
        there = label != ABSENT
        variance, slope = np.maximum(_box_mean(f * f, window) - _box_mean(f, window) ** 2, 0), _sobel(f)
        boundary = _boundary(label == pore, distance)
        uncertain = boundary if distance > 0 else np.zeros_like(there)
        for values, p in ((variance, variance_percentile), (slope, gradient_percentile)):
            if p > 0:
                own = np.round(values, 9)
                uncertain = uncertain | (own > linear_percentile(own[there], p / 100))
        return {"variance": variance, "gradient": slope, "boundary": boundary, "weak": np.where(uncertain, ignore, label)}

    out = {"variance": "double", "gradient": "double", "boundary": "boolean", "weak": "long"}
    return per_slice(gray_and_labels, ["v", "label"], kernel, out, {"v": 0, "label": ABSENT})


#: What stands for a voxel without a row in a dense slice of labels.
ABSENT = -(1 << 31)


def linear_percentile(values: np.ndarray, share: float) -> float:
    """The percentile between the two nearest ranks, as Spark's percentile has it."""
    at = share * (len(values) - 1)
    low = int(at)
    part = np.partition(values, [low, min(low + 1, len(values) - 1)])
    a, b = part[low], part[min(low + 1, len(values) - 1)]
    return float(a if a == b else a * (low + 1 - at) + b * (at - low))


def slice_identifier(name: Column) -> Column:
    """The part of a file name before ``_pores_``, else the name without its extension."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.split(stem, "_pores_")[0]


def _last(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key with the largest order; partly aggregated before the shuffle, so a frequent key does no harm."""
    rest = F.struct(*(c for c in df.columns if c != key))
    best = df.groupBy(key).agg(F.max_by(rest, F.struct(F.col(order).isNotNull(), order)).alias("best_"))
    return best.select(key, "best_.*")


def pair(a: DataFrame, b: DataFrame, key: str, order_a: str, order_b: str) -> DataFrame:
    """Rows of a and b with equal keys; of equal keys on one side the last by its order wins."""
    return _last(a, key, order_a).join(_last(b, key, order_b), key)


def unmatched(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): keys found on one side only."""
    one = lambda x, y, name: x.select(key).distinct().join(y.select(key).distinct(), key, "left_anti").select(key, F.lit(name).alias("side"))
    return one(a, b, "a").unionByName(one(b, a, "b"))
