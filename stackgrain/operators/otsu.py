"""Multi-Otsu thresholds from slice histograms, and the classes they give.

A threshold is the top occupied level of its lower class. Between equal scores the smallest thresholds win. Slices with
fewer levels than classes are left out. ``inclusive`` keeps the reference behaviour: a value equal to a threshold goes up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intensity import SLICE, histogram


def prefix_sums(hist: DataFrame) -> DataFrame:
    """(scan_id, z, v, p, s, top, pt, st): mass and moment up to each level, and those of the whole slice."""
    w = Window.partitionBy(*SLICE).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*SLICE)
    mass, moment = F.col("n"), F.col("n") * F.col("v")
    return hist.select(
        *SLICE, "v", F.sum(mass).over(w).alias("p"), F.sum(moment).over(w).alias("s"), F.max("v").over(whole).alias("top"), F.count("*").over(whole).alias("levels"),
        F.sum(mass).over(whole).alias("pt"), F.sum(moment).over(whole).alias("st"),
    )


def _part(moment: Column, mass: Column) -> Column:
    return moment.cast("double") * moment / mass


def thresholds(gray: DataFrame, n_classes: int = 3) -> DataFrame:
    """(scan_id, z, t): an array of n_classes - 1 levels a slice. Two classes are found by window functions; more by
    dynamic programming over a slice's levels, of which there may be tens of thousands."""
    if n_classes < 2:
        raise ValueError("two classes or more")
    if n_classes > 2:
        return _by_programming(histogram(gray), n_classes)
    c = prefix_sums(histogram(gray)).where("v < top")
    f = _part(F.col("s"), F.col("p")) + _part(F.col("st") - F.col("s"), F.col("pt") - F.col("p"))
    best = c.groupBy(*SLICE).agg(F.max(F.struct(F.round(f, 6).alias("f"), (-F.col("v")).alias("t"))).alias("b"))
    return best.select(*SLICE, F.array(-F.col("b.t")).alias("t"))


def best_splits(p: np.ndarray, s: np.ndarray, n_classes: int) -> list[int] | None:
    """Indices of the last level of each class but the top one; p and s are mass and moment up to each level.

    rest[k][i] is the best score of cutting the levels from i on into k classes. The best first cut moves up with i, so
    each table is filled by halves: the middle one first, then each half only between the cuts of its neighbours, all
    middles of a depth together. Between equal scores (of six decimals) the smallest levels win."""
    n = len(p)
    if n < n_classes:
        return None
    mass, moment = np.append(0, p).astype(np.float64), np.append(0, s).astype(np.float64)

    def score(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of one class of the levels i..j-1."""
        own = moment[j] - moment[i]
        return own * own / (mass[j] - mass[i])

    every = np.arange(n)
    rest = [None, score(every, np.full(n, n))]
    for k in range(2, n_classes):
        before, last = rest[-1], n - k  # from beyond `last` on there are too few levels
        table, cut = np.full(n, -np.inf), np.full(n, -1)
        depth = max(1, int(last + 1).bit_length())
        for d in range(depth - 1, -1, -1):
            middle = np.arange((1 << d) - 1, last + 1, 2 << d)
            low = np.where(middle >= 1 << d, cut[np.maximum(middle - (1 << d), 0)], 0)
            above = middle + (1 << d)
            high = np.where(above <= last, cut[np.minimum(above, last)], n - k + 1)
            low, high = np.maximum(low, middle + 1), np.where(high < 0, n - k + 1, high)
            size = high - low + 1
            begin = np.append(0, np.cumsum(size))
            row = np.repeat(np.arange(len(middle)), size)
            j = np.arange(begin[-1]) - begin[row] + low[row]
            value = score(middle[row], j) + before[j]
            top = np.maximum.reduceat(value, begin[:-1])
            hit = np.nonzero(value == top[row])[0]
            first = hit[np.searchsorted(hit, begin[:-1])]
            table[middle], cut[middle] = top, j[first]
        rest.append(table)
    total, start, out = 0.0, 0, []
    cuts = np.arange(1, n - n_classes + 2)
    goal = np.round((score(np.zeros(len(cuts), int), cuts) + rest[n_classes - 1][cuts]).max(), 6)
    for k in range(n_classes - 1, 0, -1):
        j = np.arange(start + 1, n - k + 1)
        own = score(np.full(len(j), start), j)
        whole = total + own + rest[k][j]
        good = np.nonzero(np.round(whole, 6) >= goal)[0]
        pick = int(good[0]) if len(good) else int(whole.argmax())  # the sum's order may cost the last digit
        total, start = total + own[pick], int(j[pick])
        out.append(start - 1)
    return out


def _by_programming(hist: DataFrame, n_classes: int) -> DataFrame:
    kinds = dict(hist.dtypes)

    def run(t: pa.Table) -> pa.Table:
        v, n = t.column("v").to_numpy(), t.column("n").to_numpy()
        order = np.argsort(v)
        v, n = v[order], n[order]
        found = best_splits(np.cumsum(n), np.cumsum(n * v), n_classes)
        rows = [] if found is None else [v[found].tolist()]
        kind = pa.list_(t.schema.field("v").type)
        return pa.table({c: t.column(c)[: len(rows)] for c in SLICE} | {"t": pa.array(rows, kind)})

    present = hist.where("v is not null")
    return present.groupBy(*SLICE).applyInArrow(run, f"scan_id {kinds['scan_id']}, z {kinds['z']}, t array<{kinds['v']}>")


def digitize(value: Column, t: Column, inclusive: bool = True) -> Column:
    """The class of a value: how many thresholds it has reached."""
    return F.aggregate(t, F.lit(0), lambda a, x: a + ((value >= x) if inclusive else (value > x)).cast("int")).cast("long")


def segment(gray: DataFrame, n_classes: int = 3, inclusive: bool = True) -> DataFrame:
    """(scan_id, z, y, x, class, pores0, pores01): classes by the slice's own thresholds, and the two pore masks."""
    joined = gray.join(thresholds(gray, n_classes), SLICE)
    done = joined.select("scan_id", "z", "y", "x", digitize(F.col("v"), F.col("t"), inclusive).alias("class"))
    return class_masks(done)


def class_masks(classes: DataFrame) -> DataFrame:
    mask = lambda m: F.when(m, 255).otherwise(0).cast("long")
    return classes.withColumns({"pores0": mask(F.col("class") == 0), "pores01": mask(F.col("class") <= 1)})


def threshold_stats(t: DataFrame) -> DataFrame:
    """(scan_id, slices, mean_t1, mean_t2): means of the first two thresholds over a scan's slices; no second mean for two classes."""
    return t.groupBy("scan_id").agg(F.count("*").alias("slices"), F.avg(F.get("t", F.lit(0))).alias("mean_t1"), F.avg(F.get("t", F.lit(1))).alias("mean_t2"))


def overlay(value: Column, mask: Column, alpha: float = 0.35) -> Column:
    """Blue, green and red of a grey value, with red blended in where the mask is set."""
    plain = lambda add: F.when(mask > 0, F.rint(value * (1 - alpha) + add)).otherwise(value).cast("long")
    return F.struct(plain(0.0).alias("b"), plain(0.0).alias("g"), plain(255 * alpha).alias("r"))
