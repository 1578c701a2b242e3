"""Pore size distributions from diameters (scan_id, z, y, x, diameter).

Diameters are whole numbers, so they are counted first; bins are laid over that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .binary import extents, inside_border
from .edt import edt
from .opening import opening

BINS = 50


def diameter_histogram(diameters: DataFrame) -> DataFrame:
    """(scan_id, diameter, n) over voxels with a diameter."""
    return diameters.where("diameter > 0").groupBy("scan_id", "diameter").agg(F.count("*").alias("n"))


def _log_edges(lowest: Column, highest: Column, bins: int) -> Column:
    """bins + 1 edges from the lowest diameter to 1.1 times the highest, evenly spaced logarithms."""
    lo, hi = F.log10(F.greatest(lowest.cast("double"), F.lit(0.1))), F.log10(1.1 * highest)
    inner = lambda i: F.pow(F.lit(10.0), lo + i * (hi - lo) / float(bins))
    return F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: F.when(i == 0, F.greatest(lowest.cast("double"), F.lit(0.1))).otherwise(inner(i)))


def distribution(
    hist: DataFrame, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0), edges_um: list[float] | None = None, min_reliable: float = 5, bins: int = BINS
) -> DataFrame:
    """The table of a distribution: a row for each scan and bin, no row for a scan without pores.

    Bins are half open, the last one closed; diameters outside custom edges are not counted but stay in the total."""
    mean = sum(spacing) / len(spacing)
    per_scan = hist.groupBy("scan_id").agg(F.sum("n").alias("total"), F.min("diameter").alias("d0"), F.max("diameter").alias("d1"))
    if edges_um is None:
        edges = _log_edges(F.col("d0"), F.col("d1"), bins)
    else:
        bins, edges = len(edges_um) - 1, F.array(*(F.lit(float(e) / mean) for e in edges_um))
    per_scan = per_scan.select("scan_id", "total", edges.alias("edges"))
    reached = F.size(F.filter("edges", lambda e: e <= F.col("diameter")))
    number = F.when((reached == bins + 1) & (F.col("diameter") == F.element_at("edges", -1)), bins - 1).otherwise(reached - 1)
    counted = hist.join(per_scan, "scan_id").select("scan_id", number.alias("bin"), "n").groupBy("scan_id", "bin").agg(F.sum("n").alias("n"))
    grid = per_scan.select("scan_id", "total", F.posexplode(F.slice("edges", 1, bins)).alias("bin", "e0"), "edges").select(
        "scan_id", "total", "bin", "e0", F.get("edges", F.col("bin") + 1).alias("e1")
    )
    all_bins = grid.join(counted, ["scan_id", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    so_far = Window.partitionBy("scan_id").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    centre = (F.col("e0") + F.col("e1")) / 2
    return all_bins.select(
        "scan_id", F.col("bin").cast("long").alias("bin"), centre.alias("Diameter_px"), (centre * mean).alias("Diameter_um"), F.col("n").cast("long").alias("Volume_Count"),
        (F.sum("n").over(so_far) / F.col("total")).alias("Cumulative_Porosity"),
        (F.col("n") / (F.col("total") * (F.col("e1") - F.col("e0")) * mean)).alias("Differential_PSD"), (centre >= min_reliable).alias("is_reliable"),
    )


def compute_psd(volume: DataFrame, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0), edges_um: list[float] | None = None, border_width: int = 1, min_reliable: float = 5) -> DataFrame:
    """Distances, openings and bins of a volume (scan_id, z, y, x, is_pore).

    The border shell is left out of the counts only, after distances and openings. Distances are in voxels whatever the
    spacing, which scales the bins by its mean."""
    return distribution(analysed_histogram(volume, border_width), spacing, edges_um, min_reliable)


def analysed_histogram(volume: DataFrame, border_width: int = 1) -> DataFrame:
    thick = opening(edt(volume))
    return diameter_histogram(inside_border(thick, border_width, extents(volume)))


def metadata(hist: DataFrame, spacing: tuple[float, float, float], min_reliable: float) -> DataFrame:
    """(scan_id, total_pore_voxels, voxel_spacing_um, min_reliable_diameter_voxels)."""
    return hist.groupBy("scan_id").agg(F.sum("n").alias("total_pore_voxels")).select(
        "*", F.array(*map(F.lit, spacing)).alias("voxel_spacing_um"), F.lit(min_reliable).alias("min_reliable_diameter_voxels")
    )


def peaks(psd: DataFrame, height: float = 0) -> DataFrame:
    """Bins with more voxels than both neighbours, of at least the given height. Of neighbouring bins with equal counts
    the middle one stands for all (the lower of two); the first and the last bin of a scan are no peaks."""
    w = Window.partitionBy("scan_id").orderBy("bin")
    n = F.col("Volume_Count")
    runs = psd.withColumn("before_", F.lag(n).over(w)).withColumn("after_", F.lead(n).over(w))
    runs = runs.withColumn("run_", F.sum(F.when(n == F.col("before_"), 0).otherwise(1)).over(w))
    own = Window.partitionBy("scan_id", "run_")
    up, down = F.max((n > F.col("before_")).cast("int")).over(own), F.max((n > F.col("after_")).cast("int")).over(own)
    middle = F.floor((F.min("bin").over(own) + F.max("bin").over(own)) / 2)
    marked = runs.withColumn("peak_", (up == 1) & (down == 1) & (F.col("bin") == middle) & (n >= height))
    return marked.where("peak_").select(*psd.columns)


def spread(psd: DataFrame) -> DataFrame:
    """(scan_id, peak_px, std_px): the centre of the fullest bin (the first of ties) and the spread of filled centres."""
    best = F.max(F.struct("Volume_Count", (-F.col("bin")).alias("b"), "Diameter_px"))
    return psd.groupBy("scan_id").agg(best["Diameter_px"].alias("peak_px"), F.stddev_samp(F.when(F.col("Volume_Count") > 0, F.col("Diameter_px"))).alias("std_px"))

