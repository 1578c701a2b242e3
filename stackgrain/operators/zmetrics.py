"""Metrics along z on (scan_id, z, y, x, label): windows, transitions, agreement of neighbouring slices, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINE = ["scan_id", "y", "x"]


def _line():
    return Window.partitionBy(*LINE).orderBy("z")


def _flip() -> Column:
    """1 where a voxel's label differs from the one before on its line."""
    before = F.lag("label").over(_line())
    return F.when(before.isNotNull() & (before != F.col("label")), 1).otherwise(0)


def window_metrics(labels: DataFrame, windows: dict[str, int], target: int = 1) -> DataFrame:
    """For each named window of w slices (cut off at the ends of a line): freq of the target, frac0 and frac2 of the
    other classes, flips between neighbours of any class, and win, the slices in the window. All windows share one sort."""
    flagged = labels.withColumn("flip_", _flip())
    columns = []
    for name, w in windows.items():
        h, end = w // 2, f"_{name}" if name else ""
        near = _line().rowsBetween(-h, h)
        share = lambda c, near=near: F.avg((F.col("label") == c).cast("double")).over(near)
        flips = F.sum("flip_").over(_line().rowsBetween(-h + 1, h)) if h else F.lit(0)
        columns += [share(target).alias(f"freq{end}"), share(0).alias(f"frac0{end}"), share(2).alias(f"frac2{end}"),
                    flips.cast("long").alias(f"flip{end}"), F.count("*").over(near).alias(f"win{end}")]
    return flagged.select(*labels.columns, *columns)


def prefix_metrics(labels: DataFrame, window: int, target: int = 1) -> DataFrame:
    """The same frequencies and flips from differences of running sums: another plan, for cross-checks."""
    h = window // 2
    so_far = _line().rowsBetween(Window.unboundedPreceding, 0)
    run = labels.withColumn("flip_", _flip()).select(
        *labels.columns, F.sum((F.col("label") == target).cast("long")).over(so_far).alias("ct"), F.sum("flip_").over(so_far).alias("cf"),
        F.row_number().over(_line()).alias("i"), F.count("*").over(Window.partitionBy(*LINE)).alias("m"),
    )
    # The running sum h ahead (or at the end of the line), less the one h + 1 behind (or nothing).
    ahead = lambda c: F.coalesce(F.lead(c, h).over(_line()), F.max(c).over(Window.partitionBy(*LINE)))
    behind = lambda c, k: F.coalesce(F.lag(c, k).over(_line()), F.lit(0))
    first = F.greatest(F.col("i") - h, F.lit(1))
    win = F.least(F.col("i") + h, F.col("m")) - first + 1
    # A transition belongs to a window if both of its voxels do.
    flips = ahead("cf") - F.coalesce(F.lag("cf", h).over(_line()), F.lit(0))
    return run.select(
        *labels.columns, ((ahead("ct") - behind("ct", h + 1)) / win).alias("freq"), flips.cast("long").alias("flip"), win.cast("long").alias("win")
    )


def label_counts(labels: DataFrame, target: int = 1) -> DataFrame:
    """(scan_id, n, n0, n1, n2, target_fraction, seen)."""
    n = lambda c: F.count_if(F.col("label") == c)
    return labels.groupBy("scan_id").agg(
        F.count("*").alias("n"), *(n(c).alias(f"n{c}") for c in (0, 1, 2)), (n(target) / F.count("*")).alias("target_fraction"),
        F.concat_ws(",", F.sort_array(F.collect_set("label").cast("array<string>"))).alias("seen"),
    )


def diagnostics(metrics: DataFrame, short_limit: float, long_limit: float, target: int = 1) -> DataFrame:
    """Per scan: flips over all voxels, frequencies over the target's, and how many are unstable in one window alone.
    metrics: window_metrics with windows named short and long."""
    on = F.col("label") == target
    s, g = F.when(on, F.col("freq_short")), F.when(on, F.col("freq_long"))
    parts = [F.min("flip_short").alias("flip_min"), F.max("flip_short").alias("flip_max"), F.avg("flip_short").alias("flip_mean"),
             (100.0 * F.count_if(F.col("flip_short") > 0) / F.count("*")).alias("flip_percent")]
    for name, c in (("short", s), ("long", g)):
        q = lambda p, c=c: F.percentile(c, F.lit(p))
        parts += [F.min(c).alias(f"{name}_min"), F.avg(c).alias(f"{name}_mean"), q(0.5).alias(f"{name}_median"), q(0.05).alias(f"{name}_p5"), q(0.95).alias(f"{name}_p95")]
    parts += [F.count_if((s < short_limit) & (g >= long_limit)).alias("short_only"), F.count_if((s >= short_limit) & (g < long_limit)).alias("long_only")]
    return metrics.groupBy("scan_id").agg(*parts)


def adjacent_dice(labels: DataFrame, target: int = 1) -> DataFrame:
    """(scan_id, z, dice) of slices z and z + 1; 1 if both are without the target."""
    a = (F.col("label") == target).cast("long")
    b = F.lead(a).over(_line())
    pair = labels.select("scan_id", "z", a.alias("a"), b.alias("b")).where("b is not null")
    total = F.sum("a") + F.sum("b")
    dice = F.when(total == 0, 1.0).otherwise(2.0 * F.sum(F.col("a") * F.col("b")) / total)
    return pair.groupBy("scan_id", "z").agg(dice.alias("dice"))


def longest_runs(labels: DataFrame, target: int = 1) -> DataFrame:
    """(scan_id, y, x, max_run): the longest run of the target along each line, 0 without any."""
    on = F.col("label") == target
    same = Window.partitionBy(*LINE, "on").orderBy("z")
    marked = labels.select(*LINE, "z", on.alias("on"))
    island = marked.withColumn("island", F.row_number().over(_line()) - F.row_number().over(same))
    runs = island.groupBy(*LINE, "on", "island").agg(F.count("*").alias("n"))
    return runs.groupBy(*LINE).agg(F.max(F.when(F.col("on"), F.col("n")).otherwise(0)).cast("long").alias("max_run"))


def run_stats(runs: DataFrame) -> DataFrame:
    """(scan_id, lines, mean_run, median_run) over lines that have a run; 0 without any."""
    some = F.when(F.col("max_run") > 0, F.col("max_run"))
    return runs.groupBy("scan_id").agg(
        F.count("*").alias("lines"), F.coalesce(F.avg(some), F.lit(0.0)).alias("mean_run"), F.coalesce(F.percentile(some, F.lit(0.5)), F.lit(0.0)).alias("median_run")
    )
