"""Relabelling of unstable voxels. Input: labels with window metrics named short and long, and component sizes."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    min_short_frequency: float
    max_flip_rate: int
    min_long_frequency: float
    min_component_size: int

    def check(self, short: int, long: int) -> None:
        """A window of w slices has at most 2 * (w // 2) transitions: warn of limits that can never be passed."""
        if self.max_flip_rate >= 2 * (short // 2):
            warnings.warn(f"max_flip_rate {self.max_flip_rate} cannot be exceeded in a window of {short} slices", stacklevel=2)


CONSERVATIVE = Thresholds(0.6, 2, 0.3, 10)
AGGRESSIVE = Thresholds(0.4, 3, 0.2, 5)


def criteria(t: Thresholds) -> dict[str, Column]:
    return {
        "low_short": F.col("freq_short") < t.min_short_frequency,
        "high_flip": F.col("flip_short") > t.max_flip_rate,
        "low_long": F.col("freq_long") < t.min_long_frequency,
        "small": F.col("comp_size") < t.min_component_size,
    }


def correct(metrics: DataFrame, t: Thresholds, every: bool, target: int = 1) -> DataFrame:
    """Adds noise, corrected and confidence. every: all criteria have to hold (conservative), else one (aggressive).

    Noise takes class 0 where the short window has more of it than of class 2, else class 2. Confidence is 0 outside
    noise and for the aggressive rule; with max_flip_rate 0 any flip counts in full."""
    found = [*criteria(t).values()]
    rule = found[0]
    for c in found[1:]:
        rule = (rule & c) if every else (rule | c)
    noise = F.coalesce((F.col("label") == target) & rule, F.lit(False))
    relabel = F.when(F.col("frac0_short") > F.col("frac2_short"), 0).otherwise(2)
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    flip = (
        clip((F.col("flip_short") - t.max_flip_rate) / float(t.max_flip_rate)) if t.max_flip_rate
        else F.when(F.col("flip_short") > 0, 1.0).otherwise(0.0)
    )
    sure = (clip(1 - F.col("freq_short") / t.min_short_frequency) + flip) / 2 if every else F.lit(0.0)
    return metrics.withColumns(
        {
            "noise": noise,
            "corrected": F.when(noise, relabel).otherwise(F.col("label")).cast("long"),
            "confidence": F.when(noise, sure).otherwise(F.lit(0.0)),
        }
    )


def report(corrected: DataFrame, t: Thresholds, target: int = 1) -> DataFrame:
    """Per scan: target voxels, those that meet each criterion, noise, and what noise became."""
    on = F.col("label") == target
    became = lambda c: F.count_if(F.col("noise") & (F.col("corrected") == c))
    return corrected.groupBy("scan_id").agg(
        F.count_if(on).alias("n_target"), *(F.count_if(on & c).alias(k) for k, c in criteria(t).items()),
        F.count_if("noise").alias("n_noise"), became(0).alias("to_pore"), became(2).alias("to_solid"),
    )


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per scan: how many voxels of two masks (label) differ, in per cent too, and the sums of their labels."""
    key = ["scan_id", "z", "y", "x"]
    both = a.select(*key, F.col("label").alias("la")).join(b.select(*key, F.col("label").alias("lb")), key)
    n = F.count_if(F.col("la") != F.col("lb"))
    return both.groupBy("scan_id").agg(
        n.alias("n_diff"), (100.0 * n / F.count("*")).alias("percent"), F.sum("la").alias("sum_a"), F.sum("lb").alias("sum_b")
    )
