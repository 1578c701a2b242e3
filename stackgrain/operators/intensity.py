"""Grey-level operators on (scan_id, z, y, x, v), slice by slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .radix import percentiles

SLICE = ["scan_id", "z"]


def ensure_odd(n: int) -> int:
    return n + 1 - n % 2


def histogram(gray: DataFrame, value: str = "v") -> DataFrame:
    """(scan_id, z, v, n): how often each level occurs in a slice."""
    return gray.groupBy(*SLICE, F.col(value).alias("v")).agg(F.count("*").alias("n"))


def slice_stats(gray: DataFrame, quantiles: list[float], value: str = "v", by: str = "histogram") -> DataFrame:
    """(scan_id, z, lo, hi, q): extremes and exact linear percentiles of each slice, from its histogram, or by radix for
    floats, which have about as many levels as pixels."""
    if by == "radix":
        ends = gray.groupBy(*SLICE).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
        return ends.join(percentiles(gray, quantiles, value), SLICE)
    q = F.percentile("v", F.array(*map(F.lit, quantiles)), F.col("n"))
    return histogram(gray, value).groupBy(*SLICE).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), q.alias("q"))


def normalise_dtype(gray: DataFrame, dtype: str, value: str = "v") -> DataFrame:
    """Values as fractions: 16-bit by 65535, 8-bit by 255, floats as they are; outside 0..1 the query fails."""
    scale = {"uint16": 65535.0, "uint8": 255.0, "float": 1.0, "float32": 1.0, "float64": 1.0}
    if dtype not in scale:
        raise TypeError(f"unsupported dtype {dtype}")
    f = F.col(value).cast("double") / scale[dtype]
    ok = (f >= 0) & (f <= 1)
    return gray.withColumn(value, F.when(ok, f).otherwise(F.raise_error(F.lit("value outside 0..1")).cast("double")))


def stretch(value: Column, lo: Column, hi: Column) -> Column:
    """Levels lo..hi stretched to 0..255, clipped and truncated; all 0 if the range is empty."""
    u = F.floor(F.least(F.greatest((value - lo) * 255 / (hi - lo), F.lit(0.0)), F.lit(255.0)))
    return F.when(hi <= lo, 0).otherwise(u).cast("long")


def to_uint8(gray: DataFrame, method: str = "percentile", p_low: float = 0.5, p_high: float = 99.5, value: str = "v", by: str = "histogram") -> DataFrame:
    """8-bit levels by the slice's percentiles (found by `by`, see slice_stats), its extremes, or a division by 256.

    Percentiles are rounded to nine decimals, so that truncation does not hang on how they were interpolated."""
    if method == "divide256":
        return gray.withColumn(value, F.floor(F.least(F.col(value) / 256, F.lit(255.0))).cast("long"))
    if method not in ("percentile", "minmax"):
        raise ValueError(f"unknown method {method}")
    stats = slice_stats(gray, [p_low / 100, p_high / 100], value, by if method == "percentile" else "histogram")
    lo, hi = (F.round(F.col("q")[0], 9), F.round(F.col("q")[1], 9)) if method == "percentile" else (F.col("lo").cast("double"), F.col("hi").cast("double"))
    joined = gray.join(stats, SLICE)
    return joined.withColumn(value, stretch(F.col(value).cast("double"), lo, hi)).select(*gray.columns)


def as_grey(gray: DataFrame, dtype: str, value: str = "v") -> DataFrame:
    """Whole levels 0..255 of slices of any kind: 16-bit ones divided by 256, fractions scaled."""
    if dtype == "uint8":
        return gray
    if dtype == "uint16":
        return to_uint8(gray, "divide256", value=value)
    f = F.least(F.greatest(F.col(value).cast("double"), F.lit(0.0)), F.lit(1.0))
    return gray.withColumn(value, F.rint(f * 255).cast("long"))


def shades(maps: DataFrame, value: str, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """With a column shade: the value as a level 0..255 between lo and hi, where left out the scan's least and greatest
    value; 0 where they are equal. NaN and null give a null shade and count for no limit."""
    v = F.nullif(F.col(value).cast("double"), F.lit(float("nan")))
    ends = maps.groupBy("scan_id").agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    low, high = (F.col(c) if x is None else F.lit(float(x)) for c, x in (("_lo", lo), ("_hi", hi)))
    part = F.when(high > low, (v - low) / F.nullif(high - low, F.lit(0.0))).otherwise(F.when(v.isNotNull(), 0.0))
    shade = F.when(part.isNotNull(), F.floor(F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0)) * 255))
    return maps.join(ends, "scan_id", "left").withColumn("shade", shade).drop("_lo", "_hi")


def finite(gray: DataFrame, lo: float, hi: float, value: str = "v") -> DataFrame:
    """Null and NaN become 0, then values are clipped to lo..hi."""
    v = F.coalesce(F.nanvl(F.col(value).cast("double"), F.lit(0.0)), F.lit(0.0))
    return gray.withColumn(value, F.least(F.greatest(v, F.lit(float(lo))), F.lit(float(hi))))


def mode_in_band(gray: DataFrame, low: int = 100, high: int = 254, value: str = "v") -> DataFrame:
    """(scan_id, z, mode): the most frequent level of low..high, the lowest of ties, 0 without any."""
    inside = F.when(F.col("v").between(low, high), F.struct("n", (-F.col("v")).alias("v")))
    best = histogram(gray, value).groupBy(*SLICE).agg(F.max(inside).alias("best"))
    return best.select(*SLICE, F.coalesce(-F.col("best.v"), F.lit(0)).cast("long").alias("mode"))


def scale_to_mode(value: Column, mode: Column, target: int = 200) -> Column:
    """Levels scaled so that the mode becomes the target."""
    scaled = F.floor(F.least(F.greatest(value * float(target) / mode, F.lit(0.0)), F.lit(255.0))).cast("long")
    return F.when(mode > 0, scaled).otherwise(value.cast("long"))


def norm200(gray: DataFrame, dtype: str = "uint8") -> DataFrame:
    """The whole chain: fractions, percentile stretch, mode of the upper band moved to 200. Adds u and f = u / 255."""
    s = normalise_dtype(gray, dtype).withColumn("v", F.least(F.greatest(F.col("v") * 255, F.lit(0.0)), F.lit(255.0)))
    u = to_uint8(s, by="radix" if dtype.startswith("float") else "histogram")
    out = u.join(mode_in_band(u), SLICE).withColumn("u", scale_to_mode(F.col("v"), F.col("mode")))
    return out.select("scan_id", "z", "y", "x", "u", (F.col("u") / 255.0).alias("f"))
