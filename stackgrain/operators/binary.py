"""Label codes, collapse to pore and solid, border shells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Raw codes of stored masks and the labels they stand for.
RAW_TO_LABEL = {0: 0, 1: 1, 2: 2, 127: 1, 254: 2}
LABEL_TO_RAW = {0: 0, 1: 127, 2: 254}


def _lookup(value: Column, table: dict[int, int]) -> Column:
    flat = [F.lit(x).cast("long") for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*flat), value.cast("long"))
    problem = F.raise_error(F.concat(F.lit("unexpected label "), value.cast("string"))).cast("long")
    return F.coalesce(found, problem)


def normalise_labels(df: DataFrame, column: str = "label") -> DataFrame:
    """Raw codes as labels 0, 1, 2; any other code fails the query."""
    return df.withColumn(column, _lookup(F.col(column), RAW_TO_LABEL))


def encode_labels(df: DataFrame, column: str = "label") -> DataFrame:
    return df.withColumn(column, _lookup(F.col(column), LABEL_TO_RAW))


def distinct_labels(df: DataFrame, column: str = "label") -> DataFrame:
    return df.select("scan_id", column).distinct()


def collapse(labels: DataFrame, strict: bool = False) -> DataFrame:
    """(scan_id, z, y, x, is_pore): label 0 is pore, all others are solid.

    strict: a scan whose labels are not exactly {0, 1} or {0, 1, 2} fails the query."""
    out = labels
    if strict:
        seen = labels.groupBy("scan_id").agg(F.sort_array(F.collect_set(F.col("label").cast("long"))).alias("seen"))
        fine = F.array_join("seen", ",").isin("0,1", "0,1,2")
        out = labels.join(seen, "scan_id").where(F.when(fine, True).otherwise(F.raise_error(F.lit("labels are not {0, 1} or {0, 1, 2}")).cast("boolean")))
    return out.select("scan_id", "z", "y", "x", (F.col("label") == 0).alias("is_pore"))


def pore_report(volume: DataFrame) -> DataFrame:
    """(scan_id, total, pores, solids, pore_percent)."""
    pores = F.count_if("is_pore")
    return volume.groupBy("scan_id").agg(
        F.count("*").alias("total"), pores.alias("pores"), F.count_if(~F.col("is_pore")).alias("solids"), (100.0 * pores / F.count("*")).alias("pore_percent")
    )


def extents(volume: DataFrame) -> DataFrame:
    """(scan_id, z0, z1, y0, y1, x0, x1): the box of each scan, ends included."""
    return volume.groupBy("scan_id").agg(*(f(c).alias(f"{c}{i}") for c in "zyx" for i, f in enumerate((F.min, F.max))))


def inside_border(voxels: DataFrame, width: int = 1, box: DataFrame | None = None) -> DataFrame:
    """The voxels that do not lie in the shell of the given width; width 0 keeps all. box: extents() of the whole
    volume, where voxels are a part of it."""
    if width <= 0:
        return voxels
    joined = voxels.join(extents(voxels) if box is None else box, "scan_id")
    for c in "zyx":
        joined = joined.where((F.col(c) >= F.col(f"{c}0") + width) & (F.col(c) <= F.col(f"{c}1") - width))
    return joined.select(*voxels.columns)
