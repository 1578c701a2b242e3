"""Pore size distributions as files: csv, json or parquet by Spark's writers, with their metadata beside them."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("scan_id string, bin long, Diameter_px double, Diameter_um double, Volume_Count long, Cumulative_Porosity double, "
          "Differential_PSD double, is_reliable boolean")  # fmt: skip
FORMATS = ("csv", "json", "parquet")
REQUIRED = ("Diameter_px", "Diameter_um", "Volume_Count", "Cumulative_Porosity", "Differential_PSD", "is_reliable")


def formats(wanted: str | list[str] | None) -> list[str]:
    """The export formats asked for, in lower case; csv without any. hdf5 and excel need libraries that are not here."""
    chosen = [wanted] if isinstance(wanted, str) else list(wanted or ["csv"])
    chosen = [f.lower() for f in chosen]
    for f in chosen:
        if f not in FORMATS:
            raise ValueError(f"unknown format {f}")
    return chosen


def _plain(value):
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return sorted(value) if isinstance(value, (set, frozenset)) else str(value)


def save(psd: DataFrame, path: str, wanted: str | list[str] | None = None, metadata: dict | None = None) -> None:
    """Writes path/<format> for each format, and path/meta with one row of JSON (dates as ISO text)."""
    spark = psd.sparkSession
    for f in formats(wanted):
        out = psd
        if f == "csv":
            six = [F.format_string("%.6f", c).alias(c) if t == "double" else F.col(c) for c, t in psd.dtypes]
            out = psd.select(*six)
        writer = out.write.mode("overwrite")
        writer.option("header", True).csv(f"{path}/csv") if f == "csv" else writer.format(f).save(f"{path}/{f}")
    spark.createDataFrame([(json.dumps(metadata or {}, default=_plain, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load(spark: SparkSession, path: str, file_format: str = "csv") -> tuple[DataFrame, dict]:
    if file_format not in FORMATS:
        raise ValueError(f"unknown format {file_format}")
    reader = spark.read.schema(SCHEMA)
    df = reader.option("header", True).csv(f"{path}/csv") if file_format == "csv" else reader.format(file_format).load(f"{path}/{file_format}")
    return df, json.loads(spark.read.text(f"{path}/meta").first()["value"])


def comparable(psd: DataFrame) -> DataFrame:
    """Reliable rows by diameter, after a check that all columns are there."""
    missing = [c for c in REQUIRED if c not in psd.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return psd.where("is_reliable").orderBy("Diameter_um")
