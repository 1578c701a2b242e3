"""Voxel relations derived from the driver's tables, one row a voxel: (scan_id, z, y, x, ...), all bigint.

Work on them grows with the tables: the number of scans follows the number of rows, the size of a slice is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SIDE = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long(column, name: str):
    return F.expr(column).cast("long").alias(name) if isinstance(column, str) else column.cast("long").alias(name)


def gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scan_id, z, y, x, v): each embedding is a slice of 8 x 8 grey levels, fifty of them a scan."""
    cell = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "e"))
    level = F.floor(F.least(F.greatest((F.col("e").cast("double") + 0.6) / 1.2, F.lit(0.0)), F.lit(1.0)) * 255)
    return cell.select(
        long("vec_id div 50", "scan_id"), long("vec_id % 50", "z"), long("i div 8", "y"), long("i % 8", "x"),
        level.cast("long").alias("v"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scan_id, z, y, x, v): the slices of gray() with their values as they are, 32-bit floats."""
    cell = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "e"))
    return cell.select(long("vec_id div 50", "scan_id"), long("vec_id % 50", "z"), long("i div 8", "y"), long("i % 8", "x"), F.col("e").cast("float").alias("v"))


def cut(v: Column, low: int = 108, high: int = 142) -> Column:
    """The label of a grey level: below, between or above two fixed levels."""
    return F.when(v < low, 0).when(v < high, 1).otherwise(2).cast("long")


def labels(spark: SparkSession, sf_dir: str, low: int = 108, high: int = 142) -> DataFrame:
    """(scan_id, z, y, x, label): the grey slices cut at two fixed levels."""
    return gray(spark, sf_dir).select("scan_id", "z", "y", "x", cut(F.col("v"), low, high).alias("label"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scan_id, z, y, x, label): each user's events in order of time, one line of voxels a user."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    label = F.when(F.col("event_type").isin("view", "click"), 0).when(F.col("event_type") == "signup", 1).otherwise(2)
    return table(spark, sf_dir, "events").select(
        long("user_id", "scan_id"), (F.row_number().over(order) - 1).cast("long").alias("z"), F.lit(0).cast("long").alias("y"),
        F.lit(0).cast("long").alias("x"), label.cast("long").alias("label"),
    )


def volume_from_counts(rows: DataFrame, scan: str, z: str, y: str, x: str, side: int, times: int = 1) -> DataFrame:
    """(scan_id, z, y, x, is_pore) on a full grid a scan: a cell is solid if it holds more rows than the average cell."""
    cells = rows.select(long(scan, "scan_id"), long(z, "z"), long(y, "y"), long(x, "x"))
    filled = cells.groupBy("scan_id", "z", "y", "x").agg(F.count("*").alias("n"))
    axis = F.sequence(F.lit(0), F.lit(side - 1))
    grid = (
        filled.groupBy("scan_id").agg(F.sum("n").alias("total"))
        .select("scan_id", "total", F.explode(axis).alias("z")).select("*", F.explode(axis).alias("y")).select("*", F.explode(axis).alias("x"))
        .select("scan_id", "total", long("z", "z"), long("y", "y"), long("x", "x"))
    )
    n = F.coalesce("n", F.lit(0))
    whole = grid.join(filled, ["scan_id", "z", "y", "x"], "left")
    return whole.select("scan_id", "z", "y", "x", (n * side**3 <= F.col("total") * times).alias("is_pore"))


def volumes(spark: SparkSession, sf_dir: str, times: int = 1) -> DataFrame:
    """Binary volumes of 16 voxels a side, one for each 2000 order keys; solid are cells with more than so many times
    the rows of the average cell."""
    side = SIDE
    return volume_from_counts(
        table(spark, sf_dir, "lineitem"), "l_orderkey div 2000", f"l_orderkey % {side}", f"l_suppkey % {side}", f"l_partkey % {side}", side, times
    )


# The same in DuckDB's SQL, as common table expressions.
GRAY_SQL = """gray AS (SELECT vec_id // 50 AS scan_id, vec_id % 50 AS z, (i - 1) // 8 AS y, (i - 1) % 8 AS x,
 CAST(floor(least(greatest((CAST(embedding[i] AS DOUBLE) + 0.6) / 1.2, 0.0), 1.0) * 255) AS BIGINT) AS v
 FROM embeddings, range(1, 65) t(i))"""
LAB_SQL = GRAY_SQL + """, lab AS (SELECT scan_id, z, y, x,
 CAST(CASE WHEN v < 108 THEN 0 WHEN v < 142 THEN 1 ELSE 2 END AS BIGINT) AS label FROM gray)"""
LINE_SQL = """lab AS (SELECT user_id AS scan_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS z,
 0::BIGINT AS y, 0::BIGINT AS x, CAST(CASE WHEN event_type IN ('view', 'click') THEN 0 WHEN event_type = 'signup' THEN 1 ELSE 2 END AS BIGINT) AS label
 FROM events)"""
VOL_SQL = """filled AS (SELECT l_orderkey // 2000 AS scan_id, l_orderkey % 16 AS z, l_suppkey % 16 AS y, l_partkey % 16 AS x, count(*) AS n
 FROM lineitem GROUP BY ALL), sums AS (SELECT scan_id, sum(n) AS total FROM filled GROUP BY scan_id),
 vol AS (SELECT s.scan_id, a.i AS z, b.i AS y, c.i AS x, coalesce(f.n, 0) * 4096 <= s.total AS is_pore
 FROM sums s, range(0, 16) a(i), range(0, 16) b(i), range(0, 16) c(i)
 LEFT JOIN filled f ON f.scan_id = s.scan_id AND f.z = a.i AND f.y = b.i AND f.x = c.i)"""


def wide(sql: str, times: int) -> str:
    """SQL over the volumes as SQL over those of volumes(..., times)."""
    return sql.replace("<= s.total AS is_pore", f"<= s.total * {times} AS is_pore")
