"""Registered queries over the volume relations, each with its SQL for a check by another engine.

All integers are bigint, doubles are rounded to six decimals on both sides.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackgrain.operators import binary, components, correct, edt, filters, intensity, opening, otsu, psd, radix, roi, weak, zmetrics
from stackgrain.sources import derive, stack, volume
from stackgrain.sources.derive import GRAY_SQL, LAB_SQL, LINE_SQL, VOL_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with its SQL if there is any."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = " ".join(sql.split("\n"))
        return f

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded, smaller integers as bigint."""
    fix = {"double": lambda c: F.round(c, 6), "int": lambda c: F.col(c).cast("long"), "smallint": lambda c: F.col(c).cast("long")}
    return df.select(*(fix[t](c).alias(c) if t in fix else F.col(c) for c, t in df.dtypes))


# --- volumes in one file ---


def shared_folder(spark: SparkSession) -> str:
    """A new folder for files that tasks write and read: below spark.checkpoint.dir, for a local session without one below its warehouse."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = spark.conf.get("spark.sql.warehouse.dir")
    if "://" in place and not place.startswith("file://"):
        raise ValueError("volumes are written into mounted folders only")
    return f"/{re.sub('^file:/*', '', place).strip('/')}/volumes-{uuid.uuid4().hex}"


def _reread(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    """The grey slices 10..39 of each scan, written as one file a scan and read back by ranges."""
    folder = shared_folder(spark)
    volume.write_volumes(volume.planes(derive.gray(spark, sf_dir), "v"), folder, file_format)
    slices = volume.read_volumes(spark, folder, 10, 39, bytes_per_task=1 << 20, per_file=True)
    return stack.voxels(slices).select(F.col("scan_id").cast("long").alias("scan_id"), *"zyx", F.col("v").cast("long").alias("v"))


@query(f"WITH {GRAY_SQL} SELECT scan_id, z, v, count(*) AS n FROM gray WHERE z BETWEEN 10 AND 39 GROUP BY scan_id, z, v")
def volume_npy_hist(spark, sf_dir):
    return intensity.histogram(_reread(spark, sf_dir, "npy"))


@query(f"WITH {GRAY_SQL} SELECT scan_id, z, y, x, v FROM gray WHERE z BETWEEN 10 AND 39")
def volume_tiff_voxels(spark, sf_dir):
    return _reread(spark, sf_dir, "tif")


# --- intensity ---


@query(f"WITH {GRAY_SQL} SELECT scan_id, z, v, count(*) AS n FROM gray GROUP BY scan_id, z, v")
def gray_hist(spark, sf_dir):
    return intensity.histogram(derive.gray(spark, sf_dir))


@query(f"""WITH {GRAY_SQL} SELECT scan_id, z, min(v) AS lo, max(v) AS hi, round(quantile_cont(v, 0.005), 6) AS p_low,
 round(quantile_cont(v, 0.995), 6) AS p_high FROM gray GROUP BY scan_id, z""")
def slice_minmax_percentile(spark, sf_dir):
    s = intensity.slice_stats(derive.gray(spark, sf_dir), [0.005, 0.995])
    return rounded(s.select("scan_id", "z", "lo", "hi", F.col("q")[0].alias("p_low"), F.col("q")[1].alias("p_high")))


@query("""SELECT vec_id // 50 AS scan_id, vec_id % 50 AS z, round(quantile_cont(CAST(embedding[i] AS DOUBLE), 0.005), 6) AS p_low,
 round(quantile_cont(CAST(embedding[i] AS DOUBLE), 0.5), 6) AS p_mid, round(quantile_cont(CAST(embedding[i] AS DOUBLE), 0.995), 6) AS p_high
 FROM embeddings, range(1, 65) t(i) GROUP BY ALL""")
def float_percentiles(spark, sf_dir):
    q = radix.percentiles(derive.raw(spark, sf_dir), [0.005, 0.5, 0.995])
    return rounded(q.select("scan_id", "z", *(F.col("q")[i].alias(c) for i, c in enumerate(("p_low", "p_mid", "p_high")))))


MODE_SQL = """counts AS (SELECT scan_id, z, v, count(*) AS n FROM {t} WHERE v BETWEEN 100 AND 254 GROUP BY scan_id, z, v),
 best AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY scan_id, z ORDER BY n DESC, v) = 1),
 modes AS (SELECT s.scan_id, s.z, coalesce(b.v, 0) AS mode FROM (SELECT DISTINCT scan_id, z FROM {t}) s LEFT JOIN best b USING (scan_id, z))"""


@query(f"WITH {GRAY_SQL}, {MODE_SQL.format(t='gray')} SELECT scan_id, z, mode FROM modes")
def mode_band(spark, sf_dir):
    return intensity.mode_in_band(derive.gray(spark, sf_dir))


@query(f"""WITH {GRAY_SQL}, s AS (SELECT scan_id, z, y, x, least(greatest(CAST(v AS DOUBLE) / 255.0 * 255, 0.0), 255.0) AS f FROM gray),
 q AS (SELECT scan_id, z, round(quantile_cont(f, 0.005), 9) AS lo, round(quantile_cont(f, 0.995), 9) AS hi FROM s GROUP BY scan_id, z),
 u AS (SELECT s.scan_id, s.z, y, x, CAST(CASE WHEN hi <= lo THEN 0 ELSE floor(least(greatest((f - lo) * 255 / (hi - lo), 0.0), 255.0)) END AS BIGINT) AS v
 FROM s JOIN q USING (scan_id, z)), {MODE_SQL.format(t='u')},
 t AS (SELECT u.scan_id, u.z, y, x, CAST(CASE WHEN mode > 0 THEN floor(least(greatest(v * 200.0::DOUBLE / mode, 0.0), 255.0)) ELSE v END AS BIGINT) AS u
 FROM u JOIN modes USING (scan_id, z))
 SELECT scan_id, z, y, x, u, round(u / 255.0::DOUBLE, 6) AS f FROM t""")
def norm200(spark, sf_dir):
    return rounded(intensity.norm200(derive.gray(spark, sf_dir)))


@query(f"""WITH {GRAY_SQL}, q AS (SELECT scan_id, z, CAST(min(v) AS DOUBLE) AS lo, CAST(max(v) AS DOUBLE) AS hi FROM gray GROUP BY scan_id, z)
 SELECT scan_id, z, y, x, CAST(CASE WHEN hi <= lo THEN 0 ELSE floor(least(greatest((CAST(v AS DOUBLE) - lo) * 255 / (hi - lo), 0.0), 255.0)) END AS BIGINT) AS v
 FROM gray JOIN q USING (scan_id, z)""")
def uint8_minmax(spark, sf_dir):
    return intensity.to_uint8(derive.gray(spark, sf_dir), "minmax")


# --- thresholds and classes ---

PREFIX_SQL = """hist AS (SELECT scan_id, z, v, count(*) AS n FROM gray GROUP BY scan_id, z, v),
 pre AS (SELECT scan_id, z, v, CAST(sum(n) OVER w AS DOUBLE) AS p, CAST(sum(n * v) OVER w AS DOUBLE) AS s, max(v) OVER a AS top,
 CAST(sum(n) OVER a AS DOUBLE) AS pt, CAST(sum(n * v) OVER a AS DOUBLE) AS st FROM hist
 WINDOW w AS (PARTITION BY scan_id, z ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY scan_id, z)),
 cand AS (SELECT * FROM pre WHERE v < top)"""
OTSU2_SQL = f"""{GRAY_SQL}, {PREFIX_SQL}, two AS (SELECT scan_id, z, v AS t1 FROM cand
 QUALIFY row_number() OVER (PARTITION BY scan_id, z ORDER BY round(s * s / p + (st - s) * (st - s) / (pt - p), 6) DESC, v) = 1)"""
OTSU3_SQL = f"""{GRAY_SQL}, {PREFIX_SQL}, three AS (SELECT a.scan_id, a.z, a.v AS t1, b.v AS t2 FROM cand a JOIN cand b
 ON a.scan_id = b.scan_id AND a.z = b.z AND a.v < b.v QUALIFY row_number() OVER (PARTITION BY a.scan_id, a.z ORDER BY
 round(a.s * a.s / a.p + (b.s - a.s) * (b.s - a.s) / (b.p - a.p) + (b.st - b.s) * (b.st - b.s) / (b.pt - b.p), 6) DESC, a.v, b.v) = 1)"""


@query(f"WITH {OTSU2_SQL} SELECT scan_id, z, t1 FROM two")
def otsu2(spark, sf_dir):
    return otsu.thresholds(derive.gray(spark, sf_dir), 2).select("scan_id", "z", F.col("t")[0].alias("t1"))


@query(f"WITH {OTSU3_SQL} SELECT scan_id, z, t1, t2 FROM three")
def otsu3(spark, sf_dir):
    return otsu.thresholds(derive.gray(spark, sf_dir), 3).select("scan_id", "z", F.col("t")[0].alias("t1"), F.col("t")[1].alias("t2"))


@query(f"""WITH {GRAY_SQL}, {PREFIX_SQL}, pair AS (SELECT a.scan_id, a.z, a.v AS t1, b.v AS t2, b.p AS p, b.s AS s, a.s * a.s / a.p AS f1,
 (b.s - a.s) * (b.s - a.s) / (b.p - a.p) AS f2 FROM cand a JOIN cand b ON a.scan_id = b.scan_id AND a.z = b.z AND a.v < b.v)
 SELECT a.scan_id, a.z, a.t1, a.t2, c.v AS t3 FROM pair a JOIN cand c ON a.scan_id = c.scan_id AND a.z = c.z AND a.t2 < c.v QUALIFY row_number() OVER (PARTITION BY a.scan_id, a.z
 ORDER BY round(f1 + f2 + (c.s - a.s) * (c.s - a.s) / (c.p - a.p) + (c.st - c.s) * (c.st - c.s) / (c.pt - c.p), 6) DESC, a.t1, a.t2, c.v) = 1""")
def otsu4(spark, sf_dir):
    t = otsu.thresholds(derive.gray(spark, sf_dir), 4)
    return t.select("scan_id", "z", *(F.col("t")[i].alias(f"t{i + 1}") for i in range(3)))


@query(f"WITH {OTSU3_SQL} SELECT scan_id, count(*) AS slices, round(avg(t1), 6) AS mean_t1, round(avg(t2), 6) AS mean_t2 FROM three GROUP BY scan_id")
def otsu_stats(spark, sf_dir):
    return rounded(otsu.threshold_stats(otsu.thresholds(derive.gray(spark, sf_dir), 3)))


@query(f"""WITH {OTSU3_SQL}, c AS (SELECT g.scan_id, g.z, y, x, CAST(v >= t1 AS BIGINT) + CAST(v >= t2 AS BIGINT) AS class
 FROM gray g JOIN three USING (scan_id, z)) SELECT scan_id, z, y, x, class, CASE WHEN class = 0 THEN 255 ELSE 0 END::BIGINT AS pores0,
 CASE WHEN class <= 1 THEN 255 ELSE 0 END::BIGINT AS pores01 FROM c""")
def class_masks(spark, sf_dir):
    return otsu.segment(derive.gray(spark, sf_dir), 3)


@query(f"WITH {GRAY_SQL} SELECT scan_id, z, y, x, CAST(v >= 100 AS BIGINT) + CAST(v >= 150 AS BIGINT) AS class FROM gray")
def digitize_fixed(spark, sf_dir):
    t = F.array(F.lit(100), F.lit(150))
    return derive.gray(spark, sf_dir).select("scan_id", "z", "y", "x", otsu.digitize(F.col("v"), t).alias("class"))


_RED = "CAST(CASE WHEN v < 108 THEN round_even(v * (1 - 0.35::DOUBLE) + {add}, 0) ELSE v END AS BIGINT)"


@query(f"""WITH {GRAY_SQL} SELECT scan_id, z, y, x, {_RED.format(add=0)} AS b, {_RED.format(add=0)} AS g,
 {_RED.format(add='255 * 0.35::DOUBLE')} AS r FROM gray""")
def overlay(spark, sf_dir):
    g = derive.gray(spark, sf_dir)
    o = g.select("scan_id", "z", "y", "x", otsu.overlay(F.col("v"), (F.col("v") < 108).cast("int")).alias("o"))
    return o.select("scan_id", "z", "y", "x", "o.b", "o.g", "o.r")


# --- labels ---


@query(f"""WITH {LAB_SQL} SELECT scan_id, count(*) AS n, count_if(label = 0)::BIGINT AS n0, count_if(label = 1)::BIGINT AS n1, count_if(label = 2)::BIGINT AS n2,
 round(count_if(label = 1) / count(*)::DOUBLE, 6) AS target_fraction, string_agg(DISTINCT label::VARCHAR, ',' ORDER BY label::VARCHAR) AS seen
 FROM lab GROUP BY scan_id""")
def label_counts(spark, sf_dir):
    return rounded(zmetrics.label_counts(derive.labels(spark, sf_dir)))


@query(f"""WITH {LAB_SQL} SELECT scan_id, z, y, x, CASE label WHEN 0 THEN 0 WHEN 1 THEN 127 ELSE 254 END::BIGINT AS raw, label FROM lab""")
def label_normalize(spark, sf_dir):
    raw = binary.encode_labels(derive.labels(spark, sf_dir)).withColumn("raw", F.col("label"))
    return binary.normalise_labels(raw).select("scan_id", "z", "y", "x", "raw", "label")


@query(f"WITH {LAB_SQL} SELECT scan_id, z, y, x, label = 0 AS is_pore FROM lab")
def binary_collapse(spark, sf_dir):
    return binary.collapse(derive.labels(spark, sf_dir))


@query(f"""WITH {VOL_SQL} SELECT scan_id, count(*) AS total, count_if(is_pore)::BIGINT AS pores, count_if(NOT is_pore)::BIGINT AS solids,
 round(100.0 * count_if(is_pore) / count(*)::DOUBLE, 6) AS pore_percent FROM vol GROUP BY scan_id""")
def pore_report(spark, sf_dir):
    return rounded(binary.pore_report(derive.volumes(spark, sf_dir)))


@query(f"WITH {VOL_SQL} SELECT scan_id, z, y, x, is_pore FROM vol WHERE z BETWEEN 1 AND 14 AND y BETWEEN 1 AND 14 AND x BETWEEN 1 AND 14")
def border_mask(spark, sf_dir):
    return binary.inside_border(derive.volumes(spark, sf_dir), 1)


# --- along z ---


def _window_sql(w: int, source: str = LINE_SQL) -> str:
    h = w // 2
    return f"""WITH {source}, f AS (SELECT *, CASE WHEN lag(label) OVER l IS NOT NULL AND lag(label) OVER l <> label THEN 1 ELSE 0 END AS t FROM lab
 WINDOW l AS (PARTITION BY scan_id, y, x ORDER BY z))
 SELECT scan_id, z, y, x, label, round(avg(CAST(label = 1 AS DOUBLE)) OVER n, 6) AS freq, round(avg(CAST(label = 0 AS DOUBLE)) OVER n, 6) AS frac0,
 round(avg(CAST(label = 2 AS DOUBLE)) OVER n, 6) AS frac2, CAST(coalesce(sum(t) OVER s, 0) AS BIGINT) AS flip, count(*) OVER n AS win FROM f
 WINDOW n AS (PARTITION BY scan_id, y, x ORDER BY z ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING),
 s AS (PARTITION BY scan_id, y, x ORDER BY z ROWS BETWEEN {h - 1} PRECEDING AND {h} FOLLOWING)"""


@query(_window_sql(3))
def z_window_short(spark, sf_dir):
    return rounded(zmetrics.window_metrics(derive.lines(spark, sf_dir), {"": 3}))


@query(_window_sql(7))
def z_window_long(spark, sf_dir):
    return rounded(zmetrics.window_metrics(derive.lines(spark, sf_dir), {"": 7}))


@query(_window_sql(7).replace("round(avg(CAST(label = 0 AS DOUBLE)) OVER n, 6) AS frac0,", "").replace("round(avg(CAST(label = 2 AS DOUBLE)) OVER n, 6) AS frac2,", ""))
def z_prefix_sum_equiv(spark, sf_dir):
    return rounded(zmetrics.prefix_metrics(derive.lines(spark, sf_dir), 7))


BOTH_SQL = LAB_SQL + """, f AS (SELECT *, CASE WHEN lag(label) OVER l IS NOT NULL AND lag(label) OVER l <> label THEN 1 ELSE 0 END AS t FROM lab
 WINDOW l AS (PARTITION BY scan_id, y, x ORDER BY z)),
 m AS (SELECT scan_id, z, y, x, label, avg(CAST(label = 1 AS DOUBLE)) OVER a AS freq_short, avg(CAST(label = 0 AS DOUBLE)) OVER a AS frac0_short,
 avg(CAST(label = 2 AS DOUBLE)) OVER a AS frac2_short, sum(t) OVER b AS flip_short, avg(CAST(label = 1 AS DOUBLE)) OVER c AS freq_long FROM f
 WINDOW a AS (PARTITION BY scan_id, y, x ORDER BY z ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING),
 b AS (PARTITION BY scan_id, y, x ORDER BY z ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING),
 c AS (PARTITION BY scan_id, y, x ORDER BY z ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))"""


def _both_windows(spark, sf_dir) -> DataFrame:
    return zmetrics.window_metrics(derive.labels(spark, sf_dir), {"short": 3, "long": 7})


def _stats_sql(name: str) -> str:
    c = f"CASE WHEN label = 1 THEN freq_{name} END"
    return f"""round(min({c}), 6) AS {name}_min, round(avg({c}), 6) AS {name}_mean, round(quantile_cont({c}, 0.5), 6) AS {name}_median,
 round(quantile_cont({c}, 0.05), 6) AS {name}_p5, round(quantile_cont({c}, 0.95), 6) AS {name}_p95"""


@query(f"""WITH {BOTH_SQL} SELECT scan_id, min(flip_short)::BIGINT AS flip_min, max(flip_short)::BIGINT AS flip_max, round(avg(flip_short), 6) AS flip_mean,
 round(100.0 * count_if(flip_short > 0) / count(*)::DOUBLE, 6) AS flip_percent, {_stats_sql('short')}, {_stats_sql('long')},
 count_if(label = 1 AND freq_short < 0.6 AND freq_long >= 0.3)::BIGINT AS short_only,
 count_if(label = 1 AND freq_short >= 0.6 AND freq_long < 0.3)::BIGINT AS long_only FROM m GROUP BY scan_id""")
def z_diagnostics(spark, sf_dir):
    return rounded(zmetrics.diagnostics(_both_windows(spark, sf_dir), 0.6, 0.3))


@query(f"""WITH {LAB_SQL}, p AS (SELECT scan_id, z, CAST(label = 1 AS BIGINT) AS a, lead(CAST(label = 1 AS BIGINT)) OVER (PARTITION BY scan_id, y, x ORDER BY z) AS b FROM lab)
 SELECT scan_id, z, round(CASE WHEN sum(a) + sum(b) = 0 THEN 1.0 ELSE 2.0 * sum(a * b) / (sum(a) + sum(b))::DOUBLE END, 6) AS dice
 FROM p WHERE b IS NOT NULL GROUP BY scan_id, z""")
def dice_adjacent(spark, sf_dir):
    return rounded(zmetrics.adjacent_dice(derive.labels(spark, sf_dir)))


RUN_SQL = f"""{LAB_SQL}, i AS (SELECT scan_id, y, x, label = 1 AS o, row_number() OVER (PARTITION BY scan_id, y, x ORDER BY z)
 - row_number() OVER (PARTITION BY scan_id, y, x, label = 1 ORDER BY z) AS g FROM lab),
 r AS (SELECT scan_id, y, x, o, g, count(*) AS n FROM i GROUP BY ALL),
 runs AS (SELECT scan_id, y, x, max(CASE WHEN o THEN n ELSE 0 END)::BIGINT AS max_run FROM r GROUP BY scan_id, y, x)"""


@query(f"WITH {RUN_SQL} SELECT scan_id, y, x, max_run FROM runs")
def run_length_map(spark, sf_dir):
    return zmetrics.longest_runs(derive.labels(spark, sf_dir))


@query(f"""WITH {RUN_SQL} SELECT scan_id, count(*) AS lines, round(coalesce(avg(CASE WHEN max_run > 0 THEN max_run END), 0), 6) AS mean_run,
 round(coalesce(quantile_cont(CASE WHEN max_run > 0 THEN max_run END, 0.5), 0), 6) AS median_run FROM runs GROUP BY scan_id""")
def run_length_stats(spark, sf_dir):
    return rounded(zmetrics.run_stats(zmetrics.longest_runs(derive.labels(spark, sf_dir))))


# --- components ---

COMP_SQL = """hit AS (SELECT scan_id, z, y * 8 + x AS c, y, x FROM lab WHERE label = 1),
 edge AS (SELECT a.scan_id, a.z, a.c AS a, b.c AS b FROM hit a JOIN hit b ON a.scan_id = b.scan_id AND a.z = b.z AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
 reach AS (SELECT scan_id, z, c AS a, c AS b FROM hit UNION SELECT r.scan_id, r.z, r.a, e.b FROM reach r JOIN edge e ON r.scan_id = e.scan_id AND r.z = e.z AND r.b = e.a),
 root AS (SELECT scan_id, z, b AS c, min(a) AS root FROM reach GROUP BY scan_id, z, b),
 comp AS (SELECT scan_id, z, c // 8 AS y, c % 8 AS x, dense_rank() OVER (PARTITION BY scan_id, z ORDER BY root) AS comp,
 count(*) OVER (PARTITION BY scan_id, z, root) AS comp_size FROM root)"""


@query(f"WITH RECURSIVE {LAB_SQL}, {COMP_SQL} SELECT scan_id, z, y, x, comp, comp_size FROM comp")
def components8(spark, sf_dir):
    return components.components(derive.labels(spark, sf_dir)).where("comp is not null").drop("label")


@query(f"WITH RECURSIVE {LAB_SQL}, {COMP_SQL} SELECT scan_id, z, y, x, comp, comp_size FROM comp")
def components8_tiled(spark, sf_dir):
    return components.components(derive.labels(spark, sf_dir), tile=3).where("comp is not null").drop("label")


OVERLAP_SQL = f"""{LAB_SQL}, {COMP_SQL}, ov AS (SELECT a.scan_id, a.z, a.comp, b.comp AS prev, count(*) AS n FROM comp a JOIN comp b
 ON a.scan_id = b.scan_id AND a.z = b.z + 1 AND a.y = b.y AND a.x = b.x GROUP BY ALL),
 pick AS (SELECT scan_id, z, comp, prev FROM ov QUALIFY row_number() OVER (PARTITION BY scan_id, z, comp ORDER BY n DESC, prev) = 1)"""


@query(f"WITH RECURSIVE {OVERLAP_SQL} SELECT scan_id, z, comp, prev FROM pick")
def component_overlap(spark, sf_dir):
    return components.overlaps(components.components(derive.labels(spark, sf_dir)))


@query(f"""WITH RECURSIVE {OVERLAP_SQL}, life AS (SELECT scan_id, prev, count(*) + 1 AS life FROM pick GROUP BY scan_id, prev)
 SELECT scan_id, round(coalesce(avg(life), 0), 6) AS mean_life, round(coalesce(quantile_cont(life, 0.5), 0), 6) AS median_life,
 coalesce(max(life), 0)::DOUBLE AS max_life, count(life) AS n_lives FROM (SELECT DISTINCT scan_id FROM lab) LEFT JOIN life USING (scan_id) GROUP BY scan_id""")
def component_persistence(spark, sf_dir):
    return rounded(components.persistence(components.components(derive.labels(spark, sf_dir))))


@query(f"""WITH {LAB_SQL} SELECT a.scan_id, a.z, a.y, a.x, round(count_if(b.label = 0) / count(*)::DOUBLE, 6) AS nb0,
 round(count_if(b.label = 2) / count(*)::DOUBLE, 6) AS nb2 FROM lab a JOIN lab b ON a.scan_id = b.scan_id AND a.z = b.z
 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND (a.y <> b.y OR a.x <> b.x) WHERE a.label = 1 GROUP BY a.scan_id, a.z, a.y, a.x""")
def neighbour_ratio8(spark, sf_dir):
    return rounded(components.neighbour_fractions(derive.labels(spark, sf_dir)))


# --- corrections ---


def _rule(t: correct.Thresholds, joiner: str) -> str:
    return f" {joiner} ".join((f"freq_short < {t.min_short_frequency}", f"flip_short > {t.max_flip_rate}", f"freq_long < {t.min_long_frequency}", f"comp_size < {t.min_component_size}"))


def _fixed_sql(t: correct.Thresholds, joiner: str) -> str:
    return f"""{BOTH_SQL}, {COMP_SQL}, j AS (SELECT m.*, comp_size FROM m LEFT JOIN comp USING (scan_id, z, y, x)),
 k AS (SELECT *, label = 1 AND ({_rule(t, joiner)}) AS noise FROM j),
 fixed AS (SELECT *, CASE WHEN noise THEN CASE WHEN frac0_short > frac2_short THEN 0 ELSE 2 END ELSE label END::BIGINT AS corrected FROM k)"""


#: The conservative rule with a flip limit that a window of three slices can pass (the shipped limit of 2 never fires).
PASSABLE = correct.Thresholds(0.7, 1, 0.6, 10)


def _corrected(spark, sf_dir, t: correct.Thresholds, every: bool) -> DataFrame:
    sizes = components.components(derive.labels(spark, sf_dir)).select("scan_id", "z", "y", "x", "comp_size")
    return correct.correct(_both_windows(spark, sf_dir).join(sizes, ["scan_id", "z", "y", "x"]), t, every)


@query(f"""WITH RECURSIVE {_fixed_sql(PASSABLE, 'AND')} SELECT scan_id, z, y, x, label, corrected, noise,
 round(CASE WHEN noise THEN (least(greatest(1 - freq_short / 0.7, 0.0), 1.0) + least(greatest((flip_short - 1) / 1.0::DOUBLE, 0.0), 1.0)) / 2 ELSE 0 END, 6) AS confidence FROM fixed""")
def correct_conservative(spark, sf_dir):
    return rounded(_corrected(spark, sf_dir, PASSABLE, True).select("scan_id", "z", "y", "x", "label", "corrected", "noise", "confidence"))


@query(f"WITH RECURSIVE {_fixed_sql(correct.AGGRESSIVE, 'OR')} SELECT scan_id, z, y, x, label, corrected, noise FROM fixed")
def correct_aggressive(spark, sf_dir):
    return _corrected(spark, sf_dir, correct.AGGRESSIVE, False).select("scan_id", "z", "y", "x", "label", "corrected", "noise")


@query(f"""WITH RECURSIVE {_fixed_sql(correct.AGGRESSIVE, 'OR')} SELECT scan_id, count_if(label = 1)::BIGINT AS n_target,
 count_if(label = 1 AND freq_short < 0.4)::BIGINT AS low_short, count_if(label = 1 AND flip_short > 3)::BIGINT AS high_flip,
 count_if(label = 1 AND freq_long < 0.2)::BIGINT AS low_long, count_if(label = 1 AND comp_size < 5)::BIGINT AS small, count_if(noise)::BIGINT AS n_noise,
 count_if(noise AND corrected = 0)::BIGINT AS to_pore, count_if(noise AND corrected = 2)::BIGINT AS to_solid FROM fixed GROUP BY scan_id""")
def correction_report(spark, sf_dir):
    return correct.report(_corrected(spark, sf_dir, correct.AGGRESSIVE, False), correct.AGGRESSIVE)


@query(f"""WITH RECURSIVE {_fixed_sql(correct.AGGRESSIVE, 'OR')} SELECT scan_id, count_if(label <> corrected)::BIGINT AS n_diff,
 round(100.0 * count_if(label <> corrected) / count(*)::DOUBLE, 6) AS percent, sum(label)::BIGINT AS sum_a, sum(corrected)::BIGINT AS sum_b FROM fixed GROUP BY scan_id""")
def mask_diff(spark, sf_dir):
    fixed = _corrected(spark, sf_dir, correct.AGGRESSIVE, False)
    key = ["scan_id", "z", "y", "x"]
    return rounded(correct.difference(fixed.select(*key, "label"), fixed.select(*key, F.col("corrected").alias("label"))))


# --- distances, openings, distributions ---

EDT_SQL = VOL_SQL + """, a AS (SELECT *, last_value(CASE WHEN NOT is_pore THEN z END IGNORE NULLS) OVER (PARTITION BY scan_id, y, x ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l,
 first_value(CASE WHEN NOT is_pore THEN z END IGNORE NULLS) OVER (PARTITION BY scan_id, y, x ORDER BY z ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f FROM vol),
 g1 AS (SELECT scan_id, z, y, x, is_pore, least((z - l) * (z - l), (f - z) * (f - z)) AS g FROM a),
 g2 AS (SELECT a.scan_id, a.z, a.y, a.x, any_value(a.is_pore) AS is_pore, min(b.g + (a.y - b.y) * (a.y - b.y)) AS g
 FROM g1 a JOIN g1 b ON a.scan_id = b.scan_id AND a.z = b.z AND a.x = b.x GROUP BY a.scan_id, a.z, a.y, a.x),
 d AS (SELECT a.scan_id, a.z, a.y, a.x, any_value(a.is_pore) AS is_pore, min(b.g + (a.x - b.x) * (a.x - b.x)) AS edt2
 FROM g2 a JOIN g2 b ON a.scan_id = b.scan_id AND a.z = b.z AND a.y = b.y GROUP BY a.scan_id, a.z, a.y, a.x)"""
OPEN_SQL = EDT_SQL + """, c AS (SELECT scan_id, z, y, x, CAST(floor(sqrt(edt2)) AS BIGINT) AS k FROM d WHERE edt2 >= 1),
 o AS (SELECT p.scan_id, p.z, p.y, p.x, any_value(p.edt2) AS edt2, CAST(2 * max(c.k) AS BIGINT) AS diameter FROM d p JOIN c ON p.scan_id = c.scan_id
 AND (p.z - c.z) * (p.z - c.z) + (p.y - c.y) * (p.y - c.y) + (p.x - c.x) * (p.x - c.x) <= c.k * c.k WHERE p.is_pore GROUP BY p.scan_id, p.z, p.y, p.x)"""
HIST_SQL = OPEN_SQL + """, h AS (SELECT scan_id, diameter, count(*) AS n FROM o WHERE z BETWEEN 1 AND 14 AND y BETWEEN 1 AND 14 AND x BETWEEN 1 AND 14 GROUP BY scan_id, diameter)"""


def _bins_sql(edges: str, bins: int, um: float) -> str:
    return f"""s AS (SELECT scan_id, sum(n)::DOUBLE AS total, min(diameter)::DOUBLE AS d0, max(diameter)::DOUBLE AS d1 FROM h GROUP BY scan_id),
 e AS (SELECT scan_id, total, i AS bin, {edges} FROM s, range(0, {bins}) t(i)),
 b AS (SELECT e.scan_id, e.bin, any_value(total) AS total, any_value(e0) AS e0, any_value(e1) AS e1, coalesce(sum(n), 0)::BIGINT AS n FROM e LEFT JOIN h ON h.scan_id = e.scan_id
 AND diameter >= e0 AND (diameter < e1 OR (bin = {bins - 1} AND diameter = e1)) GROUP BY e.scan_id, e.bin)
 SELECT scan_id, bin, round((e0 + e1) / 2, 6) AS "Diameter_px", round((e0 + e1) / 2 * {um}, 6) AS "Diameter_um", n AS "Volume_Count",
 round(sum(n) OVER (PARTITION BY scan_id ORDER BY bin) / total, 6) AS "Cumulative_Porosity", round(n / (total * (e1 - e0) * {um}), 6) AS "Differential_PSD",
 (e0 + e1) / 2 >= 5 AS is_reliable FROM b"""


_AUTO = ("CASE WHEN i = 0 THEN d0 ELSE pow(10.0::DOUBLE, log10(d0) + i * (log10(1.1::DOUBLE * d1) - log10(d0)) / 50) END AS e0, "
         "pow(10.0::DOUBLE, log10(d0) + (i + 1) * (log10(1.1::DOUBLE * d1) - log10(d0)) / 50) AS e1")  # fmt: skip
PSD_SQL = f"WITH {HIST_SQL}, {_bins_sql(_AUTO, 50, 1.0)}"
CUSTOM_UM = [15.0, 45.0, 75.0, 120.0, 300.0]
_CUSTOM = f"{CUSTOM_UM}[i + 1]::DOUBLE / 15.0::DOUBLE AS e0, {CUSTOM_UM}[i + 2]::DOUBLE / 15.0::DOUBLE AS e1"


@query(f"WITH {EDT_SQL} SELECT scan_id, z, y, x, is_pore, CAST(edt2 AS BIGINT) AS edt2 FROM d")
def edt_squared(spark, sf_dir):
    return edt.edt(derive.volumes(spark, sf_dir))


@query(f"WITH {OPEN_SQL} SELECT scan_id, z, y, x, CAST(edt2 AS BIGINT) AS edt2, diameter FROM o")
def opening_map(spark, sf_dir):
    return opening.opening(edt.edt(derive.volumes(spark, sf_dir)))


#: With few solid voxels: larger balls, of which many overlap.
@query(derive.wide(f"WITH {OPEN_SQL} SELECT scan_id, z, y, x, CAST(edt2 AS BIGINT) AS edt2, diameter FROM o", 3))
def opening_map_wide(spark, sf_dir):
    return opening.opening(edt.edt(derive.volumes(spark, sf_dir, 3)))


@query(f"WITH {HIST_SQL} SELECT scan_id, diameter, n FROM h")
def diameter_hist(spark, sf_dir):
    return psd.analysed_histogram(derive.volumes(spark, sf_dir))


@query(PSD_SQL)
def psd_auto(spark, sf_dir):
    return rounded(psd.compute_psd(derive.volumes(spark, sf_dir)))


@query(f"WITH {HIST_SQL}, {_bins_sql(_CUSTOM, 4, 15.0)}")
def psd_custom_edges(spark, sf_dir):
    return rounded(psd.compute_psd(derive.volumes(spark, sf_dir), (15.0, 15.0, 15.0), CUSTOM_UM))


#: With few solid voxels: diameters of five and more.
WIDE_PSD_SQL = derive.wide(PSD_SQL, 3)


def _wide_psd(spark, sf_dir):
    return rounded(psd.compute_psd(derive.volumes(spark, sf_dir, 3)))


@query(f"SELECT * FROM ({WIDE_PSD_SQL}) WHERE is_reliable")
def psd_reliable(spark, sf_dir):
    return _wide_psd(spark, sf_dir).where("is_reliable")


@query(f"""SELECT scan_id, bin, n AS "Volume_Count" FROM (SELECT scan_id, (min(bin) + max(bin)) // 2 AS bin, any_value(n) AS n, run FROM (
 SELECT *, sum(CASE WHEN n = was THEN 0 ELSE 1 END) OVER (PARTITION BY scan_id ORDER BY bin) AS run FROM (
 SELECT scan_id, bin, "Volume_Count" AS n, lag("Volume_Count") OVER (PARTITION BY scan_id ORDER BY bin) AS was FROM ({WIDE_PSD_SQL}))) GROUP BY scan_id, run)
 QUALIFY n > lag(n) OVER (PARTITION BY scan_id ORDER BY run) AND n > lead(n) OVER (PARTITION BY scan_id ORDER BY run) AND n >= 5""")
def psd_peaks(spark, sf_dir):
    return psd.peaks(_wide_psd(spark, sf_dir), 5).select("scan_id", "bin", "Volume_Count")


@query(f'SELECT scan_id, round(arg_max("Diameter_px", ("Volume_Count", -bin)), 6) AS peak_px, round(stddev_samp(CASE WHEN "Volume_Count" > 0 THEN "Diameter_px" END), 6) AS std_px '
       f'FROM ({PSD_SQL}) GROUP BY scan_id')  # fmt: skip
def psd_spread(spark, sf_dir):
    return rounded(psd.spread(psd_auto(spark, sf_dir)))


# --- filters ---


def _mirror(i: str, n: int = 8) -> str:
    return f"CASE WHEN {i} < 0 THEN -({i}) - 1 WHEN {i} >= {n} THEN {2 * n - 1} - ({i}) ELSE {i} END"


def _near_sql(h: int) -> str:
    return f"""WITH {GRAY_SQL}, near AS (SELECT g.scan_id, g.z, g.y, g.x, s.v, v / 255.0::DOUBLE AS f FROM (SELECT scan_id, z, y, x, {_mirror('y + a.i')} AS sy, {_mirror('x + b.i')} AS sx
 FROM gray, range(-{h}, {h + 1}) a(i), range(-{h}, {h + 1}) b(i)) g JOIN (SELECT scan_id, z, y AS sy, x AS sx, v FROM gray) s USING (scan_id, z, sy, sx))"""


@query(_near_sql(1) + " SELECT scan_id, z, y, x, median(v)::DOUBLE AS median FROM near GROUP BY scan_id, z, y, x")
def median3(spark, sf_dir):
    return filters.median(derive.gray(spark, sf_dir), 3, "edge")


@query(_near_sql(2) + " SELECT scan_id, z, y, x, median(v)::DOUBLE AS median FROM near GROUP BY scan_id, z, y, x")
def median5(spark, sf_dir):
    return filters.median(derive.gray(spark, sf_dir), 5)


@query(_near_sql(2) + " SELECT scan_id, z, y, x, median(v)::DOUBLE AS median FROM near GROUP BY scan_id, z, y, x")
def median5_tiled(spark, sf_dir):
    return filters.median(derive.gray(spark, sf_dir), 5, tile=3)


@query(_near_sql(3) + " SELECT scan_id, z, y, x, round(greatest(avg(f * f) - avg(f) * avg(f), 0), 6) AS variance FROM near GROUP BY scan_id, z, y, x")
def local_variance(spark, sf_dir):
    return rounded(filters.local_variance(derive.gray(spark, sf_dir)))


def _sobel_sql() -> str:
    gx = "sum(s.v / 255.0::DOUBLE * b.i * (2 - abs(a.i)))"
    gy = "sum(s.v / 255.0::DOUBLE * a.i * (2 - abs(b.i)))"
    return f"""WITH {GRAY_SQL} SELECT g.scan_id, g.z, g.y, g.x, round(sqrt({gx} * {gx} + {gy} * {gy}), 6) AS gradient
 FROM gray g, range(-1, 2) a(i), range(-1, 2) b(i), gray s WHERE s.scan_id = g.scan_id AND s.z = g.z
 AND s.y = {_mirror('g.y + a.i')} AND s.x = {_mirror('g.x + b.i')} GROUP BY g.scan_id, g.z, g.y, g.x"""


@query(_sobel_sql())
def sobel(spark, sf_dir):
    return rounded(filters.gradient(derive.gray(spark, sf_dir)))


BOUNDARY_SQL = LAB_SQL + """, rim AS (SELECT DISTINCT a.scan_id, a.z, a.y, a.x FROM lab a JOIN lab b ON a.scan_id = b.scan_id AND a.z = b.z
 AND abs(a.y - b.y) + abs(a.x - b.x) = 1 AND (a.label = 0) <> (b.label = 0)),
 zone AS (SELECT l.scan_id, l.z, l.y, l.x, l.label, coalesce(bool_or((l.y - r.y) * (l.y - r.y) + (l.x - r.x) * (l.x - r.x) <= 9), false) AS boundary
 FROM lab l LEFT JOIN rim r ON l.scan_id = r.scan_id AND l.z = r.z GROUP BY l.scan_id, l.z, l.y, l.x, l.label)"""


@query(f"WITH {BOUNDARY_SQL} SELECT scan_id, z, y, x, boundary FROM zone")
def boundary_zone(spark, sf_dir):
    return filters.boundary_zone(derive.labels(spark, sf_dir))


WEAK_SQL = f"""{_near_sql(3)}, var AS (SELECT scan_id, z, y, x, greatest(avg(f * f) - avg(f) * avg(f), 0) AS variance FROM near GROUP BY scan_id, z, y, x),
 lab AS (SELECT scan_id, z, y, x, CAST(CASE WHEN v < 108 THEN 0 WHEN v < 142 THEN 1 ELSE 2 END AS BIGINT) AS label FROM gray),
 grad AS ({_sobel_sql().partition('SELECT g.scan_id')[1] + _sobel_sql().partition('SELECT g.scan_id')[2].replace('round(sqrt', '(sqrt').replace(', 6) AS gradient', ') AS gradient')}),
 {BOUNDARY_SQL.removeprefix(LAB_SQL).lstrip(', ')},
 whole AS (SELECT scan_id, z, y, x, label, variance, gradient, round(variance, 9) AS v9, round(gradient, 9) AS g9, boundary FROM var JOIN grad USING (scan_id, z, y, x) JOIN zone USING (scan_id, z, y, x)),
 lim AS (SELECT scan_id, z, quantile_cont(v9, 0.9) AS vl, quantile_cont(g9, 0.9) AS gl FROM whole GROUP BY scan_id, z)
 SELECT w.scan_id, w.z, y, x, round(variance, 6) AS variance, round(gradient, 6) AS gradient, boundary,
 CASE WHEN v9 > vl OR g9 > gl OR boundary THEN 255 ELSE label END::BIGINT AS weak FROM whole w JOIN lim USING (scan_id, z)"""


@query(WEAK_SQL)
def weak_labels(spark, sf_dir):
    gray = derive.gray(spark, sf_dir)
    return rounded(weak.weak_labels(gray.withColumn("label", derive.cut(F.col("v")))))


def _clahe_sql(tile: int, clip: float) -> str:
    """Tile histograms, clipped; each pixel mixes the running sums of the four tiles around it at its level."""
    return f"""WITH {GRAY_SQL}, hist AS (SELECT scan_id, z, y // {tile} AS ty, x // {tile} AS tx, v, count(*)::DOUBLE AS n FROM gray GROUP BY ALL),
 cell AS (SELECT scan_id, z, ty, tx, sum(n) AS total, greatest(1.0, {clip}::DOUBLE * sum(n)) AS lim FROM hist GROUP BY ALL),
 spare AS (SELECT scan_id, z, ty, tx, any_value(total) AS total, any_value(lim) AS lim, sum(greatest(n - lim, 0)) AS spare
 FROM hist JOIN cell USING (scan_id, z, ty, tx) GROUP BY ALL),
 grid AS (SELECT scan_id, z, max(ty) AS my, max(tx) AS mx FROM hist GROUP BY scan_id, z),
 pix AS (SELECT g.*, my, mx, (y + 0.5::DOUBLE) / {tile} - 0.5::DOUBLE AS ay, (x + 0.5::DOUBLE) / {tile} - 0.5::DOUBLE AS ax FROM gray g JOIN grid USING (scan_id, z)),
 corner AS (SELECT scan_id, z, y, x, v, CAST(least(greatest(floor(ay) + a.i, 0), my) AS BIGINT) AS ty, CAST(least(greatest(floor(ax) + b.i, 0), mx) AS BIGINT) AS tx,
 CASE WHEN a.i = 0 THEN 1 - least(greatest(ay - floor(ay), 0), 1) ELSE least(greatest(ay - floor(ay), 0), 1) END
 * CASE WHEN b.i = 0 THEN 1 - least(greatest(ax - floor(ax), 0), 1) ELSE least(greatest(ax - floor(ax), 0), 1) END AS w FROM pix, range(0, 2) a(i), range(0, 2) b(i)),
 level AS (SELECT DISTINCT scan_id, z, ty, tx, v FROM corner),
 map AS (SELECT l.scan_id, l.z, l.ty, l.tx, l.v, (sum(CASE WHEN n IS NULL THEN 0 ELSE least(n, lim) END) + any_value(spare) / 256 * (l.v + 1)) / any_value(total) AS m
 FROM level l JOIN spare s USING (scan_id, z, ty, tx) LEFT JOIN hist h ON h.scan_id = l.scan_id AND h.z = l.z AND h.ty = l.ty AND h.tx = l.tx AND h.v <= l.v
 GROUP BY l.scan_id, l.z, l.ty, l.tx, l.v),
 eq AS (SELECT scan_id, z, y, x, sum(w * m) AS clahe FROM corner JOIN map USING (scan_id, z, ty, tx, v) GROUP BY scan_id, z, y, x)"""


@query(_clahe_sql(4, 0.05) + " SELECT scan_id, z, y, x, round(clahe, 6) AS clahe FROM eq")
def clahe(spark, sf_dir):
    return rounded(filters.clahe(derive.gray(spark, sf_dir), tile=4, clip=0.05))


# Shares of a tile's pixels lie just between two numbers of six decimals: a little is added before they are rounded.
@query(_clahe_sql(61, 0.01) + " SELECT scan_id, z, y, x, round(clahe + 1e-9::DOUBLE, 6) AS clahe FROM eq")
def clahe_default(spark, sf_dir):
    f = filters.clahe(derive.gray(spark, sf_dir))
    return rounded(f.withColumn("clahe", F.col("clahe") + 1e-9))


@query(_clahe_sql(3, 0.05) + " SELECT scan_id, z, y, x, round(clahe + 1e-9::DOUBLE, 6) AS clahe FROM eq")
def clahe_tiled(spark, sf_dir):
    f = filters.clahe(derive.gray(spark, sf_dir), tile=3, clip=0.05, by_tiles=True)
    return rounded(f.withColumn("clahe", F.col("clahe") + 1e-9))


def _preprocess_sql() -> str:
    near = _near_sql(2).partition("near AS ")[2].replace("v / 255.0::DOUBLE AS f", "s.f").replace(
        "(SELECT scan_id, z, y AS sy, x AS sx, v FROM gray)", "(SELECT scan_id, z, y AS sy, x AS sx, clahe AS f, 0 AS v FROM eq)"
    )
    return f"{_clahe_sql(4, 0.05)}, near AS {near} SELECT scan_id, z, y, x, CAST(round_even(round(median(f) * 255, 9), 0) AS BIGINT) AS pre FROM near GROUP BY scan_id, z, y, x"


@query(_preprocess_sql())
def preprocess(spark, sf_dir):
    return filters.preprocess(derive.gray(spark, sf_dir), tile=4, clip=0.05)


def _gauss_sql(h: int = 4) -> str:
    w = "exp(-0.5::DOUBLE * ({a}.i * {a}.i + {b}.i * {b}.i))".format(a="a", b="b")
    return f"""WITH {GRAY_SQL} SELECT g.scan_id, g.z, g.y, g.x, round(sum(s.v * {w}) / sum({w}), 6) AS smooth
 FROM gray g, range(-{h}, {h + 1}) a(i), range(-{h}, {h + 1}) b(i), gray s WHERE s.scan_id = g.scan_id AND s.z = g.z
 AND s.y = {_mirror('g.y + a.i')} AND s.x = {_mirror('g.x + b.i')} GROUP BY g.scan_id, g.z, g.y, g.x"""


@query(_gauss_sql())
def gaussian_blur(spark, sf_dir):
    return rounded(filters.gaussian(derive.gray(spark, sf_dir), 1.0))


# --- regions and pairs ---


@query(f"WITH {GRAY_SQL} SELECT scan_id, z, y - 2 AS y, x - 2 AS x, v FROM gray WHERE y BETWEEN 2 AND 5 AND x BETWEEN 2 AND 5")
def roi_crop(spark, sf_dir):
    return roi.centre_crop(derive.gray(spark, sf_dir), 4)


@query(f"""WITH {GRAY_SQL}, r AS (SELECT scan_id, z, row_number() OVER (PARTITION BY scan_id ORDER BY z) - 1 AS k, count(*) OVER (PARTITION BY scan_id) AS m
 FROM (SELECT DISTINCT scan_id, z FROM gray)) SELECT g.scan_id, k - 5 AS z, y, x, v FROM gray g JOIN r USING (scan_id, z) WHERE k >= 5 AND k < m - 5""")
def z_trim(spark, sf_dir):
    return roi.trim_slices(derive.gray(spark, sf_dir), 5, 5)


_SIDES = ("events_of AS (SELECT {c} AS k, event_id, value FROM events WHERE event_type = 'purchase')", "custs AS (SELECT c_custkey AS k, c_name FROM customer)")


def _sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    bought = derive.table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("k"), "event_id", "value")
    return bought, derive.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name")


@query(f"WITH {_SIDES[0].format(c='user_id')}, {_SIDES[1]}, last AS (SELECT * FROM events_of QUALIFY row_number() OVER (PARTITION BY k ORDER BY event_id DESC) = 1) "
       "SELECT k, event_id, c_name FROM last JOIN custs USING (k)")  # fmt: skip
def pair_inner(spark, sf_dir):
    return weak.pair(*_sides(spark, sf_dir), "k", "event_id", "c_name").select("k", "event_id", "c_name")


@query(f"WITH {_SIDES[0].format(c='user_id')}, {_SIDES[1]} SELECT DISTINCT k, 'a' AS side FROM events_of WHERE k NOT IN (SELECT k FROM custs) "
       "UNION ALL SELECT DISTINCT k, 'b' AS side FROM custs WHERE k NOT IN (SELECT k FROM events_of)")  # fmt: skip
def pair_unmatched(spark, sf_dir):
    return weak.unmatched(*_sides(spark, sf_dir), "k")
