"""Tiles against whole slices, thresholds of many levels, percentiles by radix."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackgrain.operators import components, filters, intensity, otsu, radix, union, weak

from .test_voxel_operators import flood, from_array

KEY = ["scan_id", "z", "y", "x"]


def same(a, b, columns, close=None):
    both = a.join(b.select(*KEY, *(F.col(c).alias(f"{c}_") for c in columns)), KEY, "full").toPandas()
    assert len(both)
    for c in columns:
        if close:
            assert np.allclose(both[c], both[f"{c}_"], rtol=0, atol=close)
        else:
            assert (both[c].isna() == both[f"{c}_"].isna()).all() and (both[c].dropna() == both[f"{c}_"].dropna()).all()


@pytest.fixture(scope="module")
def gray(spark):
    """Two slices of 23 x 31, the second beginning at (5, 2) and with holes."""
    r = np.random.default_rng(1)
    df = from_array(spark, r.integers(0, 256, (2, 23, 31)), "v")
    return df.where("z = 0 or (y >= 5 and x >= 2 and (y * 7 + x * 3) % 11 <> 0)").cache()


@pytest.mark.parametrize("tile", [4, 7, 100])
def test_filters_on_tiles_equal_whole_slices(gray, tile):
    for border in ("symmetric", "edge"):
        same(filters.median(gray, 5, border), filters.median(gray, 5, border, tile), ["median"])
    same(filters.gradient(gray), filters.gradient(gray, tile), ["gradient"])
    same(filters.gaussian(gray, 1.0), filters.gaussian(gray, 1.0, tile=tile), ["smooth"], 1e-9)
    same(filters.local_variance(gray), filters.local_variance(gray, tile=tile), ["variance"], 1e-12)
    labels = gray.withColumn("label", (F.col("v") > 100).cast("long") + (F.col("v") > 180).cast("long"))
    for distance in (0, 3):
        same(filters.boundary_zone(labels, distance=distance), filters.boundary_zone(labels, distance=distance, tile=tile), ["boundary"])
    same(components.neighbour_fractions(labels), components.neighbour_fractions(labels, tile=tile), ["nb0", "nb2"])


@pytest.mark.parametrize(("tile", "shape"), [(4, (23, 31)), (5, (10, 11)), (16, (9, 12)), (3, (3, 3))])
def test_contrast_and_preprocessing_on_tiles(spark, tile, shape):
    df = from_array(spark, np.random.default_rng(2).integers(0, 256, (2, *shape)), "v")
    same(filters.clahe(df, tile, 0.05), filters.clahe(df, tile, 0.05, by_tiles=True), ["clahe"])
    same(filters.preprocess(df, tile, 0.05), filters.preprocess(df, tile, 0.05, part=6), ["pre"])


def tasks_of_slices(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "ty#" not in x]


def test_no_task_of_a_tiled_plan_is_a_slice(spark):
    """What is exchanged by slice alone are the bounds, a row a task and slice."""
    df = from_array(spark, np.zeros((1, 9, 9), int), "v")
    plan = filters.median(df, 5, tile=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow [scan_id#" in plan and "ty#" in plan.split("FlatMapGroupsInArrow [")[1].split("]")[0]


@pytest.mark.parametrize("tile", [1, 3, 8, 64])
def test_components_across_tiles(spark, tile):
    r = np.random.default_rng(3)
    a = np.stack([r.random((20, 27)) < share for share in (0.0, 0.35, 0.5, 0.7, 1.0)]).astype(int)
    spiral = np.zeros((20, 27), int)
    for k in range(0, 10, 2):
        spiral[k, k : 27 - k] = spiral[k : 20 - k, 26 - k] = spiral[19 - k, k + 1 : 27 - k] = spiral[k + 2 : 20 - k, k + 1 if k else 0] = 1
    a = np.concatenate([a, spiral[None]])
    df = from_array(spark, a, "label")
    same(components.components(df), components.components(df, tile=tile), ["label", "comp", "comp_size"])


def test_a_large_slice(spark):
    """4000 x 4000: paths that cross all tiles, and islands."""
    y, x = np.indices((4000, 4000), np.int32)
    mask = ((y % 40 < 3) & ~((y % 80 == 0) & (x % 50 == 7))) | ((x % 97 == 0) & (y // 40 % 3 < 2)) | ((y % 40 == 20) & (x % 13 < 5))
    want, size = components.label_components(mask)
    pixels = spark.range(16_000_000, numPartitions=16).select(F.lit(0).alias("scan_id"), F.lit(0).alias("z"), F.expr("cast(id div 4000 as int)").alias("y"), F.expr("cast(id % 4000 as int)").alias("x"))
    in_sql = "(y % 40 < 3 and not (y % 80 = 0 and x % 50 = 7)) or (x % 97 = 0 and (y div 40) % 3 < 2) or (y % 40 = 20 and x % 13 < 5)"
    found = components.components(pixels.withColumn("label", F.expr(f"if({in_sql}, 1, 0)")), tile=512)
    hash_ = found.where("comp is not null").agg(F.count("*"), F.sum(F.col("comp") * (F.col("y") * 7 + F.col("x"))), F.sum("comp_size"), F.max("comp")).first()
    ys, xs = np.nonzero(mask)
    assert tuple(hash_) == (int(mask.sum()), int((want[mask] * (ys * 7 + xs)).sum()), int(size[mask].sum()), int(want.max()))


def test_stars(spark):
    edges = [(1, i, i + 1) for i in range(60)] + [(2, 5, 9), (2, 9, 7), (2, 1, 1)] + [(1, 200, 100 + i) for i in range(30)]
    got = {(r.k, r.node): r.root for r in union.stars(spark.createDataFrame(edges, "k long, a long, b long"), ["k"]).collect()}
    assert got == {(1, i): 0 for i in range(1, 61)} | {(2, 9): 5, (2, 7): 5} | {(1, i): 100 for i in [200, *range(101, 130)]}
    assert union.stars(spark.createDataFrame([], "k long, a long, b long"), ["k"]).count() == 0


def test_flood_agrees_with_the_oracle():
    mask = np.random.default_rng(5).random((12, 14)) < 0.5
    assert (components.label_components(mask)[0] == flood(mask)).all()


# --- levels ---


def plain_thresholds(values, classes):
    levels, n = np.unique(values, return_counts=True)
    p, s = np.append(0, np.cumsum(n)).astype(float), np.append(0, np.cumsum(n * levels)).astype(float)
    best = None
    for cut in itertools.combinations(range(1, len(levels)), classes - 1):
        ends = [0, *cut, len(levels)]
        f = round(sum((s[b] - s[a]) ** 2 / (p[b] - p[a]) for a, b in zip(ends, ends[1:], strict=False)), 6)
        if best is None or f > best[0]:
            best = f, [int(levels[c - 1]) for c in cut]
    return best and best[1]


@pytest.mark.parametrize("classes", [2, 3, 4, 5])
def test_thresholds_equal_all_cuts(spark, classes):
    r = np.random.default_rng(classes)
    a = np.stack([r.choice(r.integers(0, 300, k), (4, 6)) for k in (1, 2, 3, 4, 6, 9, 14)] + [np.arange(24).reshape(4, 6) // 2])
    got = {row.z: row.t for row in otsu.thresholds(from_array(spark, a, "v"), classes).collect()}
    want = {z: plain_thresholds(s, classes) for z, s in enumerate(a)}
    assert got == {z: t for z, t in want.items() if t is not None}


def test_all_pairs_of_256_levels():
    r = np.random.default_rng(9)
    for _ in range(5):
        n = r.integers(1, 60, 256)
        v = np.arange(256)
        p, s = np.cumsum(n), np.cumsum(n * v)
        assert [int(v[i]) for i in otsu.best_splits(p, s, 3)] == plain_thresholds(np.repeat(v, n), 3)


def test_levels_of_sixteen_bits(spark):
    """A slice of 65,536 levels, around three peaks."""
    r = np.random.default_rng(10)
    v = np.concatenate([np.arange(65_536), *(np.clip(r.normal(m, 800, 100_000), 0, 65_535).astype(int) for m in (9_000, 30_000, 52_000))])
    df = spark.createDataFrame([(0, 0, int(x), int(n)) for x, n in zip(*np.unique(v, return_counts=True))], "scan_id long, z long, v long, n long")
    (row,) = otsu._by_programming(df, 3).collect()
    assert all(abs(t - m) < 2_000 for t, m in zip(row.t, (19_500, 41_000)))
    with pytest.raises(ValueError):
        otsu.thresholds(df, 1)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_percentiles_by_radix(spark, kind):
    r = np.random.default_rng(11)
    rows = []
    for z, values in enumerate((r.normal(0, 1, 501), r.random(64) * 1e-30, np.round(r.normal(0, 3, 300)), [1.5], [-0.0, 0.0, 0.0, -0.0], [float("-inf"), -1e300, 2.0, float("inf")], np.full(50, -7.25))):
        rows += [(0, z, float(v)) for v in values]
    rows += [(1, 0, None), (1, 1, None), (1, 1, 4.0), (1, 2, float("nan")), (1, 2, 1.0), (1, 2, 2.0)]
    df = spark.createDataFrame(rows, "scan_id long, z long, v double").select("scan_id", "z", F.col("v").cast(kind).alias("v"))
    shares = [0.0, 0.005, 0.25, 0.5, 0.9, 0.995, 1.0]
    want = df.where("v is not null").groupBy("scan_id", "z").agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("q"))
    got = {(x.scan_id, x.z): x.q for x in radix.percentiles(df, shares).collect()}
    want = {(x.scan_id, x.z): x.q for x in want.collect()}
    assert got.keys() == want.keys()
    for k, q in want.items():
        assert np.allclose(got[k], q, rtol=1e-15, atol=0, equal_nan=True), k


def test_radix_keys_sort_like_floats():
    r = np.random.default_rng(12)
    for kind in (np.float32, np.float64):
        v = np.concatenate([r.normal(0, 1e20, 500), r.normal(0, 1e-20, 500), [0.0, np.inf, -np.inf, 5e-324]]).astype(kind)
        keys = radix.keys_of(v.copy())
        assert (v[np.argsort(keys, kind="stable")] == np.sort(v)).all() and (radix.values_of(keys, np.dtype(kind)) == v).all()


def test_float_slices_are_normalised_by_radix(spark):
    f = np.random.default_rng(13).random((2, 9, 9))
    df = spark.createDataFrame([(0, *map(int, i), float(f[i])) for i in np.ndindex(f.shape)], "scan_id long, z long, y long, x long, v double")
    by_levels = intensity.to_uint8(intensity.normalise_dtype(df, "float32"), "percentile")
    by_radix = intensity.to_uint8(intensity.normalise_dtype(df, "float32"), "percentile", by="radix")
    same(by_levels, by_radix, ["v"])
    u = intensity.norm200(df, "float32")
    assert u.count() == f.size and u.agg(F.max("u")).first()[0] <= 255


def test_weak_labels_percentiles(spark, gray):
    """The limits that the kernel takes are Spark's percentiles over the slice."""
    labels = gray.withColumn("label", (F.col("v") > 100).cast("long"))
    got = weak.weak_labels(labels, distance=0).toPandas()
    frame = labels.join(filters.local_variance(gray), KEY).join(filters.gradient(gray), KEY)
    q = [F.percentile(F.round(c, 9), F.lit(0.9)).alias(f"{c}_q") for c in ("variance", "gradient")]
    whole = frame.where("z = 0").crossJoin(frame.where("z = 0").agg(*q)).withColumn("want", F.when((F.round("variance", 9) > F.col("variance_q")) | (F.round("gradient", 9) > F.col("gradient_q")), 255).otherwise(F.col("label")))
    want = {(r.y, r.x): r.want for r in whole.collect()}
    assert {(r.y, r.x): r.weak for r in got[got.z == 0].itertuples()} == want


def test_small_tiles_are_worked_on_by_batches(spark):
    """Tiles of a few pixels: no Python call for each of them, and the values of the whole slice."""
    r = np.random.default_rng(8)
    rows = [(s, z, y, x, int(r.integers(0, 256))) for s in (1, 2) for z in range(3) for y in range(7) for x in range(8)]
    gray = spark.createDataFrame(rows, "scan_id long, z long, y long, x long, v long")
    for tile in (1, 3, 50):
        got = filters.clahe(gray, tile, 0.05, by_tiles=True)
        label = gray.select("scan_id", "z", "y", "x", (F.col("v") > 120).cast("long").alias("label"))
        found = components.components(label, tile=tile)
        for plan in (got, components._tile_components(label, 1, tile)):
            assert "GroupsInArrow" not in plan._jdf.queryExecution().toString()
        key = lambda d: sorted(tuple(x) for x in d.collect())
        one, two = key(got), key(filters.clahe(gray, tile, 0.05))
        assert [x[:4] for x in one] == [x[:4] for x in two] and np.allclose([x[4] for x in one], [x[4] for x in two], atol=1e-12)
        names = ("scan_id", "z", "y", "x", "comp", "comp_size")
        assert sorted(map(str, key(found.select(*names)))) == sorted(map(str, key(components.components(label).select(*names))))
