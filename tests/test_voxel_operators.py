"""Voxel operators against golden values, brute force and invariants."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stackgrain.operators import binary, components, correct, edt, filters, intensity, opening, otsu, psd, roi, weak, zmetrics
from stackgrain.sources import derive

KEY = ["scan_id", "z", "y", "x"]
BALLS_64 = [  # random64_30: centre and radius
    (46, 36, 22, 4), (15, 28, 46, 3), (26, 30, 18, 4), (31, 43, 47, 4), (29, 9, 31, 5), (37, 45, 9, 5), (28, 40, 19, 3), (29, 51, 32, 2), (34, 49, 35, 5),
    (23, 22, 54, 7), (51, 10, 44, 4), (14, 28, 16, 8), (25, 11, 32, 5), (21, 16, 33, 6), (9, 27, 35, 8), (14, 51, 15, 8), (42, 21, 24, 5), (47, 11, 9, 7),
    (13, 49, 11, 7), (36, 25, 33, 5), (41, 17, 43, 7), (38, 55, 22, 7), (30, 47, 28, 6), (25, 54, 31, 3), (32, 52, 48, 6), (22, 52, 8, 2), (14, 16, 31, 2),
    (51, 15, 31, 8), (18, 24, 15, 4), (42, 40, 12, 3)]


def balls(spark, n, centres):
    """A volume of n voxels a side whose pores are balls."""
    grid = spark.range(n**3, numPartitions=4).select(
        F.lit(0).cast("long").alias("scan_id"), F.expr(f"id div {n * n}").alias("z"), F.expr(f"id div {n} % {n}").alias("y"), F.expr(f"id % {n}").alias("x")
    )
    inside = F.lit(False)
    for cz, cy, cx, r in centres:
        inside = inside | (F.expr(f"(z - {cz}) * (z - {cz}) + (y - {cy}) * (y - {cy}) + (x - {cx}) * (x - {cx})") <= r * r)
    return grid.withColumn("is_pore", inside)


def from_array(spark, a, name, scan=0):
    return spark.createDataFrame([(scan, *map(int, i), a[i].item()) for i in np.ndindex(a.shape)], f"scan_id long, z long, y long, x long, {name} {'boolean' if a.dtype == bool else 'long'}")


def to_array(df, name, shape, fill=0):
    out = np.full(shape, fill, object)
    for r in df.collect():
        out[r.z, r.y, r.x] = r[name]
    return out


# --- distances, openings, distributions ---


@pytest.mark.parametrize(
    "n, centres, pores, top, hist",
    [
        (16, [(8, 8, 8, 5)], 515, 26, {10: 515}),
        (64, [(32, 32, 32, 15)], 14147, 226, {30: 14147}),
        (64, BALLS_64, 21697, 65, {4: 68, 6: 498, 8: 1063, 10: 2699, 12: 2784, 14: 6149, 16: 8436}),
    ],
)
def test_golden_volumes(spark, n, centres, pores, top, hist):
    volume = balls(spark, n, centres)
    assert volume.where("is_pore").count() == pores
    d = edt.edt(volume).cache()
    assert d.agg(F.max("edt2")).first()[0] == top
    found = {r.diameter: r.n for r in psd.diameter_histogram(opening.opening(d)).collect()}
    assert found == hist
    if n == 16:
        table = psd.compute_psd(volume)
        assert table.agg(F.sum("Volume_Count")).first()[0] == 515 and table.count() == 50
        first = table.orderBy("bin").first()
        assert first.Volume_Count == 515 and abs(first.Diameter_px - 10.00954) < 1e-5 and first.Cumulative_Porosity == 1.0
    d.unpersist()


def test_golden_distribution_of_nested_spheres(spark):
    hist = spark.createDataFrame([(0, 30, 14147), (0, 50, 65267)], "scan_id long, diameter long, n long")
    rows = {r.bin: r for r in psd.distribution(hist).collect()}
    assert len(rows) == 50 and rows[0].Volume_Count == 14147 and rows[42].Volume_Count == 65267
    assert abs(rows[0].Diameter_px - 30.182947) < 1e-5 and abs(rows[42].Diameter_px - 50.220895) < 1e-5
    assert abs(rows[0].Cumulative_Porosity - 0.178142) < 1e-6 and rows[49].Cumulative_Porosity == 1.0
    assert [r.bin for r in psd.peaks(psd.distribution(hist), 100).collect()] == [42]
    assert abs(psd.spread(psd.distribution(hist)).first().peak_px - 50.220895) < 1e-5
    meta = psd.metadata(hist, (15.0, 15.0, 15.0), 5).first()
    assert meta.total_pore_voxels == 79414


def test_custom_edges_and_empty(spark):
    hist = spark.createDataFrame([(0, 2, 10), (0, 4, 5), (0, 20, 1)], "scan_id long, diameter long, n long")
    rows = psd.distribution(hist, (15.0, 15.0, 15.0), [30.0, 60.0, 300.0]).orderBy("bin").collect()
    assert [r.Volume_Count for r in rows] == [10, 6]
    rows = psd.distribution(hist, (1.0, 1.0, 1.0), [3.0, 5.0, 6.0]).orderBy("bin").collect()
    assert [r.Volume_Count for r in rows] == [5, 0] and rows[-1].Cumulative_Porosity == 5 / 16
    assert psd.distribution(hist.where("false")).count() == 0


def test_distances_and_openings_equal_brute_force(spark):
    r = np.random.default_rng(1)
    shape = (7, 9, 8)
    pore = r.random(shape) < 0.85
    d = edt.edt(from_array(spark, pore, "is_pore"))
    grid = np.stack(np.indices(shape), -1).reshape(-1, 3)
    solid = grid[~pore.ravel()]
    want = ((grid[:, None] - solid[None]) ** 2).sum(-1).min(1).reshape(shape)
    assert (to_array(d, "edt2", shape) == want).all()
    k = np.floor(np.sqrt(want)).astype(int)
    centres = grid[k.ravel() >= 1]
    radius = k.ravel()[k.ravel() >= 1]
    near = ((grid[:, None] - centres[None]) ** 2).sum(-1) <= radius**2
    best = np.where(near, 2 * radius, 0).max(1).reshape(shape)
    thick = opening.opening(d)
    got = to_array(thick, "diameter", shape)
    assert (got[pore] == best[pore]).all() and thick.count() == pore.sum()
    assert (got[pore] >= 2 * k[pore]).all() and got[pore].min() >= 2
    weighted = edt.edt(from_array(spark, pore, "is_pore"), (2.0, 1.0, 1.0))
    far = (((grid[:, None] - solid[None]) * [2, 1, 1]) ** 2).sum(-1).min(1).reshape(shape)
    assert (to_array(weighted, "edt2", shape) == far).all()


def test_volume_without_solid_has_no_distance(spark):
    d = edt.edt(from_array(spark, np.ones((3, 3, 3), bool), "is_pore"))
    assert d.where("edt2 is not null").count() == 0 and opening.opening(d).count() == 0


def test_golden_lineitem_volume(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    volume = derive.volume_from_counts(rows, "0", "l_orderkey % 24", "l_suppkey % 24", "l_partkey % 24", 24)
    assert volume.where("is_pore").count() == 10106
    assert edt.edt(volume).agg(F.max("edt2"), F.sum("edt2")).first()[:] == (198, 589757)
    assert {r.diameter: r.n for r in psd.analysed_histogram(volume).collect()} == {2: 1379, 28: 6467}


def test_border_shell(spark):
    volume = balls(spark, 6, [(3, 3, 3, 2)])
    assert binary.inside_border(volume, 1).count() == 64 and binary.inside_border(volume, 0).count() == 216


# --- along z ---

LINE = [0, 1, 1, 2, 1, 0, 1]


@pytest.mark.parametrize(
    "w, want",
    [
        (3, [(2, 1 / 2, 1 / 2, 0, 1), (3, 2 / 3, 1 / 3, 0, 1), (3, 2 / 3, 0, 1 / 3, 1), (3, 2 / 3, 0, 1 / 3, 2), (3, 1 / 3, 1 / 3, 1 / 3, 2), (3, 2 / 3, 1 / 3, 0, 2), (2, 1 / 2, 1 / 2, 0, 1)]),
        (7, [(4, 2 / 4, 1 / 4, 1 / 4, 2), (5, 3 / 5, 1 / 5, 1 / 5, 3), (6, 3 / 6, 2 / 6, 1 / 6, 4), (7, 4 / 7, 2 / 7, 1 / 7, 5), (6, 4 / 6, 1 / 6, 1 / 6, 4), (5, 3 / 5, 1 / 5, 1 / 5, 4), (4, 2 / 4, 1 / 4, 1 / 4, 3)]),
        (1, [(1, float(v == 1), float(v == 0), float(v == 2), 0) for v in LINE]),
    ],
)
def test_golden_line(spark, w, want):
    df = from_array(spark, np.array(LINE).reshape(-1, 1, 1), "label")
    got = [(r.win, r.freq, r.frac0, r.frac2, r.flip) for r in zmetrics.window_metrics(df, {"": w}).orderBy("z").collect()]
    assert np.allclose(got, want)
    other = [(r.win, r.freq, r.flip) for r in zmetrics.prefix_metrics(df, w).orderBy("z").collect()]
    assert np.allclose(other, [(a, b, e) for a, b, _, _, e in want])
    assert zmetrics.longest_runs(df).first().max_run == 2


def test_dice_of_empty_slices_is_one(spark):
    df = from_array(spark, np.array([0, 0, 1, 1]).reshape(-1, 1, 1), "label")
    assert [r.dice for r in zmetrics.adjacent_dice(df).orderBy("z").collect()] == [1.0, 0.0, 1.0]


def test_corrections(spark):
    t = correct.AGGRESSIVE
    df = from_array(spark, np.array(LINE).reshape(-1, 1, 1), "label")
    m = zmetrics.window_metrics(df, {"short": 3, "long": 7}).withColumn("comp_size", F.lit(9))
    rows = {r.z: r for r in correct.correct(m, t, every=False).collect()}
    assert [z for z, r in rows.items() if r.noise] == [4] and rows[4].corrected == 2  # a tie goes to solid
    loose = correct.Thresholds(0.7, 1, 0.7, 10)
    strict = {r.z for r in correct.correct(m, loose, every=True).collect() if r.noise}
    wide = {r.z for r in correct.correct(m, loose, every=False).collect() if r.noise}
    assert strict <= wide
    with pytest.warns(UserWarning):
        correct.CONSERVATIVE.check(3, 7)


# --- components ---


def flood(mask):
    out, n = np.zeros(mask.shape, int), 0
    for start in zip(*np.nonzero(mask), strict=True):
        if out[start]:
            continue
        n += 1
        todo = [start]
        out[start] = n
        while todo:
            y, x = todo.pop()
            for v in range(max(0, y - 1), min(mask.shape[0], y + 2)):
                for u in range(max(0, x - 1), min(mask.shape[1], x + 2)):
                    if mask[v, u] and not out[v, u]:
                        out[v, u] = n
                        todo.append((v, u))
    return out


def test_components_equal_flood_fill():
    r = np.random.default_rng(3)
    for shape in ((1, 1), (1, 7), (8, 8), (20, 33)):
        for share in (0.0, 0.3, 0.5, 0.7, 1.0):
            mask = r.random(shape) < share
            comp, size = components.label_components(mask)
            want = flood(mask)
            assert (comp == want).all()
            assert (size[mask] == np.bincount(want.ravel())[want[mask]]).all() if mask.any() else not size.any()


def test_persistence_modes(spark):
    a = np.zeros((4, 3, 5), int)
    a[:3, 0, 0] = 1  # number 1 in three slices
    a[1:4, 2, 3:] = 1  # 2, 2, then 1
    comps = components.components(from_array(spark, a, "label")).cache()
    tracked = components.persistence(comps, "tracked").first()
    assert (tracked.mean_life, tracked.max_life, tracked.n_lives) == (3.0, 3.0, 2)
    compat = components.persistence(comps).first()
    assert (compat.mean_life, compat.max_life, compat.n_lives) == (3.0, 3.0, 2)
    comps.unpersist()


# --- grey levels and filters ---


def test_norm200_and_errors(spark):
    a = np.random.default_rng(0).integers(0, 256, (2, 6, 6))
    got = to_array(intensity.norm200(from_array(spark, a, "v")), "u", a.shape)
    for z in range(2):
        s = a[z].astype(float)
        lo, hi = np.percentile(s, [0.5, 99.5])
        u = np.clip((s - lo) * 255 / (hi - lo), 0, 255).astype(int)
        band = np.bincount(u[(u >= 100) & (u <= 254)].ravel(), minlength=256)
        m = band.argmax() if band.any() else 0
        want = np.clip(u * 200 / m, 0, 255).astype(int) if m else u
        assert (got[z] == want).all()
    with pytest.raises(TypeError):
        intensity.normalise_dtype(from_array(spark, a, "v"), "int32")
    with pytest.raises(Exception, match="outside"):
        intensity.normalise_dtype(from_array(spark, a + 300, "v"), "uint8").collect()
    flat = intensity.to_uint8(from_array(spark, np.full((1, 2, 2), 9), "v"), "minmax")
    assert {r.v for r in flat.collect()} == {0}


def test_otsu_drops_flat_slices_and_takes_the_lowest(spark):
    a = np.stack([np.full((2, 3), 7), np.array([[10, 10, 50], [50, 90, 90]]), np.array([[1, 1, 1], [9, 9, 9]])])
    t = {r.z: r.t for r in otsu.thresholds(from_array(spark, a, "v"), 3).collect()}
    assert t == {1: [10, 50]}
    assert {r.z: r.t for r in otsu.thresholds(from_array(spark, a, "v"), 2).collect()} == {1: [10], 2: [1]}
    classes = to_array(otsu.segment(from_array(spark, a[1:2], "v"), 3), "class", (1, 2, 3))
    assert classes.tolist() == [[[1, 1, 2], [2, 2, 2]]]
    plain = to_array(otsu.segment(from_array(spark, a[1:2], "v"), 3, inclusive=False), "class", (1, 2, 3))
    assert plain.tolist() == [[[0, 0, 1], [1, 2, 2]]]


def test_clahe_and_preprocess(spark):
    r = np.random.default_rng(2)
    f = np.clip(r.normal(0.5, 0.05, (40, 50)), 0, 1)
    out = filters.clahe_array(f, 16, 0.02)
    assert out.shape == f.shape and 0 <= out.min() and out.max() <= 1 + 1e-9 and out.std() > f.std()
    assert np.allclose(filters.clahe_array(np.full((9, 9), 0.5), 4, 1.0), 1.0)  # one level: the running sum is full
    got = filters.preprocess(from_array(spark, (f[None] * 255).astype(int), "v"), 16, 0.02)
    assert got.agg(F.min("pre"), F.max("pre")).first()[0] >= 0 and got.count() == f.size


def test_gaussian_keeps_the_mean_and_sigma_zero(spark):
    a = np.random.default_rng(2).integers(0, 255, (1, 9, 9))
    same = to_array(filters.gaussian(from_array(spark, a, "v"), 0), "smooth", a.shape)
    assert (same == a).all()
    smooth = to_array(filters.gaussian(from_array(spark, a, "v"), 1.0), "smooth", a.shape).astype(float)
    assert abs(smooth.mean() - a.mean()) < 3 and smooth.std() < a.std()


# --- labels, regions, pairs ---


def test_label_codes(spark):
    raw = from_array(spark, np.array([0, 1, 2, 127, 254]).reshape(1, 1, 5), "label")
    assert to_array(binary.normalise_labels(raw), "label", (1, 1, 5)).tolist() == [[[0, 1, 2, 1, 2]]]
    assert to_array(binary.encode_labels(binary.normalise_labels(raw)), "label", (1, 1, 5)).tolist() == [[[0, 127, 254, 127, 254]]]
    with pytest.raises(Exception, match="unexpected label"):
        binary.normalise_labels(from_array(spark, np.full((1, 1, 1), 3), "label")).collect()
    single = from_array(spark, np.full((1, 1, 2), 1), "label")
    assert binary.pore_report(binary.collapse(single)).first().solids == 2
    with pytest.raises(Exception, match="labels are not"):
        binary.collapse(single, strict=True).collect()


def test_regions(spark):
    a = np.arange(5 * 6 * 7).reshape(5, 6, 7)
    got = to_array(roi.extract_roi(from_array(spark, a, "v"), 4, 1, 2), "v", (2, 4, 4))
    assert (got == a[1:3, 1:5, 1:5]).all()
    with pytest.raises(Exception, match="does not fit"):
        roi.centre_crop(from_array(spark, a, "v"), 7).collect()


def test_pairing(spark):
    a = spark.createDataFrame([("a_pores_1.png", 1), ("a_pores_2.png", 2), ("b.png", 3)], "name string, n long").withColumn("k", weak.slice_identifier(F.col("name")))
    b = spark.createDataFrame([("a", 1), ("c", 2)], "k string, m long")
    assert [(r.k, r.n, r.m) for r in weak.pair(a, b, "k", "name", "m").collect()] == [("a", 2, 1)]
    assert sorted((r.k, r.side) for r in weak.unmatched(a, b, "k").collect()) == [("b", "a"), ("c", "b")]


def test_weak_labels_switches(spark):
    a = np.random.default_rng(5).integers(0, 255, (1, 12, 12))
    both = from_array(spark, a, "v").join(from_array(spark, (a > 100).astype(int), "label"), KEY)
    off = weak.weak_labels(both, variance_percentile=0, gradient_percentile=0, distance=0)
    assert off.where("weak = 255").count() == 0
    some = weak.weak_labels(both, variance_percentile=90, gradient_percentile=0, distance=0)
    assert 0 < some.where("weak = 255").count() <= 15


def test_openings_of_large_balls(spark):
    """Radii of 15 and 25, and balls that overlap: those of few solid voxels, against a plain search."""
    volume = balls(spark, 128, [(39, 64, 64, 15), (89, 64, 64, 25)]).where("z between 20 and 118 and y between 34 and 94 and x between 34 and 94")
    found = {r.diameter: r.n for r in psd.diameter_histogram(opening.opening(edt.edt(volume))).collect()}
    assert found == {30: 14147, 50: 65267}
    n, solid = 26, np.array([(2, 3, 4), (20, 22, 5), (9, 13, 21), (24, 4, 19)])
    pore = np.ones((n, n, n), bool)
    pore[tuple(solid.T)] = False
    thick = opening.opening(edt.edt(from_array(spark, pore, "is_pore").withColumn("scan_id", F.lit("a"))))
    grid = np.stack(np.indices(pore.shape), -1).reshape(-1, 3)
    k = np.floor(np.sqrt(((grid[:, None] - solid) ** 2).sum(-1).min(1))).astype(int)
    want = np.zeros(len(grid), int)
    for c, r in zip(grid, k, strict=True):
        near = ((grid - c) ** 2).sum(1) <= r * r
        want[near] = np.maximum(want[near], 2 * r)
    assert k.max() > 12 and (to_array(thick, "diameter", pore.shape)[pore] == want.reshape(pore.shape)[pore]).all()


class Task:
    """A table of which whole_lines() leaves just the function that its tasks run."""

    columns, dtypes = ["scan_id", "z", "y", "x", "k", "room", "y_lo", "y_hi"], [(c, "bigint") for c in ("scan_id", "z", "y", "x", "k", "room", "y_lo", "y_hi")]

    def repartition(self, *keys):
        return self

    sortWithinPartitions = repartition

    def mapInArrow(self, run, schema):
        return run


def test_memory_of_a_task_does_not_follow_its_rows():
    """Balls of a task along y, as batches of 10,000 rows: numpy's and Arrow's peaks on four times the rows."""
    run = opening._spread(Task(), "y")

    def batches(n):
        r = np.random.default_rng(6)
        for i in range(0, n, 10_000):
            at = np.arange(i, i + 10_000)
            k = r.integers(1, 8, len(at))
            own = {"scan_id": at >> 12, "z": at >> 8 & 15, "x": at >> 4 & 15, "y": at & 15, "k": k, "room": k * k, "y_lo": 0 * at, "y_hi": 0 * at + 15}
            yield pa.RecordBatch.from_pydict({c: pa.array(own[c]) for c in Task.columns})

    def peak(n):
        held, before = 0, pa.total_allocated_bytes()
        tracemalloc.start()
        for batch in run(batches(n)):
            held = max(held, pa.total_allocated_bytes() - before)
            assert batch.num_rows
        most = tracemalloc.get_traced_memory()[1] + held
        tracemalloc.stop()
        return most

    small, large = peak(100_000), peak(400_000)
    assert large < 40e6 and large < 1.2 * small


def test_voxels_without_a_row_are_no_obstacle(spark):
    volume = balls(spark, 16, [(8, 8, 8, 5)])
    holes = opening.opening(edt.edt(volume)).where("x <> 9 and y <> 7")
    gone = opening.opening(edt.edt(volume).where("(x <> 9 and y <> 7) or (x = 8 and y = 8 and z = 8)")).where("y <> 7 and x <> 9")
    assert sorted(map(tuple, holes.collect())) == sorted(map(tuple, gone.collect()))


def test_unbeaten_balls():
    place, k, room = (np.array(a) for a in ([1, 0, 0, 0, 0, 1], [3, 2, 4, 3, 4, 3], [9, 4, 1, 4, 0, 9]))
    got = opening.unbeaten(place, k, room)
    assert [*zip(*(a.tolist() for a in got), strict=True)] == [(0, 4, 1), (0, 3, 4), (1, 3, 9)]
    r = np.random.default_rng(4)
    line = np.sort(r.integers(0, 5, 40))
    at, k = r.integers(0, 12, 40), r.integers(1, 6, 40)
    low, high = np.zeros(40, int), np.full(40, 11)
    whole, parts = (opening.along(line, at, k, k * k, low, high, most) for most in (1 << 20, 1))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert all(len(a) == 0 for a in opening.along(*(a[:0] for a in (line, at, k, k, low, high))))


@pytest.mark.parametrize("weight", [1, 2.25])
def test_least_along_lines_of_every_kind(weight):
    r = np.random.default_rng(4)
    for k in range(120):
        lines, n = r.integers(1, 9), r.integers(1, 70)
        g = r.integers(0, r.choice([3, 50, 5000]), (lines, n)) ** (1 + k % 2)
        g[r.random(g.shape) < r.random()] = edt.FAR
        g = g if weight == 1 else np.where(g < edt.FAR, g * 0.7, edt.FAR)
        i = np.arange(n)
        want = np.minimum((g[:, None, :] + weight * (i[:, None] - i) ** 2).min(axis=2), edt.FAR)
        got = np.minimum(edt.least_along(g, weight), edt.FAR)
        assert (got == want).all() if weight == 1 else np.allclose(got, want, rtol=1e-12)
        near = (g < edt.FAR).any(axis=1)
        assert np.allclose(edt.lower_envelope(g[near], weight), want[near], rtol=0 if weight == 1 else 1e-12)


def test_one_far_cell_costs_one_line():
    import time

    g = np.random.default_rng(5).integers(0, 20, (1000, 2000))
    seconds = []
    for far in (False, True):
        g[0] = edt.FAR if far else 3
        g[0, 0] = 0
        start = time.process_time()
        edt.least_along(g)
        seconds.append(time.process_time() - start)
    assert seconds[1] < 20 * seconds[0] + 1  # once a hundred times


def test_distances_of_long_lines_and_scans_without_solid(spark):
    r = np.random.default_rng(6)
    cells = {(s, z, y, x): bool(r.random() < 0.997) or s == 2 for s in (1, 2) for z in range(3) for y in range(12) for x in range(90)}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()], "scan_id long, z long, y long, x long, is_pore boolean")
    solid = np.array([k[1:] for k, v in cells.items() if k[0] == 1 and not v])
    got = {(row.scan_id, row.z, row.y, row.x): row.edt2 for row in edt.edt(df).collect()}
    for k, v in got.items():
        assert v == (None if k[0] == 2 else int(((solid - k[1:]) ** 2).sum(axis=1).min()))
    assert got.keys() == cells.keys()
