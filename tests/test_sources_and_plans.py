"""Codecs, stacks, tables, configuration, the pipeline, and the registered queries against their SQL."""

import datetime

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stackgrain.operators import intensity
from stackgrain.plans import catalogue, config, pipeline
from stackgrain.sources import codecs, psd_table, stack
from stackgrain.streaming.slices import segment_stream

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
def test_png_round_trip(kind):
    a = np.random.default_rng(0).integers(0, np.iinfo(kind).max, (5, 7), kind, endpoint=True)
    assert (codecs.png_decode(codecs.png_encode(a)) == a).all()


def test_png_filters():
    import struct
    import zlib

    a = np.random.default_rng(1).integers(0, 256, (6, 8), np.uint8)
    rows, above = [], np.zeros(8, int)
    for y, line in enumerate(a.astype(int)):
        kind, left = y % 5, np.concatenate(([0], line[:-1]))
        corner = np.concatenate(([0], above[:-1]))
        by = left + above - corner
        d = np.stack([abs(by - left), abs(by - above), abs(by - corner)])
        paeth = np.choose(d.argmin(axis=0), [left, above, corner])
        guess = [0, left, above, (left + above) // 2, paeth][kind]
        rows.append(bytes([kind]) + ((line - guess) & 255).astype(np.uint8).tobytes())
        above = line
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + b"\0\0\0\0"
    data = codecs.PNG_SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", 8, 6, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")
    assert (codecs.decode(data) == a).all()


@pytest.mark.parametrize("kind", [np.uint8, np.uint16, np.float32])
@pytest.mark.parametrize("compress", [True, False])
def test_tiff_round_trip(kind, compress):
    pages = [(np.random.default_rng(i).random((4, 6 + i)) * 200).astype(kind) for i in range(3)]
    back = codecs.tiff_pages(codecs.tiff_encode(pages, compress))
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(pages, back, strict=True))
    with pytest.raises(TypeError):
        codecs.tiff_encode(np.zeros((2, 2), np.int64))


def test_npy_and_unknown():
    a = np.arange(24).reshape(2, 3, 4) > 5
    assert (codecs.decode(codecs.npy_encode(a)) == a).all()
    with pytest.raises(ValueError):
        codecs.decode(b"something else")


def volume(spark, a, scan="s"):
    return spark.createDataFrame([(scan, *map(int, i), int(a[i])) for i in np.ndindex(a.shape)], "scan_id string, z long, y long, x long, v long")


def test_stack_round_trip(spark, tmp_path):
    a = np.random.default_rng(3).integers(0, 256, (3, 4, 5))
    files = stack.slices_of(volume(spark, a), "v")
    place = str(tmp_path / "scan7")
    stack.write_slices(files, place)
    (tmp_path / "scan7" / "slice_999999.png").write_bytes(b"broken")
    (tmp_path / "scan7" / "notes.txt").write_text("no slice")
    slices = stack.read_stack(spark, place, ("png",))
    assert slices.count() == 4 and slices.where("problem is not null").count() == 1
    got = stack.voxels(slices)
    assert {r.scan_id for r in got.select("scan_id").distinct().collect()} == {"scan7"}
    assert all(a[r.z, r.y, r.x] == r.v for r in got.collect()) and got.count() == a.size
    numbered = stack.list_slices(spark, place, ("png",), number=r"slice_0*(\d+)\.png$")
    assert {r.z for r in numbered.collect()} >= {1, 2, 999999}
    assert stack.pending(slices, slices.where("z > 0")).count() == 1
    with pytest.raises(FileNotFoundError):
        stack.list_slices(spark, place, ("tif",))


def test_psd_tables(spark, tmp_path):
    df = spark.createDataFrame([("s", 0, 1.25, 18.75, 3, 0.5, 0.1, False), ("s", 1, 6.0, 90.0, 3, 1.0, 0.1, True)], psd_table.SCHEMA)
    psd_table.save(df, str(tmp_path), ["CSV", "json", "parquet"], {"date": datetime.date(2026, 2, 3), "tags": {"b", "a"}})
    for f in psd_table.FORMATS:
        back, meta = psd_table.load(spark, str(tmp_path), f)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
        assert meta == {"date": "2026-02-03", "tags": ["a", "b"]}
    assert [r.Diameter_um for r in psd_table.comparable(df).collect()] == [90.0]
    with pytest.raises(ValueError):
        psd_table.comparable(df.drop("is_reliable"))
    with pytest.raises(ValueError):
        psd_table.formats("xml")


RAW = {
    "scan_dir": "/scans/one/",
    "stages": {
        "preprocessing": {"enabled": False},
        "segmentation": {"n_classes": 3},
        "z_stability": {"definition": {"windows": {"short": 3, "long": 7}, "target_class": 1, "thresholds": {
            "conservative": {"min_short_frequency": 0.6, "max_flip_rate": 1, "min_long_frequency": 0.3, "min_component_size": 10},
            "aggressive": {"min_short_frequency": 0.4, "max_flip_rate": 1, "min_long_frequency": 0.2, "min_component_size": 5}}}},
        "binary_builder": {"mask_variant": "aggressive"},
        "psd": {"image_params": {"voxel_spacing": [15, 15, 15]}, "output_settings": {"export_formats": "json"}},
    },
}


def test_config(monkeypatch, tmp_path):
    c = config.parse(RAW)
    assert (c.scan_id, c.spacing, c.formats, c.short) == ("one", (15.0, 15.0, 15.0), ("json",), 3)
    for broken in ({}, {"stages": {}}, config.merge(RAW, {"stages": {"segmentation": {"method": "other"}}}), config.merge(RAW, {"stages": {"z_stability": {"definition": {"windows": {"short": 3}}}}}) | {"scan_dir": ""}):
        with pytest.raises(config.ConfigError):
            config.parse(broken)
    with pytest.warns(UserWarning, match="unknown key"):
        config.parse(config.merge(RAW, {"stages": {"psd": {"min_radius_um": 1}}}))
    file = tmp_path / "c.json"
    file.write_text('{"a": {"b": 1, "c": 2}}')
    monkeypatch.setenv("STACKGRAIN_CONFIG", '{"a": {"b": 3}}')
    assert config.load(str(file)) == {"a": {"b": 3, "c": 2}}


def test_pipeline_and_resume(spark, tmp_path):
    r = np.random.default_rng(4)
    gray = volume(spark, r.integers(0, 256, (5, 8, 8)))
    c = config.parse(RAW)
    out = pipeline.run(spark, c, str(tmp_path), gray)
    assert set(out) == {"gray", "labels", "stability", "binary", "psd"}
    n = out["binary"].count()
    assert n == 320 and out["stability"].where("aggressive not in (0, 1, 2)").count() == 0
    assert out["psd"].agg(F.max("Cumulative_Porosity")).first()[0] in (None, 1.0)
    stamp = sorted(p.stat().st_mtime_ns for p in tmp_path.rglob("binary-*/part-*"))
    pipeline.run(spark, c, str(tmp_path), gray)
    assert sorted(p.stat().st_mtime_ns for p in tmp_path.rglob("binary-*/part-*")) == stamp


def test_a_stage_goes_on_where_it_was_stopped(spark, tmp_path, monkeypatch):
    gray = volume(spark, np.random.default_rng(4).integers(0, 256, (12, 8, 8)))
    whole = pipeline.run(spark, config.parse(RAW), str(tmp_path / "whole"), gray, until="labels")["labels"]
    c = config.parse(config.merge(RAW, {"stages": {"preprocessing": {"slices_per_commit": 3}}}))
    real, calls = pipeline.segment_volume, []

    def breaks(read, config):
        calls.append(read.select("z").distinct().count())
        if len(calls) == 3:
            raise RuntimeError("stopped")
        return real(read, config)

    monkeypatch.setattr(pipeline, "segment_volume", breaks)
    with pytest.raises(RuntimeError, match="stopped"):
        pipeline.run(spark, c, str(tmp_path / "parts"), gray, until="labels")
    made = {p: p.stat().st_mtime_ns for p in tmp_path.glob("parts/*/labels-*/parts/*/part-*")}
    (folder,) = tmp_path.glob("parts/*/labels-*")
    (folder / "parts" / "lost").mkdir()  # written, but not named before the run ended
    spark.range(3).write.mode("overwrite").parquet(str(folder / "parts" / "lost"))
    before = calls[:2]
    out = pipeline.run(spark, c, str(tmp_path / "parts"), gray, until="labels")["labels"]
    assert sum(before) + sum(calls[3:]) == 12 and sum(calls[3:]) < 12
    assert sorted(map(tuple, out.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    assert all(p.stat().st_mtime_ns == t for p, t in made.items()) and made
    n = len(calls)
    pipeline.run(spark, c, str(tmp_path / "parts"), gray, until="labels")
    assert len(calls) == n  # all there
    more = volume(spark, np.random.default_rng(4).integers(0, 256, (12, 8, 8))).unionByName(volume(spark, np.ones((1, 8, 8), int), "t"))
    store = pipeline.Store(spark, str(tmp_path / "more"), c)
    first = store.by_units("x", (), gray, lambda df: df, ["scan_id", "z"], 5)
    again = pipeline.Store(spark, str(tmp_path / "more"), c).by_units("x", (), more, lambda df: df, ["scan_id", "z"], 5)
    assert first.count() == 12 * 64 and again.count() == 13 * 64
    none = pipeline.Store(spark, str(tmp_path / "none"), c).by_units("x", (), gray.where("false"), lambda df: df, ["scan_id", "z"], 5)
    assert none.count() == 0 and none.columns == gray.columns


def blob(side=12):
    """A dark ball in a bright block, with some noise, as fractions."""
    z, y, x = np.indices((side,) * 3)
    f = np.where((z - 6) ** 2 + (y - 6) ** 2 + (x - 6) ** 2 <= 9, 0.2, 0.7)
    return np.clip(f + np.random.default_rng(8).normal(0, 0.02, f.shape), 0, 1)


@pytest.mark.parametrize("kind", ["uint16 slices", "npy volume", "npy by ranges", "tiff pages", "two files of pages"])
@pytest.mark.parametrize("preprocessing", [True, False])
def test_files_to_distribution(spark, tmp_path, kind, preprocessing):
    a = (blob() * 65535).astype(np.uint16)
    place = tmp_path / "scan"
    place.mkdir()
    if kind == "uint16 slices":
        for z, page in enumerate(a):
            (place / f"s{z:03d}.png").write_bytes(codecs.png_encode(page))
    elif kind.startswith("npy"):
        (place / "volume.npy").write_bytes(codecs.npy_encode(a))
    else:
        cut = 12 if kind == "tiff pages" else 5
        (place / "a.tif").write_bytes(codecs.tiff_encode([*a[:cut]]))
        if cut < 12:
            (place / "b.tif").write_bytes(codecs.tiff_encode([*a[cut:]]))
    stages = {"preprocessing": {"enabled": preprocessing, "by_ranges": "ranges" in kind}, "segmentation": {"n_classes": 2}, "z_stability": {"enabled": False}, "binary_builder": {"mask_variant": "original"}}
    c = config.parse({"scan_dir": str(place), "stages": RAW["stages"] | stages})
    out = pipeline.run(spark, c, str(tmp_path / "out"))
    assert set(out) == set(pipeline.planned(c))
    got = {(r.z, r.y, r.x): r.v for r in out["gray"].collect()}
    assert got == {i: int(a[i]) for i in np.ndindex(a.shape)}
    assert out["psd"].agg(F.sum("Volume_Count")).first()[0] > 50
    if not preprocessing:
        pores = {(r.z, r.y, r.x) for r in out["binary"].where("is_pore").collect()}
        ball = {tuple(i) for i in np.argwhere(blob() < 0.45).tolist()}
        assert len(ball & pores) > 0.8 * len(ball)  # a value equal to a threshold goes up


def test_stages_alone_fallback_and_export(spark, tmp_path):
    gray = volume(spark, np.random.default_rng(6).integers(0, 256, (3, 8, 8)))
    raw = config.merge(RAW, {"stages": {"z_stability": {"enabled": False}}})
    c = config.parse(raw)
    assert [*pipeline.run(spark, c, str(tmp_path / "out"), gray, until="labels")] == ["gray", "labels"]
    with pytest.raises(ValueError, match="no stage"):
        pipeline.run(spark, c, str(tmp_path / "out"), gray, until="stability")
    with pytest.warns(UserWarning, match="replaced by those of the segmentation"):
        out = pipeline.run(spark, c, str(tmp_path / "out"), gray, until="binary")
    place = tmp_path / "files"
    made = pipeline.export(out, str(place))
    assert made == ["classmap", "mask0", "mask01", "binary_pores", "binary_solids"] and all(len([*(place / m).iterdir()]) == 3 for m in made)
    read = lambda m: {(r.z, r.y, r.x): int(r.v) for r in stack.voxels(stack.read_stack(spark, str(place / m), ("png",))).collect()}
    labels = {(r.z, r.y, r.x): r.label for r in out["labels"].collect()}
    assert read("classmap") == labels
    pores, solids = read("binary_pores"), read("binary_solids")
    assert pores == {k: 255 * (v == 0) for k, v in labels.items()} == read("mask0") and all(pores[k] + solids[k] == 255 for k in pores)
    pipeline.export(out, str(tmp_path / "volumes"), volumes="npy")
    (whole,) = (np.load(f) for f in (tmp_path / "volumes" / "classmap").iterdir())
    assert {i: int(whole[i]) for i in np.ndindex(whole.shape)} == labels and whole.dtype == np.uint8
    first = place / "mask0" / "slice_000000_mask0.png"
    first.write_bytes(b"kept")
    pipeline.export(out, str(place))
    assert first.read_bytes() == b"kept"
    pipeline.export(out, str(place), overwrite=True)
    assert first.read_bytes() != b"kept"


def test_folders_and_conversion(spark, tmp_path):
    a = np.random.default_rng(9).integers(0, 256, (2, 3, 4)).astype(np.uint8)
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.tif").write_bytes(codecs.tiff_encode([*a]))
        (tmp_path / name / "b.tif").write_bytes(codecs.tiff_encode(a[0].astype(np.uint16)))
    slices = stack.read_stack(spark, [str(tmp_path / n) for n in ("one", "two", "one/")])
    assert slices.groupBy("scan_id").count().collect() and {(r.scan_id, r.z) for r in slices.collect()} == {(s, z) for s in ("one", "two") for z in range(3)}
    files = {(r.scan_id, r.name): codecs.slices(r.content) for r in stack.grey8_as_png(slices).collect()}
    assert {n for _, n in files} == {"a_0000.png", "a_0001.png"} and len(files) == 4
    assert all(np.array_equal([*v][0], a[int(n[2:6])]) for (_, n), v in files.items())


def test_shades_and_finite(spark):
    nan = float("nan")
    df = spark.createDataFrame([("s", 0, 2.0), ("s", 1, 4.0), ("s", 2, 3.0), ("s", 3, nan), ("s", 4, None), ("t", 0, 5.0)], "scan_id string, x int, v double")
    got = lambda d, c: [r[0] for r in d.orderBy("scan_id", "x").select(c).collect()]
    assert got(intensity.shades(df, "v"), "shade") == [0, 255, 127, None, None, 0]
    assert got(intensity.shades(df, "v", 0, 3), "shade") == [170, 255, 255, None, None, 255]
    assert got(intensity.finite(df, 0, 3.5), "v") == [2.0, 3.5, 3.0, 0.0, 0.0, 3.5]
    assert intensity.shades(df.limit(0), "v").count() == 0


def test_damaged_slices_stop_the_pipeline(spark, tmp_path):
    place = tmp_path / "scan"
    place.mkdir()
    for z, page in enumerate((blob() * 255).astype(np.uint8)):
        (place / f"s{z:03d}.png").write_bytes(codecs.png_encode(page))
    (place / "s999.png").write_bytes(b"broken")
    raw = config.merge(RAW, {"scan_dir": str(place)})
    with pytest.raises(ValueError, match="1 slices cannot be read"):
        pipeline.run(spark, config.parse(raw), str(tmp_path / "out"))
    raw = config.merge(raw, {"stages": {"preprocessing": {"skip_damaged": True}}})
    assert pipeline.run(spark, config.parse(raw), str(tmp_path / "out"))["gray"].count() == 12**3


def test_peaks_of_plateaus(spark):
    from stackgrain.operators import psd

    counts = [5, 1, 4, 4, 4, 2, 3, 3, 7, 0, 6, 6, 1, 9]
    df = spark.createDataFrame([("s", i, n) for i, n in enumerate(counts)], "scan_id string, bin long, Volume_Count long")
    assert sorted(r.bin for r in psd.peaks(df).collect()) == [3, 8, 10]
    assert sorted(r.bin for r in psd.peaks(df, 5).collect()) == [8, 10]


def test_streaming_segmentation(spark, tmp_path):
    gray = volume(spark, np.random.default_rng(6).integers(0, 256, (4, 6, 6)))
    gray.repartition(4, "z").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(gray.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    segment_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    from stackgrain.operators import otsu

    want = otsu.segment(gray)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_contrast_of_a_slice_larger_than_a_tile():
    from stackgrain.operators import filters

    a = np.random.default_rng(5).integers(0, 256, (70, 130))
    tile, clip = 61, 0.01
    maps = {}
    for i in range(2):
        for j in range(3):
            own = a[i * tile : (i + 1) * tile, j * tile : (j + 1) * tile]
            hist = [int((own == v).sum()) for v in range(256)]
            limit = max(1.0, clip * own.size)
            spare = sum(max(0, n - limit) for n in hist) / 256
            maps[i, j] = np.cumsum([min(n, limit) + spare for n in hist]) / own.size
    got = filters.clahe_array(a / 255.0, tile, clip)
    for y, x in ((0, 0), (30, 30), (31, 92), (69, 129), (60, 61), (45, 110)):
        ay, ax = (y + 0.5) / tile - 0.5, (x + 0.5) / tile - 0.5
        want = 0
        for i, wy in ((int(np.floor(ay)), 1 - ay % 1), (int(np.floor(ay)) + 1, ay % 1)):
            for j, wx in ((int(np.floor(ax)), 1 - ax % 1), (int(np.floor(ax)) + 1, ax % 1)):
                want += wy * wx * maps[min(max(i, 0), 1), min(max(j, 0), 2)][a[y, x]]
        assert abs(got[y, x] - want) < 1e-12


@pytest.mark.parametrize("name", [*catalogue.QUERIES])
def test_query_equals_its_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    assert len(got)
    if name in catalogue.ORACLE_SQL:
        want = duck.sql(catalogue.ORACLE_SQL[name]).df()
        columns = sorted(got.columns)
        assert sorted(want.columns) == columns
        a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
        pd.testing.assert_frame_equal(a, b, rtol=0, atol=1e-9)
