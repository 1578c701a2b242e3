"""Volumes in one file: TIFF variants, reading by ranges, writing from many tasks."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackgrain.operators import edt, opening, psd
from stackgrain.sources import codecs, stack, tiff, volume

from .test_sources_and_plans import blob


def lzw_encode(data):
    """TIFF's LZW by its description: clear, codes of growing width, end."""
    out, held, bits = bytearray(), 0, 0

    def put(code, width):
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
        held &= (1 << bits) - 1

    table, width, word = {bytes([i]): i for i in range(256)}, 9, b""
    put(256, 9)
    count = 258
    for b in data:
        longer = word + bytes([b])
        if longer in table:
            word = longer
            continue
        put(table[word], width)
        table[longer] = count
        count += 1
        width = 9 if count < 512 else 10 if count < 1024 else 11 if count < 2048 else 12
        if count == 4094:
            put(256, 12)
            table, width, count = {bytes([i]): i for i in range(256)}, 9, 258
        word = bytes([b])
    if word:
        put(table[word], width)
        count += 1
        width = 9 if count < 512 else 10 if count < 1024 else 11 if count < 2048 else 12
    put(257, width)
    if bits:
        put(0, 8 - bits)
    return bytes(out)


def packbits_encode(data):
    out, i = bytearray(), 0
    while i < len(data):
        j = i
        while j < len(data) and j - i < 128 and data[j] == data[i]:
            j += 1
        if j - i > 1:
            out += bytes([257 - (j - i), data[i]])
        else:
            j = i + 1
            while j < len(data) and j - i < 128 and data[j] != data[j - 1]:
                j += 1
            out += bytes([j - i - 1]) + data[i:j]
        i = j
    return bytes(out)


def build(tags, blocks, order="<", offsets=273, sizes=279):
    """A classic one-page TIFF of blocks, with tags {number: (type, values)}."""
    kinds = {1: "B", 3: "H", 4: "I"}
    body, places = bytearray(), []
    for b in blocks:
        places.append(8 + len(body))
        body += b + b"\0" * (len(b) % 2)
    tags = tags | {offsets: (4, places), sizes: (4, [len(b) for b in blocks])}
    at, entries, extra = 8 + len(body), b"", bytearray()
    start = at + 2 + 12 * len(tags) + 4
    for tag, (kind, values) in sorted(tags.items()):
        data = struct.pack(f"{order}{len(values)}{kinds[kind]}", *values)
        if len(data) > 4:
            own = struct.pack(order + "I", start + len(extra))
            extra += data
        else:
            own = data.ljust(4, b"\0")
        entries += struct.pack(order + "HHI", tag, kind, len(values)) + own
    head = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, at)
    return bytes(head + body + struct.pack(order + "H", len(tags)) + entries + struct.pack(order + "I", 0) + extra)


@pytest.mark.parametrize("how", [(1, bytes), (5, lzw_encode), (8, zlib.compress), (32773, packbits_encode)])
@pytest.mark.parametrize("tiled", [False, True])
@pytest.mark.parametrize("order", ["<", ">"])
def test_tiff_compressions_strips_and_tiles(how, tiled, order):
    a = (np.random.default_rng(2).integers(0, 40, (75, 100)) * 7 % 251).astype(np.uint16)
    a[10:40, 20:90] = 513
    code, pack = how
    tags = {256: (3, [100]), 257: (3, [75]), 258: (3, [16]), 259: (3, [code]), 262: (3, [1]), 277: (3, [1]), 284: (3, [1])}
    raw = lambda x: np.ascontiguousarray(x, a.dtype.newbyteorder(order)).tobytes()
    if tiled:
        padded = np.pad(a, ((0, 96 - 75), (0, 112 - 100)))
        blocks = [pack(raw(padded[y : y + 32, x : x + 16])) for y in range(0, 96, 32) for x in range(0, 112, 16)]
        data = build(tags | {322: (3, [16]), 323: (3, [32])}, blocks, order, 324, 325)
    else:
        data = build(tags | {278: (3, [20])}, [pack(raw(a[y : y + 20])) for y in range(0, 75, 20)], order)
    (got,) = codecs.tiff_pages(data)
    assert np.array_equal(got, a) and got.dtype == np.uint16


def test_lzw_of_long_and_plain_data():
    r = np.random.default_rng(3)
    for data in (b"", b"a", b"a" * 10_000, r.integers(0, 256, 30_000, np.uint8).tobytes(), (b"abc" * 50 + b"xyz") * 200):
        assert tiff.lzw(lzw_encode(data)) == data and tiff.packbits(packbits_encode(data)) == data


def test_palette_bits_planes_and_white_is_zero():
    a = np.random.default_rng(4).integers(0, 2, (9, 13)).astype(np.uint8)
    bits = np.packbits(a, axis=1).tobytes()
    base = {256: (3, [13]), 257: (3, [9]), 259: (3, [1]), 277: (3, [1])}
    assert np.array_equal(codecs.tiff_pages(build(base | {258: (3, [1]), 262: (3, [1])}, [bits]))[0], a)
    assert np.array_equal(codecs.tiff_pages(build(base | {258: (3, [1]), 262: (3, [0])}, [bits]))[0], 1 - a)
    shades = [i * 257 for i in range(256)] + [0] * 256 + [65535] * 256
    rgb = codecs.tiff_pages(build(base | {258: (3, [8]), 262: (3, [3]), 320: (3, shades)}, [a.tobytes()]))[0]
    assert rgb.shape == (9, 13, 3) and np.array_equal(rgb[:, :, 0], a) and (rgb[:, :, 2] == 255).all()
    planes = [a * 3, a * 5, a * 7]
    got = codecs.tiff_pages(build(base | {258: (3, [8, 8, 8]), 262: (3, [2]), 277: (3, [3]), 284: (3, [2])}, [p.tobytes() for p in planes]))[0]
    assert np.array_equal(got, np.stack(planes, axis=2))


@pytest.mark.parametrize("big", [False, True])
def test_big_tiff_round_trip(big):
    pages = [np.random.default_rng(i).integers(0, 65535, (5, 7 + i)).astype(np.uint16) for i in range(3)]
    data = tiff.encode(pages, True, big)
    assert all(np.array_equal(a, b) for a, b in zip(codecs.tiff_pages(data), pages, strict=True)) and codecs.slice_count(data) == 3
    circle = bytearray(tiff.encode(pages[:1], True, big))
    circle[-8 if big else -4 :] = circle[8:16] if big else circle[4:8]
    with pytest.raises(ValueError, match="circle"):
        codecs.tiff_pages(bytes(circle))


# --- reading ---


@pytest.fixture
def scans(tmp_path):
    """Two folders of volumes, and their arrays."""
    r, arrays = np.random.default_rng(6), {}
    for scan, kind in (("one", np.uint16), ("two", np.uint8)):
        (tmp_path / scan).mkdir()
        a = arrays[scan] = r.integers(0, 200, (11, 6, 5)).astype(kind)
        (tmp_path / scan / "a.npy").write_bytes(codecs.npy_encode(a[:4]))
        (tmp_path / scan / "b.tif").write_bytes(tiff.encode([*a[4:9]], big=scan == "two"))
        (tmp_path / scan / "c.npy").write_bytes(codecs.npy_encode(a[9:].astype(a.dtype.newbyteorder(">"))))
    return tmp_path, arrays


def test_volumes_equal_whole_files(spark, scans):
    place, _ = scans
    paths = [str(place / "one"), str(place / "two")]
    got = volume.read_volumes(spark, paths, bytes_per_task=70)
    assert got.rdd.getNumPartitions() == 11 + (2 + 3 + 1)  # a slice of the first scan has 60 bytes, one of the second 30
    want = stack.read_stack(spark, paths)
    key = ["scan_id", "z", "height", "width", "dtype", "data", "problem"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def test_only_the_range_is_read(spark, scans):
    place, arrays = scans
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        for low, high in ((2, 5), (4, 4), (8, 30), (0, 0)):
            by_option = volume.read_volumes(spark, str(place / "one"), low, high, bytes_per_task=1)
            by_filter = volume.read_volumes(spark, str(place / "one"), bytes_per_task=1).where(f"z >= {low} and z < {high + 1}")
            for df in (by_option, by_filter):
                got = {r.z: np.frombuffer(r.data, r.dtype).reshape(r.height, r.width) for r in df.collect()}
                assert sorted(got) == [*range(low, min(high, 10) + 1)] and all(np.array_equal(a, arrays["one"][z]) for z, a in got.items())
                assert df.rdd.getNumPartitions() == len(got)
        assert volume.read_volumes(spark, str(place / "one"), 50).count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_a_sparse_volume_beyond_two_gigabytes(spark, tmp_path):
    """A slice from behind the third gigabyte of a file that is mostly a hole."""
    (tmp_path / "s").mkdir()
    file, shape = tmp_path / "s" / "v.npy", (3300, 1000, 1000)
    with file.open("wb") as f:
        np.lib.format.write_array_header_1_0(f, {"descr": "|u1", "fortran_order": False, "shape": shape})
        start = f.tell()
        f.seek(start + 3200 * 1_000_000 + 5)
        f.write(b"\x07")
        f.truncate(start + 3300 * 1_000_000)
    (got,) = volume.read_volumes(spark, f"file://{file}", 3200, 3200).collect()
    assert got.z == 3200 and len(got.data) == 1_000_000 and got.data[5] == 7 and sum(got.data) == 7
    assert volume.read_volumes(spark, str(file)).rdd.getNumPartitions() == 50  # of 67 slices each


def test_files_that_are_scans(spark, scans):
    place, arrays = scans
    got = volume.read_volumes(spark, str(place / "one"), 1, 3, per_file=True)
    assert {(r.scan_id, r.z) for r in got.collect()} == {("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 3), ("c", 1)}
    assert bytes(got.where("scan_id = 'c'").first().data) == arrays["one"][10].tobytes()


def test_damaged_volumes(spark, tmp_path):
    (tmp_path / "s").mkdir()
    a = np.arange(24, dtype=np.uint8).reshape(2, 3, 4)
    (tmp_path / "s" / "a.npy").write_bytes(b"nothing")
    (tmp_path / "s" / "b.npy").write_bytes(codecs.npy_encode(a)[:-5])
    (tmp_path / "s" / "c.npy").write_bytes(codecs.npy_encode(np.asfortranarray(a)))
    (tmp_path / "s" / "d.tif").write_bytes(tiff.encode([*a])[:60])
    (tmp_path / "s" / "e.npy").write_bytes(codecs.npy_encode(a[0]))
    got = {r.z: (r.path.rsplit("/", 1)[1], r.problem) for r in volume.read_volumes(spark, str(tmp_path / "s")).collect()}
    assert {z: n for z, (n, p) in got.items() if p is None} == {1: "b.npy", 5: "e.npy"}
    assert {z: n for z, (n, p) in got.items() if p} == {0: "a.npy", 2: "b.npy", 3: "c.npy", 4: "d.tif"}
    with pytest.raises(Exception, match="no volumes"):
        volume.read_volumes(spark, str(tmp_path)).count()


def test_a_volume_to_its_distribution(spark, tmp_path):
    (tmp_path / "ball").mkdir()
    (tmp_path / "ball" / "v.npy").write_bytes(codecs.npy_encode(blob()))
    pores = stack.voxels(volume.read_volumes(spark, str(tmp_path / "ball"), bytes_per_task=3000)).select("scan_id", "z", "y", "x", (F.col("v") < 0.45).alias("is_pore"))
    opened = opening.opening(edt.edt(pores))
    want = int((blob() < 0.45).sum())
    assert opened.count() == want and psd.diameter_histogram(opened).agg(F.sum("n")).first()[0] == want


# --- writing ---


def slices_in_many_tasks(spark, arrays):
    rows = [(s, z, *p.shape, str(p.dtype), p.tobytes()) for s, a in arrays.items() for z, p in enumerate(a, 3)]
    return spark.createDataFrame(rows, "scan_id string, z long, height long, width long, dtype string, data binary").repartition(5, "z")


@pytest.mark.parametrize("kind", [np.uint8, np.uint16, np.float32])
def test_written_volumes_are_exact(spark, tmp_path, kind):
    r = np.random.default_rng(7)
    arrays = {s: (r.random((n, 4, 5)) * 200).astype(kind) for s, n in (("a", 9), ("b", 1))}
    df = slices_in_many_tasks(spark, arrays)
    for compress, big in ((True, False), (False, True)):
        place = tmp_path / f"t{big}"
        volume.write_volumes(df, str(place), "tif", compress, big)
        assert {p.name: p.read_bytes() for p in place.iterdir()} == {f"{s}.tif": tiff.encode([*a], compress, big) for s, a in arrays.items()}
    volume.write_volumes(df, str(tmp_path / "n"), "npy")
    assert {p.name: p.read_bytes() for p in (tmp_path / "n").iterdir()} == {f"{s}.npy": codecs.npy_encode(a) for s, a in arrays.items()}
    back = volume.read_volumes(spark, str(tmp_path / "n" / "a.npy"))
    assert [bytes(x.data) for x in back.orderBy("z").collect()] == [p.tobytes() for p in arrays["a"]]


def test_voxels_to_a_volume(spark, tmp_path):
    a = np.random.default_rng(1).integers(0, 9, (3, 4, 5)).astype(np.uint8)
    df = spark.createDataFrame([(7, *map(int, i), int(a[i])) for i in np.ndindex(a.shape)], "scan_id int, z int, y int, x int, v int")
    volume.write_volumes(volume.planes(df, "v"), str(tmp_path / "out"))
    assert np.array_equal(np.load(tmp_path / "out" / "7.npy"), a)


def test_incomplete_scans_are_refused(spark, tmp_path):
    df = slices_in_many_tasks(spark, {"a": np.zeros((4, 2, 3), np.uint8)})
    for wrong in (df.where("z != 5"), df.unionByName(df.where("z = 5")), df.withColumn("height", F.when(F.col("z") == 4, 1).otherwise(2).cast("long"))):
        for kind in ("npy", "tif"):
            with pytest.raises(Exception, match="missing, repeated|bytes were written|cannot reshape"):
                volume.write_volumes(wrong, str(tmp_path / "x"), kind)
    assert not [*(tmp_path / "x").iterdir()] if (tmp_path / "x").exists() else True


def test_a_task_that_fails_is_run_again(tmp_path):
    """What an attempt leaves behind half way does no harm, nor does an attempt that writes at the same time."""
    import pyarrow as pa

    a = np.random.default_rng(2).integers(0, 255, (6, 3, 4)).astype(np.uint8)
    whole = codecs.npy_encode(a)
    cuts = [0, 30, 64, 100, len(whole)]
    rows = [{"name": "v.npy", "offset": s, "content": whole[s:e], "total": len(whole)} for s, e in zip(cuts, cuts[1:], strict=False)]
    writer = volume._Pieces(str(tmp_path))

    def broken():
        yield pa.RecordBatch.from_pylist(rows[2:3])
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(broken())
    done = [writer.write(iter([pa.RecordBatch.from_pylist(rows[:2])])), writer.write(iter([pa.RecordBatch.from_pylist(rows[2:])]))]
    writer.write(iter([pa.RecordBatch.from_pylist(rows[2:])]))  # a speculative attempt, whose message is not used
    with pytest.raises(ValueError, match="bytes were written"):
        writer.commit(done[:1])
    assert not (tmp_path / "v.npy").exists()
    writer.commit(done)
    assert (tmp_path / "v.npy").read_bytes() == whole and [p.name for p in tmp_path.iterdir()] == ["v.npy"]


# --- names, overlays, folders of files ---


def test_names_of_sources_and_overlays(spark, tmp_path):
    from stackgrain.plans import config, pipeline

    from .test_sources_and_plans import RAW

    place = tmp_path / "scan"
    place.mkdir()
    a = np.random.default_rng(3).integers(0, 256, (3, 6, 7)).astype(np.uint8)
    (place / "first.png").write_bytes(codecs.png_encode(a[0]))
    (place / "pages.tif").write_bytes(tiff.encode([*a[1:]]))
    c = config.parse(RAW | {"scan_dir": str(place)})
    out = pipeline.run(spark, c, str(tmp_path / "out"), until="labels")
    made = pipeline.export(out, str(tmp_path / "files"), overlays=True, stems=stack.stems(pipeline.source_slices(spark, c)))
    assert made == ["classmap", "mask0", "mask01", "overlay_ov0", "overlay_ov01"]
    names = lambda m: sorted(p.name for p in (tmp_path / "files" / m).iterdir())
    assert names("mask0") == ["first_mask0.png", "pages_0001_mask0.png", "pages_0002_mask0.png"]
    assert names("overlay_ov01") == ["first_ov01.png", "pages_0001_ov01.png", "pages_0002_ov01.png"]
    mask = codecs.decode((tmp_path / "files" / "mask0" / "first_mask0.png").read_bytes()) > 0
    rgb = codecs.decode((tmp_path / "files" / "overlay_ov0" / "first_ov0.png").read_bytes()).astype(int)
    v = a[0].astype(float)
    assert np.array_equal(rgb[:, :, 0], np.where(mask, np.rint(v * 0.65 + 255 * 0.35), v)) and np.array_equal(rgb[:, :, 2], np.where(mask, np.rint(v * 0.65), v))


def test_region_files(spark, tmp_path):
    from stackgrain.operators import roi

    a = np.random.default_rng(3).integers(0, 60_000, (6, 8, 9))
    df = spark.createDataFrame([("s", 10 + z, y, x, int(a[z, y, x])) for z, y, x in np.ndindex(a.shape)], "scan_id string, z long, y long, x long, v long")
    files = stack.slices_of(roi.extract_roi(df, 4, 2, 1), "v", "uint16", "tif", stems=roi.roi_stems(df, 2, 1))
    stack.write_slices(files, str(tmp_path / "roi"))
    got = {p.name: codecs.decode(p.read_bytes()) for p in (tmp_path / "roi").iterdir()}
    assert sorted(got) == ["roi_0000_slice0012.tif", "roi_0001_slice0013.tif", "roi_0002_slice0014.tif"]
    top, left = 8 // 2 - 2, 9 // 2 - 2
    assert all(np.array_equal(got[n], a[2 + k, top : top + 4, left : left + 4]) and got[n].dtype == np.uint16 for k, n in enumerate(sorted(got)))


@pytest.mark.parametrize("method", ["percentile", "minmax", "divide256"])
def test_normalised_folders(spark, tmp_path, method):
    from stackgrain.plans import normalise

    r = np.random.default_rng(5)
    stacks = {"a.tif": r.normal(30_000, 4_000, (3, 20, 21)).clip(0, 65_535).astype(np.uint16), "b.tiff": r.integers(90, 250, (1, 9, 8)).astype(np.uint8),
              "c.TIF": np.zeros((2, 4, 4), np.uint16), "d.tif": r.random((2, 12, 13)).astype(np.float32)}
    if method == "divide256":
        stacks.pop("d.tif")
    (tmp_path / "in").mkdir()
    for name, a in stacks.items():
        (tmp_path / "in" / name).write_bytes(tiff.encode([*a]))
    normalise.normalise_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), method=method)
    got = {p.name: np.stack(codecs.tiff_pages(p.read_bytes())) for p in (tmp_path / "out").iterdir()}
    assert sorted(got) == sorted(f"{n.rpartition('.')[0]}_norm8.{n.rpartition('.')[2]}" for n in stacks)
    for name, a in stacks.items():
        u = a.astype(np.float64)
        if a.dtype == np.uint8:
            pass
        elif method == "divide256":
            u = np.floor(u / 256)
        else:
            lo, hi = (u.min(), u.max()) if method == "minmax" else np.round(np.percentile(u, [0.5, 99.5]), 9)
            u = np.floor(np.clip((u - lo) * 255 / (hi - lo), 0, 255)) if hi > lo else u * 0
        band = np.bincount(u.astype(int).ravel(), minlength=256)[100:255]
        mode = int(band.argmax()) + 100 if band.any() else 0
        want = np.floor(np.clip(u * 200 / mode, 0, 255)) if mode else u
        stem, _, kind = name.rpartition(".")
        assert np.abs(got[f"{stem}_norm8.{kind}"] - want).max() <= (1 if method == "percentile" else 0), name
        assert got[f"{stem}_norm8.{kind}"].dtype == np.uint8
