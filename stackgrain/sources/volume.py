"""Volumes in one file, NPY or TIFF: read by ranges of slices, and written from many tasks.

Reading (source ``volume_slices``): each task gets a range of bytes of an NPY file or of pages of a TIFF and opens the
file there, so a file may be larger than what a row or a task holds. A range of z, given as options or as a filter on z
(pushed down where spark.sql.python.filterPushdown.enabled is set), leaves out the tasks and the bytes of other slices.
Files are opened through pyarrow's file systems (local and mounted folders, hdfs, s3, gs); for a store that only
Spark's readers know use stack.read_stack, which takes whole files.

Writing (sink ``file_pieces``): sizes come first, a running sum over them gives each slice's place, and each task then
puts its slices into a file that grows under a temporary name. Equal bytes go to equal places, so a task that is run again,
or twice at once, does no harm. The commit counts the pieces that arrived and gives each whole file its name; otherwise there is none. A
folder that all executors have mounted is needed, as for stack.write_slices.
"""

from __future__ import annotations

import ast
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)

from . import tiff
from .stack import SLICES

KINDS = (".npy", ".tif", ".tiff")
FIELDS = [x.split()[0] for x in SLICES.split(", ")]
SCHEMA = pa.schema(list(zip(FIELDS, [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()], strict=True)))


@dataclass
class Part(InputPartition):
    """A range of slices of one file. NPY: slices from `first` on, at `places[0]` and so on by their size; TIFF: pages
    whose directories are at `places`."""

    file: str
    scan: str
    z: int
    places: list[int]
    dtype: str = ""
    shape: tuple[int, int] = (0, 0)
    problem: str = ""


def npy_layout(read: tiff.Read) -> tuple[int, np.dtype, tuple[int, int, int]]:
    """(place of the data, kind of values, shape as z, y, x) of a NPY file, from its header."""
    head = read(0, 12)
    if head[:6] != b"\x93NUMPY":
        raise ValueError("not a NPY file")
    wide = head[6] > 1
    (size,) = struct.unpack_from("<I" if wide else "<H", head, 8)
    start = (12 if wide else 10) + size
    own = ast.literal_eval(read(start - size, size).decode("utf-8" if head[6] > 2 else "latin1"))
    kind = np.dtype(own["descr"])
    if own["fortran_order"] and len(own["shape"]) > 1 or kind.hasobject:
        raise ValueError("slices of this NPY file do not lie one after another")
    if len(own["shape"]) not in (2, 3):
        raise ValueError(f"a volume of {len(own['shape'])} dimensions")
    return start, kind, (1, *own["shape"])[-3:]


def _opened(file: str) -> tuple[pa.NativeFile, tiff.Read]:
    system, path = fs.FileSystem.from_uri(file)
    f = system.open_input_file(path)
    return f, lambda at, n: f.read_at(n, at)


def files_of(paths: list[str]) -> list[str]:
    """URIs of the NPY and TIFF files that the paths name or hold, each folder's in order of their names."""
    found = []
    for p in paths:
        system, path = fs.FileSystem.from_uri(p if "://" in p else f"file://{os.path.abspath(p)}")
        info = system.get_file_info(path)
        if info.type == fs.FileType.Directory:
            own = sorted(x.path for x in system.get_file_info(fs.FileSelector(path)) if x.type == fs.FileType.File and x.path.lower().endswith(KINDS))
        else:
            own = [path] if info.type == fs.FileType.File else []
        start = p[: len(p) - len(path)] if "://" in p and p.endswith(path) else f"{system.type_name.replace('local', 'file')}://"
        found += [start + x for x in own]
    if not found:
        raise FileNotFoundError(f"no volumes in {paths}")
    return found


def parts_of(files: list[str], size: int, low: int | None, high: int | None, alone: bool = False) -> Iterator[Part]:
    """Ranges of slices of about `size` bytes whose z lies in low..high. z counts on over the files of a folder, or from 0
    in each file that is a scan of its own (alone)."""
    z, before = 0, ""
    for file in files:
        folder, _, name = file.rpartition("/")
        scan = name.rpartition(".")[0] if alone else folder.rpartition("/")[2]
        z, before = (z if folder == before and not alone else 0), folder
        try:
            opened, read = _opened(file)
            with opened:
                if file.lower().endswith(".npy"):
                    start, kind, (n, height, width) = npy_layout(read)
                    one, dtype, shape = kind.itemsize * height * width, kind.str, (height, width)
                    places = range(start, start + n * one, one) if one else [start] * n
                else:
                    order, big, _ = tiff.header(read)
                    places, dtype, shape = list(tiff.directories(read)), "", (0, 0)
                    tags = tiff.tags_at(read, places[0], order, big)
                    one = tags[tiff.HEIGHT][0] * tags[tiff.WIDTH][0] * max(1, tags.get(tiff.BITS, (1,))[0] // 8) * tags.get(tiff.SAMPLES, (1,))[0]
        except (ValueError, KeyError, IndexError, SyntaxError, OSError, struct.error) as e:
            if (low is None or z >= low) and (high is None or z <= high):
                yield Part(file, scan, z, [0], problem=f"{type(e).__name__}: {e}")
            z += 1
            continue
        n = len(places)
        first, end = max(0, (low or 0) - z) if low is not None else 0, n if high is None else min(n, high - z + 1)
        step = max(1, size // max(1, one))
        for k in range(first, end, step):
            yield Part(file, scan, z + k, list(places[k : min(end, k + step)]), dtype, shape)
        z += n


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = options["path"].split("\n")
        self.size = int(options.get("bytesPerTask", 64 << 20))
        self.low, self.high = (int(options[k]) if k in options else None for k in ("zFrom", "zTo"))
        self.channel, self.alone = options.get("channel", "first"), options.get("perFile", "false") == "true"

    def partitions(self) -> list[Part]:
        return list(parts_of(files_of(self.files), self.size, self.low, self.high, self.alone)) or [Part("", "", 0, [])]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if part.problem:
            yield _slice_row(part, part.z, None, part.problem)
        if part.problem or not part.places:
            return
        opened, read = _opened(part.file)
        with opened:
            order, big, _ = ("", False, 0) if part.dtype else tiff.header(read)
            for k, place in enumerate(part.places):
                try:
                    if part.dtype:
                        kind, (h, w) = np.dtype(part.dtype), part.shape
                        a = np.frombuffer(read(place, kind.itemsize * h * w), kind).reshape(h, w)
                    else:
                        a = tiff.page(read, place, order, big)
                    if a.ndim == 3:
                        a = a[:, :, 0] if self.channel == "first" else np.rint(a.mean(axis=2)).astype(a.dtype)
                    yield _slice_row(part, part.z + k, a.astype(np.uint8) if a.dtype == np.bool_ else a, None)
                except (ValueError, TypeError, KeyError, IndexError, struct.error) as e:
                    yield _slice_row(part, part.z + k, None, f"{type(e).__name__}: {e}")


class _PrunedReader(_Reader):
    """Spark refuses a source that takes filters while their pushdown is off, so this is a class of its own."""

    def pushFilters(self, filters):
        """Limits on z are kept to exactly; all others are Spark's."""
        for f in filters:
            own = isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute == ("z",)
            if not own or not isinstance(f.value, int):
                yield f
                continue
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.low = max(f.value + isinstance(f, GreaterThan), f.value if self.low is None else self.low)
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.high = min(f.value - isinstance(f, LessThan), f.value if self.high is None else self.high)


def _slice_row(part: Part, z: int, a: np.ndarray | None, problem: str | None) -> pa.RecordBatch:
    own = [None] * 4 if a is None else [*a.shape, a.dtype.newbyteorder("=").name, np.ascontiguousarray(a, a.dtype.newbyteorder("<")).tobytes()]
    return pa.RecordBatch.from_pylist([dict(zip(FIELDS, (part.scan, z, part.file, *own, problem), strict=True))], schema=SCHEMA)


class VolumeSlices(DataSource):
    @classmethod
    def name(cls) -> str:
        return "volume_slices"

    def schema(self) -> str:
        return SLICES

    def reader(self, schema) -> _Reader:
        return (_PrunedReader if self.options.get("pushdown") == "true" else _Reader)(self.options)


def read_volumes(spark: SparkSession, path: str | list[str], z_from: int | None = None, z_to: int | None = None, bytes_per_task: int = 64 << 20, channel: str = "first", per_file: bool = False) -> DataFrame:
    """Slices z_from..z_to (both included) of the volumes of files or folders, in the columns of stack.read_stack.

    scan_id is the folder's name, z counts on over its files in the order of their names; with per_file each file is a scan
    named by its stem, as write_volumes leaves them. A file or page that cannot be
    decoded is a row with a problem and no data; a file whose header cannot be read counts as one slice."""
    spark.dataSource.register(VolumeSlices)
    paths = [path] if isinstance(path, str) else list(dict.fromkeys(path))
    # Several paths go into one option, a line each.
    read = spark.read.format("volume_slices").option("path", "\n".join(paths)).option("bytesPerTask", bytes_per_task).option("channel", channel).option("perFile", str(per_file).lower())
    read = read.option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    for name, limit in (("zFrom", z_from), ("zTo", z_to)):
        read = read if limit is None else read.option(name, limit)
    return read.load()


# --- writing ---


def planes(df: DataFrame, value: str, dtype: str = "uint8") -> DataFrame:
    """(scan_id, z, height, width, dtype, data): voxels gathered slice by slice; missing ones are 0."""
    kind = dict(df.dtypes)["scan_id"]

    def run(t: pa.Table) -> pa.Table:
        y, x = t.column("y").to_numpy(), t.column("x").to_numpy()
        a = np.zeros((y.max() + 1, x.max() + 1), np.dtype(dtype).newbyteorder("<"))
        a[y, x] = t.column(value).to_numpy()
        one = {"scan_id": t.column("scan_id")[:1], "z": t.column("z")[:1], "height": pa.array([a.shape[0]]), "width": pa.array([a.shape[1]])}
        return pa.table(one | {"dtype": [dtype], "data": pa.array([a.tobytes()], pa.binary())})

    own = df.select("scan_id", F.col("z").cast("long").alias("z"), "y", "x", value)
    return own.groupBy("scan_id", "z").applyInArrow(run, f"scan_id {kind}, z long, height long, width long, dtype string, data binary")


def _checked(slices: DataFrame) -> DataFrame:
    """(scan_id, n, first, height, width, dtype) of scans whose slices are complete and alike; others fail the query."""
    per = slices.groupBy("scan_id").agg(
        F.count("*").alias("n"), F.min("z").alias("first"), F.max("z").alias("last"), F.countDistinct("z").alias("levels"), F.countDistinct("height", "width", "dtype").alias("kinds"),
        F.min("height").alias("height"), F.min("width").alias("width"), F.min("dtype").alias("dtype"), F.count("dtype").alias("good"),
    )
    fine = (F.col("n") == F.col("last") - F.col("first") + 1) & (F.col("levels") == F.col("n")) & (F.col("kinds") == 1) & (F.col("good") == F.col("n"))
    wrong = F.raise_error(F.format_string("scan %s: slices are missing, repeated, damaged or of several kinds", F.col("scan_id"))).cast("long")
    return per.withColumn("n", F.when(fine, F.col("n")).otherwise(wrong)).drop("last", "levels", "kinds", "good")


def npy_pieces(slices: DataFrame) -> DataFrame:
    """(name, offset, content, total): each scan as one NPY file ``<scan_id>.npy`` of (z, y, x), slice by slice."""

    def head(n, height, width, dtype) -> bytes:
        own = f"{{'descr': '{np.dtype(dtype).newbyteorder('<').str}', 'fortran_order': False, 'shape': ({n}, {height}, {width}), }}"
        own = own.ljust(-(-(len(own) + 11) // 64) * 64 - 11) + "\n"
        return b"\x93NUMPY\x01\x00" + struct.pack("<H", len(own)) + own.encode("latin1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [head(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("n", "height", "width", "dtype")), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, pa.binary())], names=[*batch.schema.names, "head"])

    per = _checked(slices)
    per = per.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in per.dtypes) + ", head binary")
    name = F.concat(F.col("scan_id").cast("string"), F.lit(".npy")).alias("name")
    # Joined by slice, not by scan, so that one large scan is dealt to many tasks.
    at = slices.select("scan_id", "z").join(per, "scan_id").select(
        "scan_id", "z", name, (F.octet_length("head") + (F.col("z") - F.col("first")) * F.col("height") * F.col("width") * _width_of("dtype")).alias("offset"),
        (F.octet_length("head") + F.col("n") * F.col("height") * F.col("width") * _width_of("dtype")).alias("total"),
    )
    body = slices.select("scan_id", "z", F.col("data").alias("content")).join(at, ["scan_id", "z"])
    first = per.select(name, F.lit(0).cast("long").alias("offset"), F.col("head").alias("content"), (F.octet_length("head") + F.col("n") * F.col("height") * F.col("width") * _width_of("dtype")).alias("total"))
    return body.select("name", "offset", "content", "total").unionByName(first)


def _width_of(column: str):
    """Bytes of a value by the name of its kind."""
    bits = F.coalesce(F.nullif(F.regexp_extract(column, r"(\d+)$", 1), F.lit("")).cast("long"), F.lit(8))
    return (bits / 8).cast("long")


def tiff_pieces(slices: DataFrame, compress: bool = True, big: bool = False) -> DataFrame:
    """(name, offset, content, total): each scan as one TIFF ``<scan_id>.tif``, a page a slice. big: as BigTIFF; a classic
    file beyond four gigabytes fails.

    Pages are compressed once for their sizes and once for their bytes, so that only sizes are sorted and kept."""
    kind = dict(slices.dtypes)["scan_id"]
    room = len(tiff.directory((0, 0), np.dtype("u1"), 0, 0, compress, 0, big))
    begin = len(tiff.start_of_file(0, big))

    def strip(row: dict) -> bytes:
        return tiff.strip_of(np.frombuffer(row["data"], np.dtype(row["dtype"]).newbyteorder("<")).astype(row["dtype"]).reshape(row["height"], row["width"]), compress)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(strip(r)) for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("scan_id"), batch.column("z"), pa.array(sizes, pa.int64())], names=["scan_id", "z", "size"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (r,) = batch.slice(i, 1).to_pylist()
                s = strip(r)
                after = 0 if r["next_size"] is None else r["offset"] + len(s) + len(s) % 2 + room + r["next_size"] + r["next_size"] % 2
                link = tiff.directory((r["height"], r["width"]), np.dtype(r["dtype"]), r["offset"], len(s), compress, after, big)
                content, offset = s + b"\0" * (len(s) % 2) + link, r["offset"]
                if r["first_page"]:
                    content, offset = tiff.start_of_file(r["offset"] + len(s) + len(s) % 2, big) + content, 0
                yield pa.RecordBatch.from_pydict({"name": [r["name"]], "offset": pa.array([offset], pa.int64()), "content": pa.array([content], pa.binary()), "total": pa.array([r["total"]], pa.int64())})

    own = slices.select("scan_id", "z", "height", "width", "dtype", "data")
    sizes = own.mapInArrow(measure, f"scan_id {kind}, z long, size long")
    order = Window.partitionBy("scan_id").orderBy("z")
    taken = F.col("size") + F.col("size") % 2 + room
    total = F.sum(taken).over(Window.partitionBy("scan_id")) + begin
    fits = F.when(F.lit(big) | (total < 1 << 32), total).otherwise(F.raise_error(F.lit("too large for a classic TIFF: big=True")).cast("long"))
    places = sizes.select(
        "scan_id", "z", (F.coalesce(F.sum(taken).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + begin).alias("offset"),
        F.lead("size").over(order).alias("next_size"), (F.row_number().over(order) == 1).alias("first_page"), fits.alias("total"),
        F.concat(F.col("scan_id").cast("string"), F.lit(".tif")).alias("name"),
    )
    fine = _checked(slices).where("n > 0").select("scan_id")  # n is what fails for others
    return own.join(places.join(fine, "scan_id"), ["scan_id", "z"]).mapInArrow(make, "name string, offset long, content binary, total long")


@dataclass
class _Wrote(WriterCommitMessage):
    sizes: dict[str, tuple[int, int]]  # of each file: bytes that this task wrote, bytes of the whole


class _Pieces(DataSourceArrowWriter):
    """Puts pieces at their places in files that get their names when they are whole."""

    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def _part(self, name: str) -> str:
        return os.path.join(self.path, f".{os.path.basename(name)}.{self.job}.part")

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Wrote:
        os.makedirs(self.path, exist_ok=True)
        sizes: dict[str, tuple[int, int]] = {}
        name = file = None
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    (r,) = batch.slice(i, 1).to_pylist()
                    if r["name"] != name:
                        if file is not None:
                            os.close(file)
                        name, file = r["name"], os.open(self._part(r["name"]), os.O_WRONLY | os.O_CREAT, 0o644)
                    at, content = r["offset"], memoryview(r["content"])
                    while content:
                        n = os.pwrite(file, content, at)
                        at, content = at + n, content[n:]
                    sizes[name] = (sizes.get(name, (0, 0))[0] + len(r["content"]), r["total"])
        finally:
            if file is not None:
                os.close(file)
        return _Wrote(sizes)

    def commit(self, messages: list[_Wrote | None]) -> None:
        found: dict[str, int] = {}
        total: dict[str, int] = {}
        for m in messages:
            for name, (size, whole) in (m.sizes if m else {}).items():
                found[name] = found.get(name, 0) + size
                total[name] = whole
        for name, whole in total.items():
            if found[name] != whole or os.path.getsize(self._part(name)) != whole:
                raise ValueError(f"{name}: {found[name]} of {whole} bytes were written")
        for name in total:
            os.replace(self._part(name), os.path.join(self.path, os.path.basename(name)))

    def abort(self, messages: list[_Wrote | None]) -> None:
        for name in os.listdir(self.path) if os.path.isdir(self.path) else []:
            if name.endswith(f".{self.job}.part"):
                os.remove(os.path.join(self.path, name))


class FilePieces(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_pieces"

    def schema(self) -> str:
        return "name string, offset long, content binary, total long"

    def writer(self, schema, overwrite: bool) -> _Pieces:
        return _Pieces(self.options["path"])


def write_pieces(pieces: DataFrame, path: str) -> None:
    pieces.sparkSession.dataSource.register(FilePieces)
    pieces.select("name", "offset", "content", "total").write.format("file_pieces").mode("append").option("path", path).save()


def write_volumes(slices: DataFrame, path: str, file_format: str = "npy", compress: bool = True, big: bool = False) -> None:
    """One file a scan in a mounted folder, of slices (scan_id, z, height, width, dtype, data) as read_volumes, read_stack
    or planes give them. All slices of a scan have to be there, of one shape and kind."""
    write_pieces(npy_pieces(slices) if file_format == "npy" else tiff_pieces(slices, compress, big), path)
