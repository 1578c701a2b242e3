"""Image stacks as DataFrames: folders of slices in, voxels out, and slices written back as files."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from . import codecs

EXTENSIONS = ("png", "tif", "tiff", "npy", "jpg", "jpeg", "bmp")  # what the codecs read
SLICES = "scan_id string, z long, path string, height long, width long, dtype string, data binary, problem string"


def _folders(path: str | list[str]) -> list[str]:
    """One folder or several, each once, in the order of their first mention."""
    return [*dict.fromkeys(p.rstrip("/") or "/" for p in ([path] if isinstance(path, str) else path))]


def list_slices(spark: SparkSession, path: str | list[str], extensions=EXTENSIONS, number: str | None = None) -> DataFrame:
    """(scan_id, z, path): files of a folder, or of several, with one of the extensions, whatever their case.

    scan_id is the folder's name. z is the rank of the path, or with a pattern the number that its first group finds;
    files without it are left out. A folder without such files fails."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*").load(_folders(path)).select("path")
    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    found = files.where(kind.isin(*(e.lower().lstrip(".") for e in extensions)))
    scan = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("scan_id")
    if number:
        z = F.regexp_extract("path", number, 1)
        found = found.where(z != "").select(scan, z.cast("long").alias("z"), "path")
    else:
        w = Window.partitionBy("scan_id").orderBy("path")
        found = found.select(scan, "path").withColumn("z", (F.row_number().over(w) - 1).cast("long")).select("scan_id", "z", "path")
    if found.isEmpty():
        raise FileNotFoundError(f"no slices in {path}")
    return found


def read_stack(spark: SparkSession, path: str | list[str], extensions=EXTENSIONS, number: str | None = None, channel: str = "first") -> DataFrame:
    """Decoded slices (scan_id, z, path, height, width, dtype, data, problem).

    Spark's binaryFile source reads the files, so any store that it knows will do. A file may hold several slices (pages
    of a TIFF, a volume in NPY): they follow one another, and the files after them are counted on. channel: first, or
    mean, of slices with several. A file that cannot be decoded keeps its row, with problem set and no data."""
    listed = list_slices(spark, path, extensions, number)
    content = spark.read.format("binaryFile").load(_folders(path)).select("path", "content")
    if number is None and {e.lower().lstrip(".") for e in extensions} & {"tif", "tiff", "npy"}:

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = [codecs.slice_count(x) for x in batch.column("content").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(n, pa.int64())], names=["path", "n"])

        before = Window.partitionBy("scan_id").orderBy("z").rowsBetween(Window.unboundedPreceding, -1)
        held = content.join(listed.select("path"), "path", "left_semi").mapInArrow(count, "path string, n long")
        listed = listed.join(held, "path").withColumn("z", F.coalesce(F.sum("n").over(before), F.lit(0))).select("scan_id", "z", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for scan, z, name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    rows = []
                    for k, a in enumerate(codecs.slices(content)):
                        if a.ndim == 3:
                            a = a[:, :, 0] if channel == "first" else np.rint(a.mean(axis=2)).astype(a.dtype)
                        if a.ndim != 2:
                            raise ValueError(f"a slice of {a.ndim} dimensions")
                        a = a.astype(np.uint8) if a.dtype == np.bool_ else a
                        rows.append((scan, z + k, name, *a.shape, a.dtype.newbyteorder("=").name, np.ascontiguousarray(a, a.dtype.newbyteorder("<")).tobytes(), None))
                except (ValueError, TypeError, KeyError, IndexError, OSError) as e:
                    rows = [(scan, z, name, None, None, None, None, f"{type(e).__name__}: {e}")]
                for row in rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], schema=schema)

    names = ["scan_id", "z", "path", "height", "width", "dtype", "data", "problem"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    return listed.join(content, "path").select("scan_id", "z", "path", "content").mapInArrow(run, SLICES)


def voxels(slices: DataFrame, value: str = "v") -> DataFrame:
    """(scan_id, z, y, x, v) of decoded slices, v as double whatever the kind; undecoded ones give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a = np.frombuffer(r["data"], np.dtype(r["dtype"]).newbyteorder("<")).astype(np.float64)
                y, x = np.divmod(np.arange(len(a)), r["width"])
                n = len(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["scan_id"]] * n, pa.string()), pa.array(np.full(n, r["z"])), pa.array(y), pa.array(x), pa.array(a)],
                    names=["scan_id", "z", "y", "x", value],
                )

    good = slices.where("problem is null").select("scan_id", "z", "width", "dtype", "data")
    return good.mapInArrow(run, f"scan_id string, z long, y long, x long, {value} double")


def slices_of(df: DataFrame, value: str | list[str], dtype: str = "uint8", file_format: str = "png", name: str = "slice_%06d", stems: DataFrame | None = None) -> DataFrame:
    """(scan_id, z, name, content): each slice of voxels encoded as a file; three columns make one in colour. name: a
    pattern for z, without the suffix. stems: (scan_id, z, stem), what stands in names for ``slice_%06d``; slices without one are left out."""
    encode = {"png": codecs.png_encode, "tif": codecs.tiff_encode, "npy": codecs.npy_encode}[file_format]
    scan_kind = dict(df.dtypes)["scan_id"]
    values = [value] if isinstance(value, str) else list(value)
    numbered = stems is None

    def run(t: pa.Table) -> pa.Table:
        y, x = t.column("y").to_numpy(), t.column("x").to_numpy()
        a = np.zeros((y.max() + 1, x.max() + 1, len(values)), dtype)
        for k, c in enumerate(values):
            a[y, x, k] = t.column(c).to_numpy()
        content = encode(a[:, :, 0] if len(values) == 1 else a)
        z = t.column("z")[0].as_py()
        own = name % z if numbered else name
        return pa.table({"scan_id": t.column("scan_id")[:1], "z": pa.array([z], pa.int64()), "name": [f"{own}.{file_format}"], "content": pa.array([content], pa.binary())})

    made = df.select("scan_id", "z", "y", "x", *values).groupBy("scan_id", "z").applyInArrow(run, f"scan_id {scan_kind}, z long, name string, content binary")
    if stems is None:
        return made
    own = stems.select("scan_id", F.col("z").cast("long").alias("z"), "stem")
    return made.join(own, ["scan_id", "z"]).select("scan_id", "z", F.replace("name", F.lit("slice_%06d"), "stem").alias("name"), "content")


def stems(slices: DataFrame) -> DataFrame:
    """(scan_id, z, stem) of decoded slices: the name of a slice's file without its suffix, with the number of the slice
    behind it if the file holds several."""
    stem = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    pages = F.count("*").over(Window.partitionBy("path"))
    return slices.select("scan_id", "z", "path").select("scan_id", "z", F.concat(stem, F.when(pages > 1, F.concat(F.lit("_"), F.lpad(F.col("z").cast("string"), 4, "0"))).otherwise("")).alias("stem"))


def grey8_as_png(slices: DataFrame) -> DataFrame:
    """(scan_id, z, name, content): decoded 8-bit slices as PNG under their own names, values as they are. Slices of other
    kinds give no row; ``pending`` names them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = zip(batch.column("height").to_pylist(), batch.column("width").to_pylist(), batch.column("data").to_pylist(), strict=True)
            files = [codecs.png_encode(np.frombuffer(data, np.uint8).reshape(h, w)) for h, w, data in shapes]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("scan_id", "z", "name")), pa.array(files, pa.binary())], names=["scan_id", "z", "name", "content"])

    plain = slices.where("problem is null and dtype = 'uint8'")
    named = plain.join(stems(plain), ["scan_id", "z"]).withColumn("name", F.concat("stem", F.lit(".png")))
    return named.select("scan_id", "z", "name", "height", "width", "data").mapInArrow(run, "scan_id string, z long, name string, content binary")


class _Writer(DataSourceArrowWriter):
    """Writes (name, content) rows under a mounted folder; each file appears whole, under its name, or not at all."""

    def __init__(self, path: str, keep: bool):
        self.path, self.keep = path, keep

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        os.makedirs(self.path, exist_ok=True)
        for batch in batches:
            for r in batch.select(["name", "content"]).to_pylist():
                place = os.path.join(self.path, os.path.basename(r["name"]))
                if self.keep and os.path.exists(place):
                    continue
                part = f"{place}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(r["content"])
                os.replace(part, place)
        return WriterCommitMessage()


class SliceFiles(DataSource):
    """Sink ``slice_files``: option path is a folder that all executors have mounted; overwrite=false keeps files."""

    @classmethod
    def name(cls) -> str:
        return "slice_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool):
        return _Writer(self.options["path"], not overwrite and self.options.get("overwrite", "true").lower() == "false")


def write_slices(files: DataFrame, path: str, overwrite: bool = True) -> None:
    files.sparkSession.dataSource.register(SliceFiles)
    files.select("name", "content").write.format("slice_files").mode("append").option("overwrite", str(overwrite).lower()).save(path)


def pending(wanted: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Rows of wanted whose key has no result yet."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")
