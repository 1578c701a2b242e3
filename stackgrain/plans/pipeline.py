"""The whole way from a folder of slices to a pore size distribution, as stages kept in Parquet.

Each stage is a lazy DataFrame plan, written once under root/scan_id/stage with the hash of its configuration and of the
stages before it in the path, so that a second run with the same settings reads it again and one with others does not.
A stage counts as done when Spark has committed it (its _SUCCESS file is there). Stages that treat each slice alone can be committed in parts
of a number of slices, so that a run which was stopped half way goes on with the slices that are left.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import warnings
from collections.abc import Callable, Iterator
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackgrain.operators import binary, components, correct, filters, intensity, otsu, psd, zmetrics
from stackgrain.sources import psd_table, stack, volume

from .config import Config


class Store:
    """Stage tables of one scan under a folder that Spark reads and writes."""

    def __init__(self, spark: SparkSession, root: str, config: Config):
        self.spark, self.root, self.config = spark, f"{root.rstrip('/')}/{config.scan_id}", config
        self.chain = ""

    def done(self, path: str) -> bool:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def path(self, name: str, settings: tuple) -> str:
        """Where the next stage is: its folder carries the hash of its settings and of the stages before."""
        used = {k: v for k, v in asdict(self.config).items() if k in settings}
        self.chain = hashlib.sha256(f"{self.chain}{name}{json.dumps(used, sort_keys=True, default=str)}".encode()).hexdigest()[:12]
        return f"{self.root}/{name}-{self.chain}"

    def stage(self, name: str, settings: tuple, make: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table, made unless it is there."""
        path = self.path(name, settings)
        if self.config.overwrite or not self.done(path):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


    def by_units(self, name: str, settings: tuple, source: DataFrame, make: Callable[[DataFrame], DataFrame], units: list[str], size: int) -> DataFrame:
        """stage() for a make() that treats each unit (a slice, a scan) of source alone, in parts of about so many units.

        A part is written, then named in the manifest with its units; only parts that the manifest names are read, so a run
        that was stopped leaves whole parts behind, and the next one makes the units that no part has. Size 0: one part."""
        if not size:
            return self.stage(name, settings, lambda: make(source))
        path = self.path(name, settings)
        present = source.select(*units).distinct()
        done = self.parts(path)
        left = present
        if done and not self.config.overwrite:
            left = present.join(self.spark.read.parquet(*(f"{path}/manifest/{p}" for p in done)), units, "left_anti")
        elif done:
            done = []
        n = left.count()
        number = F.pmod(F.xxhash64(*units), F.lit(max(1, -(-n // size))))
        for k in range(-(-n // size)):
            now = left.where(number == k)
            part = uuid.uuid4().hex
            make(source.join(now, units, "left_semi")).write.parquet(f"{path}/parts/{part}")
            now.write.parquet(f"{path}/manifest/{part}")
            done.append(part)
        if not done:  # nothing to make: an empty part keeps the schema
            done = [uuid.uuid4().hex]
            make(source).write.parquet(f"{path}/parts/{done[0]}")
            left.write.parquet(f"{path}/manifest/{done[0]}")
        return self.spark.read.parquet(*(f"{path}/parts/{p}" for p in done))

    def parts(self, path: str) -> list[str]:
        """The parts that the manifest names: those whose own file there has been committed."""
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
        return sorted(n for n in names if self.done(f"{path}/manifest/{n}"))


KEY = ["scan_id", "z", "y", "x"]


def segment_volume(gray: DataFrame, config: Config) -> DataFrame:
    return otsu.segment(gray, config.n_classes).select(*KEY, F.col("class").alias("label"))


def stabilise(labels: DataFrame, config: Config) -> DataFrame:
    """Labels with metrics along z, both corrections and their noise."""
    m = zmetrics.window_metrics(labels, {"short": config.short, "long": config.long}, config.target)
    sizes = components.components(labels, config.target).select(*KEY, "comp_size")
    m = m.join(sizes, KEY)
    for name, t, every in (("conservative", config.conservative, True), ("aggressive", config.aggressive, False)):
        m = correct.correct(m, t, every, config.target)
        m = m.withColumnsRenamed({"corrected": name, "noise": f"noise_{name}", "confidence": f"confidence_{name}"})
    return m


def planned(config: Config) -> list[str]:
    """The stages that run() would make or read, in order, for a dry run."""
    return ["gray", *["preprocessed"] * config.preprocessing, "labels", *["stability"] * config.z_stability, "binary", "psd"]


def stages(spark: SparkSession, config: Config, root: str, gray: DataFrame | None = None) -> Iterator[tuple[str, DataFrame]]:
    """(name, table) of each stage, made when it is asked for."""
    store = Store(spark, root, config)

    def raw() -> DataFrame:
        if gray is not None:
            return gray
        slices = source_slices(spark, config)
        state = slices.groupBy("dtype").agg(F.count("problem").alias("broken"), F.first("path").alias("path"), F.first("problem").alias("problem")).collect()
        broken = [r for r in state if r["broken"]]
        if broken and not config.skip_damaged:
            raise ValueError(f"{sum(r['broken'] for r in broken)} slices cannot be read, as {broken[0]['path']}: {broken[0]['problem']}")
        kinds = [r["dtype"] for r in state if r["dtype"]]
        if len(kinds) != 1:
            raise TypeError(f"slices of one kind are needed, not {kinds}")
        v = F.col("v").cast("double") if kinds[0].startswith("float") else F.col("v").cast("long")
        return stack.voxels(slices).withColumn("v", v).withColumn("dtype", F.lit(kinds[0]))

    image, kind = store.stage("gray", ("scan_dir", "scan_id", "extensions", "skip_damaged", "by_ranges"), raw), "uint8"
    yield "gray", image
    if "dtype" in image.columns:
        first = image.select("dtype").first()
        image, kind = image.drop("dtype"), first[0] if first else kind
    if config.preprocessing:
        was = kind
        image = store.by_units(
            "preprocessed", ("preprocessing",), image,
            lambda read: filters.preprocess(intensity.norm200(read, was).select(*KEY, F.col("u").alias("v"))).withColumnRenamed("pre", "v"),
            ["scan_id", "z"], config.slices_per_commit,
        )
        kind = "uint8"
        yield "preprocessed", image
    labels = store.by_units(
        "labels", ("n_classes",), image, lambda read: segment_volume(intensity.as_grey(read, kind), config), ["scan_id", "z"], config.slices_per_commit
    )
    yield "labels", labels
    final = labels
    if config.z_stability:
        stable = store.stage("stability", ("short", "long", "target", "conservative", "aggressive"), lambda: stabilise(labels, config))
        yield "stability", stable
        if config.variant != "original":
            final = stable.select(*KEY, F.col(config.variant).alias("label"))
    elif config.variant != "original":
        warnings.warn(f"no stage z_stability: its {config.variant} labels are replaced by those of the segmentation", stacklevel=2)
    pores = store.stage("binary", ("variant", "z_stability"), lambda: binary.collapse(final))
    yield "binary", pores
    edges = list(config.edges_um) if config.edges_um else None
    sizes = store.stage(
        "psd", ("spacing", "border_width", "min_reliable", "edges_um"),
        lambda: psd.compute_psd(pores, config.spacing, edges, config.border_width, config.min_reliable),
    )
    psd_table.save(sizes, f"{store.root}/psd_tables", list(config.formats), config.metadata | {"scan_id": config.scan_id})
    yield "psd", sizes


def run(spark: SparkSession, config: Config, root: str, gray: DataFrame | None = None, until: str | None = None) -> dict[str, DataFrame]:
    """All stages by name, or those up to one. gray: voxels (scan_id, z, y, x, v) in place of the scan's folder, 8-bit
    unless a column dtype names another kind. Slices that cannot be read fail the first stage, unless skip_damaged is
    set. Without the stage z_stability its variants fall back to the labels of the segmentation, with a warning."""
    if until and until not in planned(config):
        raise ValueError(f"no stage {until} among {', '.join(planned(config))}")
    out = {}
    for name, made in stages(spark, config, root, gray):
        out[name] = made
        if name == until:
            break
    return out


def maps_of(out: dict[str, DataFrame], overlays: bool = False) -> dict[str, tuple[DataFrame, str | list[str], str]]:
    """(voxels, columns, pattern of slice names) of each map of 8-bit levels that the stages hold, by its name. overlays:
    also the pores in red on the image that was segmented, which has to be 8-bit."""
    maps: dict[str, tuple[DataFrame, str | list[str], str]] = {}
    plain = "slice_%06d"
    if "preprocessed" in out:
        maps["preprocessed"] = out["preprocessed"], "v", f"{plain}_clahe61_med5"
    if "labels" in out:
        masks = otsu.class_masks(out["labels"].withColumn("class", F.col("label")))
        maps |= {"classmap": (out["labels"], "label", f"{plain}_classmap"), "mask0": (masks, "pores0", f"{plain}_mask0"), "mask01": (masks, "pores01", f"{plain}_mask01")}
        if overlays:
            image = out.get("preprocessed", out["gray"])
            both = masks.join(image.select(*KEY, "v"), KEY)
            for mask, name in (("pores0", "ov0"), ("pores01", "ov01")):
                shown = both.select(*KEY, otsu.overlay(F.col("v"), F.col(mask)).alias("o")).select(*KEY, "o.r", "o.g", "o.b")
                maps[f"overlay_{name}"] = shown, ["r", "g", "b"], f"{plain}_{name}"
    if "stability" in out:
        maps |= {f"mask_{n}": (binary.encode_labels(out["stability"], n), n, plain) for n in ("conservative", "aggressive")}
    if "binary" in out:
        shade = lambda c: F.when(c, 255).otherwise(0)
        both = out["binary"].withColumns({"pores": shade(F.col("is_pore")), "solids": shade(~F.col("is_pore"))})
        maps |= {f"binary_{c}": (both, c, plain) for c in ("pores", "solids")}
    return maps


def export(out: dict[str, DataFrame], folder: str, overwrite: bool = False, volumes: str | None = None, overlays: bool = False, stems: DataFrame | None = None) -> list[str]:
    """Writes the maps of the stages in folders of their own under a mounted folder, and returns their names: a PNG a
    slice, named by its number or with stems (stack.stems) by its source file, or with volumes (npy or tif) one file a
    scan, of grey maps only. PNG files that are there stay, unless overwrite is set."""
    maps = {k: m for k, m in maps_of(out, overlays).items() if not volumes or isinstance(m[1], str)}
    for name, (voxels, columns, pattern) in maps.items():
        place = f"{folder.rstrip('/')}/{name}"
        if volumes:
            volume.write_volumes(volume.planes(voxels, columns), place, volumes)
        else:
            stack.write_slices(stack.slices_of(voxels, columns, name=pattern, stems=stems), place, overwrite)
    return [*maps]


def source_slices(spark: SparkSession, config: Config) -> DataFrame:
    """The slices that the first stage reads."""
    return volume.read_volumes(spark, config.scan_dir) if config.by_ranges else stack.read_stack(spark, config.scan_dir, config.extensions)
