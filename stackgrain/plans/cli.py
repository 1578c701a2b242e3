"""python -m stackgrain.plans.cli CONFIG ROOT [--scan-dir DIR] [--scan-id ID] [--until STAGE] [--export FOLDER [--volumes KIND] [--overlays]]"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stackgrain.sources import stack

from . import config, pipeline


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Run the voxel pipeline")
    p.add_argument("config")
    p.add_argument("root", help="folder for the stages' tables")
    p.add_argument("--scan-dir")
    p.add_argument("--scan-id")
    p.add_argument("--check", action="store_true", help="check the configuration and name the stages only")
    p.add_argument("--until", metavar="STAGE", help="the last stage to make")
    p.add_argument("--export", metavar="FOLDER", help="also write the stages' slices as PNG files below this mounted folder")
    p.add_argument("--overlays", action="store_true", help="export the pores drawn on the image as well")
    p.add_argument("--volumes", choices=("npy", "tif"), help="export one file a scan in place of slices")
    p.add_argument("--overwrite", action="store_true", help="replace exported files that are there")
    a = p.parse_args(args)
    c = config.parse(config.load(a.config), a.scan_dir, a.scan_id)
    if a.check:
        print(c)
        print("stages:", ", ".join(pipeline.planned(c)))
        return
    spark = SparkSession.builder.appName("stackgrain").getOrCreate()
    out = pipeline.run(spark, c, a.root, until=a.until)
    if a.export:
        stems = stack.stems(pipeline.source_slices(spark, c))
        print("exported:", ", ".join(pipeline.export(out, a.export, a.overwrite, a.volumes, a.overlays, stems)))
    if "psd" in out:
        out["psd"].where("Volume_Count > 0").orderBy("scan_id", "bin").show(100, truncate=False)


if __name__ == "__main__":
    main()
