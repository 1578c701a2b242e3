"""Configuration of the voxel pipeline: YAML or JSON, validated, with defaults; unknown keys are warned about."""

from __future__ import annotations

import json
import os
import warnings
from dataclasses import dataclass, field

from stackgrain.operators.correct import AGGRESSIVE, CONSERVATIVE, Thresholds
from stackgrain.sources.stack import EXTENSIONS

STAGES = ("preprocessing", "segmentation", "z_stability", "binary_builder", "psd")


class ConfigError(ValueError):
    pass


def merge(base: dict, over: dict) -> dict:
    """over laid on base, mapping by mapping."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load(path: str | None = None, env: str = "STACKGRAIN_CONFIG") -> dict:
    """The file's mapping with the JSON of an environment variable laid on it."""
    found: dict = {}
    if path:
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if path.endswith(".json"):
            found = json.loads(text)
        else:
            import yaml

            found = yaml.safe_load(text)
    if os.environ.get(env):
        found = merge(found or {}, json.loads(os.environ[env]))
    if not isinstance(found, dict):
        raise ConfigError("the configuration must be a mapping")
    return found


@dataclass(frozen=True)
class Config:
    scan_dir: str
    scan_id: str
    n_classes: int = 3
    overwrite: bool = False
    extensions: tuple[str, ...] = EXTENSIONS
    skip_damaged: bool = False
    by_ranges: bool = False  # volumes in one file are read by ranges of slices
    slices_per_commit: int = 0  # stages that treat slices alone are committed in parts of so many; 0: in one
    preprocessing: bool = True
    z_stability: bool = True
    short: int = 3
    long: int = 7
    target: int = 1
    conservative: Thresholds = CONSERVATIVE
    aggressive: Thresholds = AGGRESSIVE
    variant: str = "aggressive"
    spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)
    border_width: int = 1
    min_reliable: float = 5
    edges_um: tuple[float, ...] | None = None
    formats: tuple[str, ...] = ("csv",)
    metadata: dict = field(default_factory=dict, hash=False)


KNOWN = {
    "preprocessing": {"enabled", "overwrite", "skip_damaged", "by_ranges", "slices_per_commit"},
    "segmentation": {"enabled", "method", "n_classes", "save_overlay", "extensions"},
    "z_stability": {"enabled", "config_path", "definition"},
    "binary_builder": {"enabled", "mask_variant"},
    "psd": {"enabled", "entrypoint", "default_run_id", "image_params", "processing_thresholds", "output_settings"},
}


def parse(raw: dict, scan_dir: str | None = None, scan_id: str | None = None) -> Config:
    """A checked Config. All five stages have to be there; arguments win over the file's scan_dir and scan_id."""
    stages = raw.get("stages")
    if not isinstance(stages, dict):
        raise ConfigError("a 'stages' mapping is required")
    missing = [s for s in STAGES if s not in stages]
    if missing:
        raise ConfigError(f"missing stages: {', '.join(missing)}")
    place = scan_dir or raw.get("scan_dir")
    if not place:
        raise ConfigError("'scan_dir' is required")
    for name in STAGES:
        own = stages[name] or {}
        if not isinstance(own, dict):
            raise ConfigError(f"stage {name} must be a mapping")
        for k in own.keys() - KNOWN[name]:
            warnings.warn(f"unknown key {name}.{k}", stacklevel=2)
    seg, z, psd = (stages[k] or {} for k in ("segmentation", "z_stability", "psd"))
    if seg.get("method", "multiotsu") != "multiotsu":
        raise ConfigError(f"unknown segmentation method {seg['method']}")
    d = z.get("definition") or {}
    if z.get("enabled", True):
        lacking = {"windows", "thresholds", "target_class"} - d.keys()
        if lacking:
            raise ConfigError(f"z_stability.definition lacks {', '.join(sorted(lacking))}")
        for part, keys in (("windows", ("short", "long")), ("thresholds", ("conservative", "aggressive"))):
            if any(k not in d[part] for k in keys):
                raise ConfigError(f"z_stability.definition.{part} needs {' and '.join(keys)}")
    limits = {k: Thresholds(**v) for k, v in (d.get("thresholds") or {}).items() if k in ("conservative", "aggressive")}
    windows, params = d.get("windows") or {}, psd.get("processing_thresholds") or {}
    output = psd.get("output_settings") or {}
    formats = output.get("export_formats") or ["csv"]
    if seg.get("n_classes", 3) == 2 and d.get("target_class", 1) == 1 and z.get("enabled", True):
        warnings.warn("with two classes the bright class has label 1, which the z stage treats as uncertain", stacklevel=2)
    out = Config(
        scan_dir=place, scan_id=scan_id or raw.get("scan_id") or os.path.basename(place.rstrip("/")), n_classes=seg.get("n_classes", 3),
        overwrite=bool((stages["preprocessing"] or {}).get("overwrite", False)), extensions=tuple(e.lstrip(".") for e in seg.get("extensions", EXTENSIONS)),
        skip_damaged=bool((stages["preprocessing"] or {}).get("skip_damaged", False)), by_ranges=bool((stages["preprocessing"] or {}).get("by_ranges", False)),
        slices_per_commit=int((stages["preprocessing"] or {}).get("slices_per_commit", 0)), preprocessing=(stages["preprocessing"] or {}).get("enabled", True), z_stability=z.get("enabled", True), short=windows.get("short", 3), long=windows.get("long", 7),
        target=d.get("target_class", 1), conservative=limits.get("conservative", CONSERVATIVE), aggressive=limits.get("aggressive", AGGRESSIVE),
        variant=(stages["binary_builder"] or {}).get("mask_variant", "aggressive"), spacing=tuple(map(float, (psd.get("image_params") or {}).get("voxel_spacing", (1, 1, 1)))),
        border_width=params.get("border_width", 1), min_reliable=params.get("min_reliable_diameter_voxels", 5), edges_um=tuple(params["bin_edges_um"]) if params.get("bin_edges_um") else None,
        formats=tuple([formats] if isinstance(formats, str) else formats), metadata=output.get("metadata") or {},
    )
    if out.n_classes not in (2, 3) or out.variant not in ("conservative", "aggressive", "original"):
        raise ConfigError("n_classes must be 2 or 3, mask_variant conservative, aggressive or original")
    for t in (out.conservative, out.aggressive) if out.z_stability else ():
        t.check(out.short, out.long)
    return out
