"""Volumetric grey-scale image stacks on Spark."""

from .operators.binary import collapse, inside_border, normalise_labels, pore_report
from .operators.edt import edt
from .operators.opening import opening
from .operators.otsu import segment, thresholds
from .operators.psd import compute_psd, distribution, peaks, spread
from .operators.zmetrics import window_metrics
from .plans.pipeline import run as run_pipeline
from .sources.psd_table import comparable
from .sources.stack import read_stack, voxels, write_slices
from .sources.volume import read_volumes, write_volumes
from .streaming.windows import window_metrics_stream

__all__ = ["collapse", "comparable", "compute_psd", "distribution", "edt", "inside_border", "normalise_labels", "opening", "peaks", "pore_report",
           "read_stack", "read_volumes", "run_pipeline", "segment", "spread", "thresholds", "voxels", "window_metrics", "window_metrics_stream", "write_slices",
           "write_volumes"]
