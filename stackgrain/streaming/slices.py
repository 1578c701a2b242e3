"""Slices that keep arriving: thresholds and classes of each new slice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stackgrain.operators import otsu


def segment_stream(gray: DataFrame, out: str, checkpoint: str, n_classes: int = 3) -> StreamingQuery:
    """Classes of every slice of a streaming (scan_id, z, y, x, v), appended to Parquet under out.

    A slice is segmented on its own, so a micro-batch needs no state; it has to hold whole slices, as one file a slice
    gives. Batches are written under their number: a batch that is tried again replaces its own output."""

    def write(batch: DataFrame, number: int) -> None:
        otsu.segment(batch, n_classes).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return gray.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
