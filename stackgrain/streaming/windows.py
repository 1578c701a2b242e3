"""Windows along z on slices that keep arriving, in any order.

Slices are cut into tiles, and each tile of a scan keeps the slices that windows still need in state. A slice's metrics
come out once all slices of its longest window are there (fewer at the ends of the scan), and a slice leaves the state once the
last window that it belongs to has come out. The state so holds the longest window and what has arrived ahead of a gap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: What a session needs for state of this kind.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def tiles_of(slices: DataFrame, tile: int) -> DataFrame:
    """(scan_id, ty, tx, z, depth, height, width, data): decoded slices of labels cut into tiles of single bytes. slices:
    scan_id, z, height, width, dtype, data, and depth, how many slices (0, 1, ...) the scan has."""
    kinds = dict(slices.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a = np.frombuffer(r["data"], np.dtype(r["dtype"]).newbyteorder("<")).reshape(r["height"], r["width"]).astype(np.uint8)
                cells = [(y, x, a[y * tile : (y + 1) * tile, x * tile : (x + 1) * tile]) for y in range(-(-a.shape[0] // tile)) for x in range(-(-a.shape[1] // tile))]
                own = {"scan_id": [r["scan_id"]] * len(cells), "ty": [c[0] for c in cells], "tx": [c[1] for c in cells], "z": [r["z"]] * len(cells), "depth": [r["depth"]] * len(cells),
                       "height": [c[2].shape[0] for c in cells], "width": [c[2].shape[1] for c in cells], "data": [c[2].tobytes() for c in cells]}
                yield pa.RecordBatch.from_pydict(own, schema=schema)

    longs = ("ty", "tx", "z", "depth", "height", "width")
    schema = pa.schema([("scan_id", pa.string() if kinds["scan_id"] == "string" else pa.int64()), *((c, pa.int64()) for c in longs), ("data", pa.binary())])
    read = slices.select("scan_id", "z", "depth", "height", "width", "dtype", "data")
    return read.mapInArrow(run, f"scan_id {kinds['scan_id']}, {', '.join(f'{c} long' for c in longs)}, data binary")


def metrics_at(stack: np.ndarray, z: int, windows: dict[str, int], target: int) -> dict[str, np.ndarray]:
    """The columns of zmetrics.window_metrics for slice z of a stack of labels, by pixel."""
    out = {}
    for name, w in windows.items():
        h, end = w // 2, f"_{name}" if name else ""
        near = stack[max(0, z - h) : z + h + 1]
        for column, c in (("freq", target), ("frac0", 0), ("frac2", 2)):
            out[f"{column}{end}"] = (near == c).sum(axis=0) / len(near)
        out[f"flip{end}"] = (near[1:] != near[:-1]).sum(axis=0)
        out[f"win{end}"] = np.full(stack.shape[1:], len(near))
    return out


class _Windows(StatefulProcessor):
    def __init__(self, tile: int, windows: dict[str, int], target: int):
        self.tile, self.windows, self.target = tile, windows, target
        self.reach = max(w // 2 for w in windows.values())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.slices = handle.getMapState("slices", "z long", "height long, width long, data binary")
        self.sent = handle.getMapState("sent", "z long", "done boolean")  # slices whose metrics are out, from `floor` on
        self.floor = handle.getValueState("floor", "z long")  # all slices below have come out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        scan, ty, tx = key
        floor = self.floor.get()[0] if self.floor.exists() else 0
        new, depth = set(), 0
        for frame in rows:
            for r in frame.itertuples(index=False):
                depth = int(r.depth)
                z = int(r.z)
                # A slice that has left the state, or is there already, has arrived before.
                if floor < depth and z >= max(0, floor - self.reach) and not self.slices.containsKey((z,)):
                    self.slices.updateValue((z,), (int(r.height), int(r.width), bytes(r.data)))
                    new.add(z)
        for z in sorted({c for n in new for c in range(max(floor, n - self.reach), min(depth, n + self.reach + 1))}):
            first, last = max(0, z - self.reach), min(depth - 1, z + self.reach)
            if self.sent.containsKey((z,)) or not all(self.slices.containsKey((k,)) for k in range(first, last + 1)):
                continue
            held = [self.slices.getValue((k,)) for k in range(first, last + 1)]
            stack = np.stack([np.frombuffer(d, np.uint8).reshape(h, w) for h, w, d in held])
            found = metrics_at(stack, z - first, self.windows, self.target)
            y, x = np.indices(stack.shape[1:])
            own = {"scan_id": [scan] * y.size, "z": z, "y": (y + ty * self.tile).ravel(), "x": (x + tx * self.tile).ravel(), "label": stack[z - first].ravel().astype(np.int64)}
            self.sent.updateValue((z,), (True,))
            yield pd.DataFrame(own | {k: v.ravel() for k, v in found.items()})
        start = floor
        while self.sent.containsKey((floor,)):
            self.sent.removeKey((floor,))
            floor += 1
        if floor != start:
            self.floor.update((floor,))
            # Windows from floor on begin at floor - reach; at the end of the scan nothing is needed any more.
            for z in range(max(0, start - self.reach), depth if floor >= depth else max(0, floor - self.reach)):
                if self.slices.containsKey((z,)):
                    self.slices.removeKey((z,))

    def close(self) -> None:
        pass


def window_metrics_stream(slices: DataFrame, windows: dict[str, int], target: int = 1, tile: int = 256) -> DataFrame:
    """(scan_id, z, y, x, label and the columns of zmetrics.window_metrics) of a streaming relation of whole label slices
    with a column depth (see tiles_of); each slice once, when its longest window is full. A slice that arrives again is
    ignored. The session's state store has to be STATE_STORE."""
    kind = dict(slices.dtypes)["scan_id"]
    own = ", ".join(f"freq{e} double, frac0{e} double, frac2{e} double, flip{e} long, win{e} long" for e in (f"_{n}" if n else "" for n in windows))
    schema = StructType.fromDDL(f"scan_id {kind}, z long, y long, x long, label long, {own}")
    return tiles_of(slices, tile).groupBy("scan_id", "ty", "tx").transformWithStateInPandas(_Windows(tile, windows, target), schema, "Append", "None")
