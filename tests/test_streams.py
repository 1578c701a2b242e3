"""Windows along z on arriving slices equal those of the whole scan."""

import numpy as np
import pytest

from stackgrain.operators import zmetrics
from stackgrain.streaming import windows

from .test_voxel_operators import from_array

NAMES = {"short": 3, "long": 7}


@pytest.mark.parametrize("order", ["forwards", "backwards", "mixed"])
def test_arriving_slices(spark, tmp_path, order):
    r = np.random.default_rng(2)
    arrays = {1: r.integers(0, 3, (9, 5, 7)).astype(np.uint8), 2: r.integers(0, 3, (2, 4, 4)).astype(np.uint8), 3: r.integers(0, 3, (1, 3, 9)).astype(np.uint8)}
    rows = [(s, z, len(a), *p.shape, "uint8", p.tobytes()) for s, a in arrays.items() for z, p in enumerate(a)]
    rows = {"forwards": rows, "backwards": rows[::-1], "mixed": [rows[i] for i in r.permutation(len(rows))]}[order]
    schema = "scan_id long, z long, depth long, height long, width long, dtype string, data binary"
    for k in range(0, len(rows) + 5, 5):  # some slices come a second time
        some = rows[k : k + 5] + rows[max(0, k - 1) : k]
        spark.createDataFrame(some or rows[:1], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        spark.conf.set(*windows.STATE_STORE)
        try:
            found = windows.window_metrics_stream(stream, NAMES, tile=4)
            query = found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
            assert query.awaitTermination(300) and query.exception() is None
        finally:
            spark.conf.unset(windows.STATE_STORE[0])
    whole = from_array(spark, arrays[1].astype(int), "label", 1)
    for s in (2, 3):
        whole = whole.unionByName(from_array(spark, arrays[s].astype(int), "label", s))
    want = zmetrics.window_metrics(whole, NAMES)
    got = spark.read.parquet(f"{tmp_path}/out").select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
