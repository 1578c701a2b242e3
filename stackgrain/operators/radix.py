"""Exact percentiles of slices of many distinct values, by counting passes over the bits of the values.

Values are read as whole numbers that sort like them. Each pass counts the values by their next 16 bits among those that
agree with a wanted rank in all bits before, which a running sum turns into the rank's next bits; two passes settle 32-bit
floats, four 64-bit ones. A pass shuffles at most 65,536 counts for each slice and rank that is still apart, however many
values there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16


def keys_of(values: np.ndarray) -> np.ndarray:
    """Whole numbers (unsigned, in 64 bits) in the order of the floats; -0.0 as 0.0, NaN last."""
    values = values + values.dtype.type(0)
    values[np.isnan(values)] = np.nan
    wide = values.dtype.itemsize * 8
    bits = values.view(f"u{values.dtype.itemsize}").astype(np.uint64)
    top = np.uint64(1 << (wide - 1))
    return np.where(bits & top, ~bits & np.uint64((1 << wide) - 1), bits | top)


def values_of(keys: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The floats of keys_of()."""
    wide = kind.itemsize * 8
    top = np.uint64(1 << (wide - 1))
    bits = np.where(keys & top, keys ^ top, ~keys & np.uint64((1 << wide) - 1))
    return bits.astype(f"u{kind.itemsize}").view(kind)


def percentiles(df: DataFrame, shares: list[float], value: str = "v", keys: list[str] | None = None) -> DataFrame:
    """(keys, q): the linear percentiles of a float or double column for each group of keys (scan_id and z by default), as
    Spark's percentile gives them: nulls count for nothing, groups without values are left out. df is read once for each pass."""
    keys = keys or ["scan_id", "z"]
    kinds = dict(df.dtypes)
    kind = np.dtype({"float": np.float32, "double": np.float64}[kinds[value]])
    passes = kind.itemsize * 8 // DIGIT
    present = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v_"))
    size = present.groupBy(*keys).agg(F.count("*").alias("n_"))
    # A wanted rank is a pair (share, side): the ranks below and above the place of the share.
    place = F.col("w_.share") * (F.col("n_") - 1)
    wanted = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(s)).alias("share"), F.lit(side).alias("side")) for i, s in enumerate(shares) for side in (0, 1)))
    rank = F.when(F.col("w_.side") == 0, F.floor(place)).otherwise(F.ceil(place))
    ranks = size.withColumn("w_", F.explode(wanted)).select(*keys, "n_", F.col("w_.i").alias("i_"), F.col("w_.side").alias("side_"), rank.alias("rank_"), F.lit(0).cast("long").alias("lead_"))
    for k in range(passes):
        shift = kind.itemsize * 8 - DIGIT * (k + 1)

        def count(batches: Iterator[pa.RecordBatch], shift: int = shift, deep: bool = k > 0) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                own = keys_of(batch.column("v_").to_numpy().copy()) >> np.uint64(shift)
                lead = (own >> np.uint64(DIGIT)).astype(np.int64)
                digit = (own & np.uint64((1 << DIGIT) - 1)).astype(np.int64)
                if deep:  # only those that agree with a wanted rank so far
                    leads = batch.column("leads_")
                    flat, at = leads.flatten().to_numpy(), np.repeat(np.arange(len(lead)), np.diff(leads.offsets.to_numpy()))
                    hit = np.zeros(len(lead), bool)
                    hit[at[flat == lead[at]]] = True
                    batch, lead, digit = batch.filter(pa.array(hit)), lead[hit], digit[hit]
                rows = pa.Table.from_arrays([*(batch.column(c) for c in keys), pa.array(lead), pa.array(digit)], names=[*keys, "lead_", "digit_"])
                grouped = rows.group_by(rows.column_names).aggregate([([], "count_all")])
                yield from grouped.select([*rows.column_names, "count_all"]).rename_columns([*rows.column_names, "c_"]).combine_chunks().to_batches()

        read = present
        if k:
            leads = ranks.groupBy(*keys).agg(F.collect_set("lead_").alias("leads_"))
            read = present.join(leads, keys)
        schema = ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", lead_ long, digit_ long, c_ long"
        counts = read.mapInArrow(count, schema).groupBy(*keys, "lead_", "digit_").agg(F.sum("c_").alias("c_"))
        upto = Window.partitionBy(*keys, "lead_").orderBy("digit_")
        counts = counts.withColumn("end_", F.sum("c_").over(upto))
        met = ranks.join(counts, [*keys, "lead_"]).where((F.col("rank_") < F.col("end_")) & (F.col("rank_") >= F.col("end_") - F.col("c_")))
        ranks = met.select(*keys, "n_", "i_", "side_", (F.col("rank_") - (F.col("end_") - F.col("c_"))).alias("rank_"), F.shiftleft("lead_", DIGIT).bitwiseOR(F.col("digit_")).alias("lead_"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = values_of(batch.column("lead_").to_numpy().view(np.uint64), kind).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*keys, "n_", "i_", "side_")), pa.array(found)], names=[*keys, "n_", "i_", "side_", "value_"])

    own = ", ".join(f"`{c}` {kinds[c]}" for c in keys)
    ends = ranks.mapInArrow(decode, f"{own}, n_ long, i_ int, side_ int, value_ double").groupBy(*keys, "n_", "i_").agg(
        F.max(F.when(F.col("side_") == 0, F.col("value_"))).alias("a_"), F.max(F.when(F.col("side_") == 1, F.col("value_"))).alias("b_")
    )
    share = F.element_at(F.array(*map(F.lit, map(float, shares))), F.col("i_") + 1)
    at = share * (F.col("n_") - 1)
    mixed = F.when(F.col("a_") == F.col("b_"), F.col("a_")).otherwise(F.col("a_") * (F.ceil(at) - at) + F.col("b_") * (at - F.floor(at)))
    return ends.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col("i_"), mixed.alias("q")))).alias("q")).select(*keys, F.col("q.q").alias("q"))
