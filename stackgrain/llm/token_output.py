"""Token ids of a corpus as binary segments of patched frame-of-reference blocks.

Format of a segment (little-endian): a header ``PFR1``, the block size, counts of documents, ids, blocks and
exceptions (unsigned 32-bit); document ids (64-bit) and lengths (32-bit); per block its start among the packed bytes
(32-bit), minimum (32-bit), width in bits (8-bit) and number of exceptions (16-bit); exception places (16-bit) and
values (32-bit); the packed bytes. A block holds 128 ids: its minimum is subtracted, the rest packed at the width that
covers the given percentile of its values, and wider values are kept whole in the exception list. Blocks can be
decoded alone through the index of starts.

Segments are rows of a Parquet table written by Spark, ordered by (part, segment), so that the writer's commit
protocol covers lost executors. Texts are tokenised where they are read, and only their ids (two bytes each where the
vocabulary allows) are shuffled, by ranges of the document id that are found from the ids alone; a repeated id keeps both rows (in any order).
Null text counts as empty, a null id sorts first, an empty table gives no segment. Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import array_chunks, map_rows, stored
from .tokens import default_tokenizer, piece_ids

BLOCK = 128
MAGIC = b"PFR1"
NULL_ID = -(2**63)


def encode_segment(doc_ids: list[int], ids: list[bytes], percentile: float = 0.9) -> bytes:
    """One segment from documents' ids."""
    values = np.frombuffer(b"".join(ids), "<u4")
    n, blocks = len(values), -(-len(values) // BLOCK)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[:n] = values
    padded[n:] = values[-1] if n else 0
    rows = padded.reshape(blocks, BLOCK)
    low = rows.min(axis=1) if blocks else np.empty(0, np.uint32)
    rest = rows - low[:, None]
    # The width comes from the value at the percentile, found by a partial sort.
    k = min(BLOCK - 1, int(percentile * BLOCK))
    at = np.partition(rest, k, axis=1)[:, k] if blocks else np.empty(0, np.uint32)
    width = np.ceil(np.log2(at.astype(np.float64) + 1)).astype(np.uint8)
    limit = (np.uint64(1) << width.astype(np.uint64)).astype(np.uint64)
    over = rest >= limit[:, None]
    where, place = np.nonzero(over)
    spare = rest[where, place]
    rest[where, place] = 0
    size = width.astype(np.int64) * (BLOCK // 8)
    start = np.concatenate(([0], np.cumsum(size)))
    packed = np.zeros(start[-1], np.uint8)
    for w in np.unique(width[width > 0]):
        own = np.nonzero(width == w)[0]
        for few in np.array_split(own, -(-len(own) // 4096)):
            wide = np.ascontiguousarray(rest[few], "<u4").view(np.uint8).reshape(len(few), BLOCK, 4)[:, :, : -(-int(w) // 8)]
            bits = np.unpackbits(wide, axis=2, bitorder="little")[:, :, :w]
            got = np.packbits(bits.reshape(len(few), -1), axis=1, bitorder="little")
            packed[start[few][:, None] + np.arange(got.shape[1])] = got
    head = np.array([BLOCK, len(doc_ids), n, blocks, len(spare)], "<u4").tobytes()
    lengths = np.array([len(x) // 4 for x in ids], "<u4").tobytes()
    counts = np.bincount(where, minlength=blocks).astype("<u2").tobytes()
    return b"".join(
        (MAGIC, head, np.array(doc_ids, "<i8").tobytes(), lengths, start[:-1].astype("<u4").tobytes(),
         low.astype("<u4").tobytes(), width.tobytes(), counts, place.astype("<u2").tobytes(),
         spare.astype("<u4").tobytes(), packed.tobytes())
    )


def decode_segment(segment: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, their lengths, and all ids of a segment in order."""
    if segment[:4] != MAGIC:
        raise ValueError("not a token segment")
    block, docs, n, blocks, spare_n = (int(x) for x in np.frombuffer(segment, "<u4", 5, 4))
    at = 24

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(segment, kind, count, at)
        at += got.nbytes
        return got

    doc_ids, lengths = take("<i8", docs), take("<u4", docs)
    start, low, width, counts = take("<u4", blocks), take("<u4", blocks), take("u1", blocks), take("<u2", blocks)
    place, spare = take("<u2", spare_n), take("<u4", spare_n)
    packed = np.frombuffer(segment, "u1", -1, at)
    rest = np.zeros((blocks, block), np.uint32)
    for w in np.unique(width[width > 0]):
        own = np.nonzero(width == w)[0]
        for few in np.array_split(own, -(-len(own) // 4096)):
            got = packed[start[few].astype(np.int64)[:, None] + np.arange(block // 8 * int(w))]
            bits = np.unpackbits(got, axis=1, bitorder="little").reshape(len(few), block, w)
            value = np.zeros((len(few), block, 4), np.uint8)
            value[:, :, : -(-int(w) // 8)] = np.packbits(bits, axis=2, bitorder="little")
            rest[few] = value.view("<u4")[:, :, 0]
    rest[np.repeat(np.arange(blocks), counts), place] = spare
    return doc_ids, lengths, (rest + low[:, None]).reshape(-1)[:n]


def token_ids(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, bounds: list[int]) -> DataFrame:
    """(doc_id, part, wide, ids): each document's ids with the end id, as 32-bit integers if wide and as 16-bit ones if
    not. part: how many of the sorted bounds are below the document's id, 0 for a null one."""
    limits = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_ids(tokenizer)
        for batch in batches:
            for a, b in array_chunks(batch.column("text")):
                ids, sizes = pieces.encode_all(batch.column("text").slice(a, b - a), end_id)
                wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
                data = ids if wide else ids.astype("<u2")
                bounds = np.concatenate(([0], np.cumsum(sizes))) * data.itemsize
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data)])
                own = batch.column("doc_id").slice(a, b - a)
                part = np.searchsorted(limits, own.fill_null(NULL_ID).to_numpy()).astype(np.int32)
                yield pa.RecordBatch.from_arrays([own, pa.array(part), pa.array([wide] * (b - a)), packed.cast(pa.binary())], names=["doc_id", "part", "wide", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, part int, wide boolean, ids binary")


def write_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    segment_ids: int = 1_000_000,
    percentile: float = 0.9,
) -> DataFrame:
    """The stored table of segments (part, segment, n_docs, n_ids, payload), in ascending order of the ids.

    A segment is closed at segment_ids ids, which bounds a task's memory; a longer document has its own."""

    def run(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        number, part = 0, None
        own: list[int] = []
        ids: list[bytes] = []
        held = 0

        def close() -> list[list]:
            nonlocal number, own, ids, held
            row = [[part], [number], [len(own)], [held], [encode_segment(own, ids, percentile)]]
            number, own, ids, held = number + 1, [], [], 0
            return row

        for parts, doc_ids, wide, packed in batches:
            for part, doc, w, x in zip(parts, doc_ids, wide, packed, strict=True):
                got = x if w else np.frombuffer(x, "<u2").astype("<u4").tobytes()
                if held and held + len(got) // 4 > segment_ids:
                    yield close()
                own.append(NULL_ID if doc is None else doc)
                ids.append(got)
                held += len(got) // 4
        if own:
            yield close()

    # As many ranges as shuffle partitions; their bounds are a few numbers.
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = docs.select(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.percentile_approx("doc_id", F.array(*(F.lit(i / n) for i in range(1, n))), F.lit(20 * n)).alias("b")
    ) if n > 1 else None
    bounds = sorted({*((bounds.first()["b"] if bounds is not None else None) or [])})
    tokenised = token_ids(docs, id_col, text_col, tokenizer or default_tokenizer(), end_id, bounds)
    ordered = (
        tokenised
        .repartitionById(len(bounds) + 1, F.col("part"))
        .sortWithinPartitions("doc_id")
        .select("part", "doc_id", "wide", "ids")
    )
    segments = map_rows(ordered, run, "part int, segment int, n_docs long, n_ids long, payload binary")
    return stored(segments, "segments")


def read_tokens(segments: DataFrame) -> DataFrame:
    """Documents read back from segments: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    spark = segments.sparkSession
    # One number for each partition of the writer: small whatever the corpus.
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"), F.count("*").alias("k")).collect()
    before, total = {}, 0
    for r in sorted(totals, key=lambda r: r["part"]):
        before[r["part"]], total = total, total + r["n"]
    few = sum(r["k"] for r in totals) <= 50_000  # checked size of what is broadcast: three numbers a segment
    offsets = spark.createDataFrame([*before.items()], "part int, part_start long").coalesce(1)
    by_part = segments.groupBy("part", "segment").agg(F.sum("n_ids").alias("n"))
    # Within a part, the ids of the segments before each one.
    w = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        by_part.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
        .join(offsets, "part")
        .select("part", "segment", (F.col("part_start") + F.col("before")).alias("start"))
    )

    def run(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        for firsts, payloads in batches:
            for first, payload in zip(firsts, payloads, strict=True):
                doc_ids, lengths, ids = decode_segment(payload)
                at = np.concatenate(([0], np.cumsum(lengths.astype(np.int64))))
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                names = [None if d == NULL_ID else d for d in doc_ids.tolist()]
                yield [names, (at[:-1] + first).tolist(), lengths.tolist(), crc]

    joined = segments.join(F.broadcast(starts) if few else starts, ["part", "segment"])
    return map_rows(joined.select("start", "payload"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
