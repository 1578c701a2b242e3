"""Best-fit packing of documents into sequences, by bin completion over the histogram of piece lengths.

Pieces of equal length are interchangeable, so the packing problem of any corpus is a histogram of at most `capacity`
counts. The driver solves that. Best-fit decreasing gives the first incumbent. If it uses more sequences than
total / capacity allows, a depth-first search completes one sequence at a time: around the largest remaining piece it
enumerates the undominated fillings of the free room (maximal ones in which no set of pieces can give way to one larger
piece), those of least waste first, each as often as the counts allow or once. A node is pruned when its waste exceeds
what an incumbent better by one may waste; a better packing becomes the incumbent. ``steps`` and ``width`` bound the
search, never the pieces: all are packed. Pieces then find their slot by their rank among pieces of the same length,
which needs partition-wise counts and no global sort: nothing but counts passes through the driver.

Null text counts as empty; an empty document still has its end id. A very long text is cut into many pieces, each packed
on its own. A repeated document id keeps all its rows. Ties between pieces of one length are broken by partition and
row. An empty table gives an empty result. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import array_chunks, map_rows, stored
from .tokens import default_tokenizer, piece_ids

Packing = list[tuple[tuple[int, ...], int]]


def _best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing: each piece goes to the fullest sequence that still has room."""
    room: dict[int, list[list]] = defaultdict(list)  # free room -> [pattern, how often]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fits = [r for r in room if r >= length and room[r]]
            if fits:
                r = min(fits)
                pattern, n = room[r].pop()
                m = min(n, left)
                if m < n:
                    room[r].append([pattern, n - m])
                room[r - length].append([(*pattern, length), m])
                left -= m
            else:
                k = min(capacity // length, left)
                m = left // k
                room[capacity - k * length].append([(length,) * k, m])
                left -= k * m
    return [(tuple(p), n) for own in room.values() for p, n in own]


def _dominated(filling: tuple[int, ...], left: int, lengths: list[int], counts: dict[int, int]) -> bool:
    """Whether some pieces of the filling can give way to one larger piece: what a packing wins by the smaller pieces,
    it has then as well. Sets of up to three pieces are looked at."""
    used = Counter(filling)
    for n in range(1, min(3, len(filling)) + 1):
        for some in set(combinations(filling, n)):
            total = sum(some)
            at = bisect_left(lengths, total + (n == 1))
            while at < len(lengths) and lengths[at] <= total + left:
                if counts[lengths[at]] > used[lengths[at]]:
                    return True
                at += 1
    return False


def fillings(room: int, counts: dict[int, int], waste: int, most: int, tries: int = 2000) -> tuple[list[tuple[int, ...]], int]:
    """Undominated fillings of room that leave at most waste free, those of least waste first, and the tries left. At
    most so many are enumerated, in at most so many tries."""
    lengths = sorted(x for x in counts if counts[x] and x <= room)
    if not lengths:
        return [()] if room <= waste else [], tries
    if lengths[-1] == room:
        return [(room,)], tries  # one piece that fills the room dominates all else
    found: list[tuple[int, ...]] = []
    stack: list[tuple[tuple[int, ...], int, int]] = [((), room, len(lengths) - 1)]
    while stack and len(found) < most and tries > 0:
        chosen, left, top = stack.pop()
        tries -= 1
        last = bisect_right(lengths, left, 0, top + 1) - 1
        if last >= 0 and chosen and lengths[last] == chosen[-1] and chosen.count(chosen[-1]) >= counts[chosen[-1]]:
            last -= 1
        if last < 0:
            spare = any(counts[x] > chosen.count(x) for x in lengths[: bisect_right(lengths, left)])
            if left <= waste and not spare and not _dominated(chosen, left, lengths, counts):
                found.append(chosen)
            continue
        if last > 0:
            stack.append((chosen, left, last - 1))  # without this length
        stack.append(((*chosen, lengths[last]), left - lengths[last], last))
    return sorted(found, key=lambda f: (-sum(f), [-x for x in f])), tries


def solve(histogram: dict[int, int], capacity: int, steps: int = 400_000, width: int = 20) -> Packing:
    """Patterns of lengths and how often each is used, covering the histogram exactly.

    steps bounds the work of the search, in tries of a length and nodes (of 50 each); width bounds the fillings of a
    node (not the pieces: they are always all packed). The counts are changed and changed back along the way, so a node
    holds only its branches."""
    incumbent = _best_fit(histogram, capacity)
    used = sum(n for _, n in incumbent)
    total = sum(x * n for x, n in histogram.items())
    bound = -(-total // capacity)
    counts = dict(histogram)

    def branches(wasted: int) -> list[tuple[tuple[int, ...], int, int]]:
        """(pattern, how often, waste of one) around the largest piece left, the best last."""
        nonlocal steps
        top = max(x for x in counts if counts[x])
        counts[top] -= 1
        tries = min(2000, steps)
        found, left = fillings(capacity - top, counts, (used - 1) * capacity - total - wasted, width, tries)
        counts[top] += 1
        steps -= tries - left + 50
        out = []
        for f in found:
            pattern = (top, *f)
            often = min(counts[x] // n for x, n in Counter(pattern).items())
            out += [(pattern, m, capacity - sum(pattern)) for m in ((often, 1) if often > 1 else (1,))]
        return out[::-1]

    # A node: its branches, the waste so far, and what was done to come here.
    stack: list[tuple[list, int, tuple | None]] = [(branches(0), 0, None)] if used > bound else []
    while stack and used > bound and steps > 0:
        own, wasted, _ = stack[-1]
        if not own:
            done = stack.pop()[2]
            if done:
                for x in done[0]:
                    counts[x] += done[1]
            continue
        pattern, m, waste = own.pop()
        if wasted + m * waste > (used - 1) * capacity - total:
            continue
        for x in pattern:
            counts[x] -= m
        if any(counts.values()):
            stack.append((branches(wasted + m * waste), wasted + m * waste, (pattern, m)))
            continue
        incumbent = [*(d for *_, d in stack if d), (pattern, m)]
        used = sum(n for _, n in incumbent)
        for x in pattern:
            counts[x] += m
    return incumbent


def slots(packing: Packing) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank of each run of slots, sequence of that rank, offset within the sequence."""
    found: dict[int, list[list[int]]] = defaultdict(lambda: [[0], [], []])
    base = 0
    for pattern, n in packing:
        at = 0
        for length in pattern:
            ranks, sequences, offsets = found[length]
            ranks.append(ranks[-1] + n)
            sequences.append(base)
            offsets.append(at)
            at += length
        base += n
    return {k: (np.array(r[:-1]), np.array(s), np.array(o)) for k, (r, s, o) in found.items()}


def cut_pieces(
    docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, capacity: int, with_ids: bool
) -> DataFrame:
    """Pieces with their rank among those of the same length in the same partition."""
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["part", "rank", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, ranks = piece_ids(tokenizer), defaultdict(int)
        for batch in batches:
            part, docs_here, texts = (batch.column(i) for i in range(3))
            for a, b in array_chunks(texts):
                ids, sizes = pieces.encode_all(texts.slice(a, b - a), end_id)
                raw, at, rows = memoryview(ids).cast("B"), 0, []
                for k, doc, n in zip(part[a:b].to_pylist(), docs_here[a:b].to_pylist(), sizes.tolist(), strict=True):
                    for piece, start in enumerate(range(0, n, capacity)):
                        size = min(capacity, n - start)
                        own = raw[4 * (at + start) : 4 * (at + start + size)]
                        rows.append((k, ranks[size], doc, piece, start, size, zlib.crc32(own), bytes(own) if with_ids else None))
                        ranks[size] += 1
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    source = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = "part int, rank long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    return source.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    capacity: int = 2048,
    with_ids: bool = False,
) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and its ids if asked for)."""
    pieces = stored(
        cut_pieces(docs, id_col, text_col, tokenizer or default_tokenizer(), end_id, capacity, with_ids), "pieces"
    )
    by_part = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    place = slots(solve(histogram, capacity))
    given = docs.sparkSession.sparkContext.broadcast(place)  # a few numbers for each length up to capacity
    # For each length one count a partition, summed over the partitions before.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("first"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "rank", *["ids"] * with_ids]

    def run(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        for columns in batches:
            lengths, ranks = np.array(columns[3], np.int64), np.array(columns[5], np.int64)
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for n in np.unique(lengths):
                own = np.nonzero(lengths == n)[0]
                starts, sequences, offsets = given.value[int(n)]
                k = np.searchsorted(starts, ranks[own], side="right") - 1
                sequence[own] = sequences[k] + ranks[own] - starts[k]
                offset[own] = offsets[k]
            yield [*columns[:5], sequence.tolist(), offset.tolist(), *columns[6:]]

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return map_rows(ranked.select(*names), run, schema + ", ids binary" * with_ids)
