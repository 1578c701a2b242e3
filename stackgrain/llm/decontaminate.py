"""Benchmark decontamination by SimHash windows.

Every run of words as long as a benchmark item is a window. A window is fingerprinted by SimHash over its weighted
five-word shingles (weight: how often the shingle occurs in it), and looked up among the fingerprints of the items of
its own size in a multi-index: the fingerprint is cut into radius + 1 blocks, so that an item within the Hamming radius
agrees on at least one block, and every item that agrees on one is compared in full. Items within the radius are
verified by the exact weighted Jaccard similarity of window and item.

A similar window shares at least one shingle with an item, so only windows with such a shingle are fingerprinted; sums
of bits come from running totals. At a similarity of 3/4 SimHash bits differ with a probability of 0.17, and the radius
of 40 of 128 bits is more than four standard deviations beyond that mean. For so wide a radius the blocks have three or
four bits: what selects is that a window is looked up among the items of its size alone, and the full comparison of
fingerprints. Windows are looked up in slices, so that a slice meets at most about `entries` items.

Items are read in blocks of bounded size (``item_block_chars``), each broadcast to one pass over the documents, so the
benchmark may grow. Words are split at ASCII white space, A-Z in lower case. A text shorter than an item is one window.
Null or empty texts and items match nothing. Items of fewer than five words are one shingle. Very long texts are searched
whole, in runs of windows. Of equally similar windows the first counts. Repeated items are matched each; repeated rows
give repeated results; empty tables give empty results. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, chunks, map_rows, mix, rolling, words

BITS = 128
STARTS = 1024  # windows worked on at once
ENTRIES = 1_000_000  # pairs of a window and an item looked at at once


def signs(s: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle's 128-bit hash."""
    both = np.stack([mix(s ^ np.uint64(0x243F6A8885A308D3)), mix(s ^ np.uint64(0x13198A2E03707344))], axis=1)
    bits = np.unpackbits(np.ascontiguousarray(both).view(np.uint8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def pack(totals: np.ndarray) -> np.ndarray:
    """Fingerprints, a row of bytes each, of rows of totals."""
    return np.packbits(totals > 0, axis=1)


class Items:
    """Fingerprints of benchmark items with their multi-index."""

    def __init__(self, ids: list[int], texts: list[bytes | None], k: int = 5, radius: int = 40):
        self.k, self.radius = k, radius
        hashes = WordHashes()
        kept = [(i, w) for i, t in zip(ids, texts, strict=True) if (w := words(t))]
        self.ids = [i for i, _ in kept]
        self.sizes = np.array([len(w) for _, w in kept], np.int64)
        shingles = [rolling(hashes.of(w), min(k, len(w))) for _, w in kept]
        self.weights = [np.unique(s, return_counts=True) for s in shingles]
        self.prints = np.concatenate([pack(signs(s).sum(axis=0, keepdims=True)) for s in shingles]) if kept else np.empty((0, BITS // 8), np.uint8)
        self.blocks = [b for b in np.array_split(np.arange(BITS), radius + 1)]
        # By size: the items of so many words, and for each block its sorted values with the items' places.
        self.index: dict[int, tuple[np.ndarray, list]] = {}
        for size in np.unique(self.sizes).tolist():
            own = np.nonzero(self.sizes == size)[0]
            sorted_values = []
            for values in self._values(self.prints[own]):
                order = np.argsort(values, kind="stable")
                sorted_values.append((values[order], order))
            self.index[size] = (own, sorted_values)
        # Shingles of all items, by their length in words: shorter items have shorter ones.
        self.lengths = {}
        for n in np.unique(np.minimum(self.sizes, k)).tolist():
            own = [i for i in range(len(kept)) if min(self.sizes[i], k) == n]
            every = np.concatenate([shingles[i] for i in own])
            owner = np.repeat(own, [len(shingles[i]) for i in own])
            order = np.argsort(every, kind="stable")
            quick = np.zeros(1 << 16, np.bool_)
            quick[(every & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.lengths[n] = (every[order], owner[order], quick)

    def _values(self, prints: np.ndarray) -> Iterator[np.ndarray]:
        bits = np.unpackbits(prints, axis=1)
        for b in self.blocks:
            yield bits[:, b] @ (1 << np.arange(len(b)))

    def near(self, prints: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of prints and items of the size within the radius, and their distances, slice by slice."""
        items, index = self.index[size]
        step = max(1, ENTRIES // len(items))
        for a in range(0, len(prints), step):
            some = prints[a : a + step]
            met = np.zeros((len(some), len(items)), np.bool_)
            for (values, order), own in zip(index, self._values(some), strict=True):
                first, last = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                count = last - first
                row = np.repeat(np.arange(len(own)), count)
                met[row, order[np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)]] = True
            row, at = np.nonzero(met)
            distance = np.bitwise_count(some[row] ^ self.prints[items[at]]).sum(axis=1)
            close = distance <= self.radius
            yield row[close] + a, items[at[close]], distance[close]

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Exact weighted Jaccard similarity of a window's shingles and an item."""
        (values, n), (others, m) = np.unique(window, return_counts=True), self.weights[item]
        at = np.minimum(np.searchsorted(others, values), len(others) - 1)
        same = int(np.where(others[at] == values, np.minimum(n, m[at]), 0).sum())
        return same / (len(window) + int(m.sum()) - same)

    def search(self, h: np.ndarray, least: float) -> dict[int, tuple[float, int, int, int]]:
        """By item its best window in a text of word hashes h: similarity, -start, words, distance."""
        best: dict[int, tuple[float, int, int, int]] = {}
        for n, (table, owner, quick) in self.lengths.items():
            s = rolling(h, n)
            seeds = np.nonzero(quick[(s & np.uint64(0xFFFF)).astype(np.int64)])[0]
            at = np.minimum(np.searchsorted(table, s[seeds]), len(table) - 1)
            seeds = seeds[table[at] == s[seeds]]
            if not len(seeds):
                continue
            lo, hi = np.searchsorted(table, s[seeds], "left"), np.searchsorted(table, s[seeds], "right")
            met = {int(o) for a, b in zip(lo, hi, strict=True) for o in owner[a:b]}
            for size in {int(self.sizes[i]) for i in met}:
                wide = min(size, len(h)) - n + 1  # shingles of a window
                # Starts of windows that hold a seed.
                mark = np.zeros(len(s) + 1, np.int64)
                np.add.at(mark, np.maximum(seeds - wide + 1, 0), 1)
                np.add.at(mark, seeds + 1, -1)
                starts = np.nonzero(np.cumsum(mark)[: len(s) - wide + 1] > 0)[0]
                for own in np.array_split(starts, -(-len(starts) // STARTS)):
                    self._windows(s, own, wide, size, least, best)
        return best

    def _windows(self, s: np.ndarray, starts: np.ndarray, wide: int, size: int, least: float, best: dict) -> None:
        # Runs of neighbouring starts share their running totals.
        for run in np.split(starts, np.nonzero(np.diff(starts) > wide)[0] + 1):
            a = int(run[0])
            totals = np.cumsum(signs(s[a : int(run[-1]) + wide]), axis=0)
            totals = np.concatenate((np.zeros((1, BITS), totals.dtype), totals))
            prints = pack(totals[run - a + wide] - totals[run - a])
            for rows, items, distances in self.near(prints, size):
                for row, item, distance in zip(rows.tolist(), items.tolist(), distances.tolist(), strict=True):
                    start = int(run[row])
                    like = self.similarity(s[start : start + wide], item)
                    found = (like, -start, size, distance)
                    if like >= least and found > best.get(item, (0.0,)):
                        best[item] = found


def read_items(benchmark: DataFrame, id_col: str, text_col: str, item_block_chars: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """The benchmark's items in blocks of about item_block_chars characters."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = size // item_block_chars + 1
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == b).orderBy("id", "text").collect()
        yield [r["id"] for r in rows], [bytes(r["text"]) for r in rows]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    least: float = 0.75,
    radius: int = 40,
    item_block_chars: int = 4_000_000,
) -> DataFrame:
    """A row for each document and item that it holds: doc_id, item_id, start_word, n_words, similarity, distance."""
    schema = "doc_id long, item_id long, start_word long, n_words long, similarity double, distance int"
    source = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    out = docs.sparkSession.createDataFrame([], schema)
    for ids, texts in read_items(benchmark, item_id_col, item_text_col, item_block_chars):
        given = docs.sparkSession.sparkContext.broadcast(Items(ids, texts, radius=radius))

        def run(batches: Iterator[list[list]], given=given) -> Iterator[list[list]]:
            hashes, items = WordHashes(), given.value
            for doc_ids, texts in batches:
                for own, some in chunks(doc_ids, texts):
                    rows = []
                    for doc, text in zip(own, some, strict=True):
                        for item, (like, start, size, distance) in items.search(hashes.of(words(text)), least).items():
                            rows.append((doc, items.ids[item], -start, size, like, distance))
                    if rows:
                        yield [*map(list, zip(*rows, strict=True))]

        out = out.unionByName(map_rows(source, run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
               least: float = 0.75, radius: int = 40, item_block_chars: int = 4_000_000) -> DataFrame:
    """The documents that hold no item, with all their columns and without a shuffle."""
    at = docs.columns.index(text_col)
    for ids, texts in read_items(benchmark, item_id_col, item_text_col, item_block_chars):
        given = docs.sparkSession.sparkContext.broadcast(Items(ids, texts, radius=radius))

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            hashes, items = WordHashes(), given.value
            for batch in batches:
                clean = []
                for text in batch.column(at).cast(pa.binary()).to_pylist():
                    clean.append(not items.search(hashes.of(words(text)), least))
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
