"""Periodic runs of words within documents, by descending-LCP Kruskal over suffix classes.

A run is a stretch of words with smallest period q, at least max(12, 2 q) long, that no neighbouring word extends. The
suffixes of a text that share many words are found by doubling ranks, sorted, and joined in one chain by their common
prefixes (LCP). Going through the links of the chain by decreasing LCP, a union-find joins classes of suffixes, each an ordered set of
positions. When two positions i < j become neighbours in a set at an LCP of at least j - i, the words from i on repeat
with period j - i; they are a run's start if the words before i and before j differ. A smaller period would have put
another position between the two before, so j - i is the smallest one; positions of equal LCP are all inserted before
neighbours are looked at. Each run shows itself at its first position.

A run of 12 words or more needs an LCP of 6, so only positions whose six words stand elsewhere in the same text take
part; a text without such words costs its ranks alone. Ranks, sorting and LCPs are numpy over many texts at once (of
about four million characters together, or one longer text), all exact: words are numbered, not hashed.

Null or empty text: no word, no run. Texts are read whole, however long. Between runs of greatest length the smallest
start wins, then the smallest period. Rows are independent: repeated rows give equal results, an empty table an empty
one. With a null id a text is left as it is. Only the id and text columns are read; others may have any name.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_CHARS, array_chunks

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
          "n_words long, n_dropped long")  # fmt: skip


def with_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a periodic tail, for one id in ten: the contract's planted runs."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (-(-(n - a) // p)))[: n - a]


def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each key (equal keys, equal ranks; in order), and how many keys share it."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    at = np.nonzero(new)[0]
    count = np.diff(np.append(at, len(key)))
    group = np.cumsum(new) - 1
    rank, shared = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
    rank[order], shared[order] = at[group], count[group]
    return rank, shared


def suffix_links(ids: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, lcp): suffixes that follow each other in order and share at least `least` words within one document.

    ids and doc: word and document numbers of all positions. Position p and its rank at level k stand for the 2^k words
    from p on; what goes beyond a document counts as 0, below every word."""
    n = len(ids)
    rank, shared = _ranks(doc * (int(ids.max(initial=0)) + 1) + ids)
    levels, width = [rank], 1
    live = np.nonzero(shared > 1)[0]  # positions that share their words with others at this level
    while len(live):
        # Two halves: the second must not be unique either, else the position is told from all others by it.
        after = live + width
        inside = after < n
        inside[inside] = doc[after[inside]] == doc[live[inside]]
        second = np.zeros(len(live), np.int64)
        second[inside] = 1 + rank[after[inside]]
        order = np.lexsort((second, rank[live]))
        first, second, place = rank[live][order], second[order], live[order]
        new_first = np.append(True, first[1:] != first[:-1])
        new = new_first | np.append(True, second[1:] != second[:-1])
        at = np.nonzero(new)[0]
        group = np.cumsum(new) - 1
        start_first = np.maximum.accumulate(np.where(new_first, np.arange(len(live)), 0))
        refined = rank.copy()
        refined[place] = first + at[group] - start_first  # ranks of the former level have room for their members
        rank = refined
        levels.append(rank)
        width *= 2
        live = np.sort(place[np.diff(np.append(at, len(place)))[group] > 1])
    # At the last level all ranks differ: they order the suffixes. Those without a long common prefix are left out first.
    part = np.nonzero(_repeated(levels, doc, least))[0]
    part = part[np.argsort(rank[part], kind="stable")]
    a, b = part[:-1], part[1:]
    same = doc[a] == doc[b]
    a, b = a[same], b[same]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        ok = (x < n) & (y < n)
        ok[ok] = (doc[x[ok]] == doc[a[ok]]) & (doc[y[ok]] == doc[a[ok]])
        ok[ok] = levels[k][x[ok]] == levels[k][y[ok]]
        lcp[ok] += 1 << k
    keep = lcp >= least
    return a[keep], b[keep], lcp[keep]


def _repeated(levels: list[np.ndarray], doc: np.ndarray, least: int) -> np.ndarray:
    """Whether the `least` words from each position on stand elsewhere in the document."""
    k = max(0, least.bit_length() - 1)
    if k >= len(levels):
        return np.zeros(len(doc), bool)
    n, step = len(doc), least - (1 << k)
    whole = np.zeros(n, bool)
    whole[: max(0, n - least + 1)] = doc[: max(0, n - least + 1)] == doc[least - 1 :]
    at = np.nonzero(whole)[0]
    _, shared = _ranks(levels[k][at] * n + levels[k][at + step])
    whole[at] = shared > 1
    return whole


def seeds(ids: np.ndarray, doc: np.ndarray, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least `least` words, by start, then period. Positions are those of all
    documents together."""
    a, b, lcp = suffix_links(ids, doc, (least + 1) // 2)
    order = np.argsort(-lcp, kind="stable")
    n, found = len(ids), set()
    last = np.append(doc[1:] != doc[:-1], True) if n else np.zeros(0, bool)
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(i: int) -> int:
        up = parent.get(i)
        if up is None:
            parent[i], members[i] = i, [i]
            return i
        while up != parent[up]:
            parent[i] = up = parent[up]
            i, up = up, parent[up]
        return up

    def look(i: int, j: int, common: int) -> None:
        if j - i > common or j - i + common < least:
            return
        if i and doc[i - 1] == doc[j - 1] == doc[i] and ids[i - 1] == ids[j - 1]:
            return  # starts before
        end = j + common
        if end < n and not last[end - 1] and ids[i + common] == ids[end]:
            return  # neighbours since a larger LCP
        found.add((i, end - i, j - i))

    pairs = list(zip(a[order].tolist(), b[order].tolist(), lcp[order].tolist(), strict=True))
    k = 0
    while k < len(pairs):
        level, moved = pairs[k][2], []
        while k < len(pairs) and pairs[k][2] == level:
            small, large = root(pairs[k][0]), root(pairs[k][1])
            k += 1
            if small == large:
                continue
            if len(members[small]) > len(members[large]):
                small, large = large, small
            parent[small] = large
            into, own = members[large], members.pop(small)
            if len(own) < len(into) // 16 + 2:
                for p in own:
                    insort(into, p)
            else:
                into += own
                into.sort()  # two sorted stretches: merged in one pass
            moved += own
        for p in moved:
            own = members[root(p)]
            at = bisect_left(own, p)
            if at:
                look(own[at - 1], p, level)
            if at + 1 < len(own):
                look(p, own[at + 1], level)
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list[bytes]], least: int = 12) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, as (start, length, period)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.append(0, np.cumsum(sizes))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not begin[-1]:
        return found
    ids = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    for start, length, period in seeds(ids, doc, least):
        d = int(doc[start])
        found[d].append((start - int(begin[d]), length, period))
    return found


def row_of(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The values of SCHEMA for one document."""
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    kept = words
    if runs:
        step = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            step[start + period] += 1
            step[start + length] -= 1
        kept = [words[i] for i in np.nonzero(np.cumsum(step[:-1]) == 0)[0].tolist()]
    said = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2], hashlib.sha256(said.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest(), len(words), len(words) - len(kept))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12, tails: bool = False) -> DataFrame:
    """One row a document: its number of runs, its longest run, digests of all runs and of the text without repeats,
    n_words and n_dropped. tails: first give one document in ten a periodic tail (``with_tail``)."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for start, end in array_chunks(texts, 4 * CHUNK_CHARS):
                ids = batch.column(0).slice(start, end - start).to_pylist()
                words = [t.split() if t else [] for t in texts.slice(start, end - start).cast(pa.binary()).to_pylist()]
                if tails:
                    words = [with_tail(w, i) for w, i in zip(words, ids, strict=True)]
                rows = [row_of(*x) for x in zip(ids, words, runs_of(words, least), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    read = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return read.mapInArrow(run, SCHEMA)
