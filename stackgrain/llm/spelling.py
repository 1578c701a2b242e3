"""Spelling variants of a corpus's words, grouped by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point makes one of the other. In a pair one word gives
chunks and the other, as long or one code point longer, gives positional grams. The first is cut into two disjoint
chunks; one edit leaves one of them as it is. The other word has the same string among its grams: at the same place if it
is the first chunk, shifted by the difference of the lengths (0 or 1) if it is the second, so of all positional grams
only those within that shift are emitted. A chunk alone is shared by very many words, so the rest of the word, which
holds the edit, is cut in two again in the same way until at most `rest` code points are left: a key joins all chunks
that were kept (what stands before and after the rest), which bounds the words of a key by the alphabet and not by the
corpus. Keys are 64-bit hashes; each candidate is verified on the words themselves.

A pair that meets at several keys is taken at the one whose rest holds the first difference. Words are counted where
texts are read, in tables of bounded size; roots are found by doubling along the forms, whose counts at least double
from link to link, so that a chain is no longer than the logarithm of the largest count. All joins are sort-merge joins by
hint: Spark takes the keys of a word, about ten rows each, for as small as the file of words that they are made from, and
would send them through the driver while that file is below the broadcast threshold.

Null or empty text: no words. A null id counts as an empty string before the colon. Texts are read whole, however long.
Ties between near words of equal counts go to the smaller word. Repeated rows count each. An empty table gives an empty
result. Only the id and text columns are read; others may have any name.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Letters of the contract in Latin-1, A-Z in lower case; all other bytes separate runs.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str | None) -> list[bytes]:
    """The runs of letters of a text in Latin-1, one byte for each code point; A-Z in lower case."""
    return text.encode("latin-1", "replace").translate(LETTERS).split() if text else []


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = 97, least_length: int = 5, held: int = 400_000) -> DataFrame:
    """(word, n): the words of at least so many code points. Where `damage` divides the crc32 of ``<id>:<run>``, the run
    loses the code point at that number modulo its length first; 0 leaves all runs as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in counts], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = zlib.crc32(b"%s:" % (doc_id or "").encode())
                for w, n in Counter(runs(text.as_py())).items():
                    if damage:
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                        if h % damage == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1 :]
                    if len(w) >= least_length:
                        counts[w] = counts.get(w, 0) + n
                if len(counts) > held:
                    yield flush()
        yield flush()

    read = docs.select(F.col(id_col).cast("string"), F.col(text_col))
    return read.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@cache
def rests(length: int, rest: int = 2) -> tuple[tuple[int, int], ...]:
    """Where the edit may lie: the parts that remain when a word is cut into two chunks, one of them is kept, and the
    other is cut in turn until it has at most `rest` code points."""

    def cut(start: int, end: int) -> list[tuple[int, int]]:
        if end - start <= rest:
            return [(start, end)]
        middle = (start + end + 1) // 2
        return cut(start, middle) + cut(middle, end)

    return tuple(cut(0, length))


def chunk_keys(word: str, rest: int = 2) -> Iterator[tuple[int, str, bool]]:
    """(key, rest of the word, whether it is its end) for partners as long and for those longer by one."""
    n = len(word)
    for start, end in rests(n, rest):
        for longer in (0, 1):
            yield _key(n, longer, start, word[:start], word[end:]), word[start:end], end == n


def gram_keys(word: str, rest: int = 2) -> Iterator[tuple[int, str]]:
    """(key, rest of the word) against chunks of words as long and of words shorter by one."""
    for longer in (0, 1):
        n = len(word) - longer
        for start, end in rests(n, rest):
            yield _key(n, longer, start, word[:start], word[end + longer :]), word[start : end + longer]


def _key(length: int, longer: int, start: int, before: str, after: str) -> int:
    h = xxhash.xxh3_64_intdigest(f"{length} {longer} {start} {before} {after}")
    return h - (1 << 63)


def near_pairs(words: DataFrame, rest: int = 2) -> DataFrame:
    """(word, n, near, near_n): each pair of near words of (word, n) once in each direction."""

    def keyed(keys, columns: dict[str, pa.DataType]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(0, batch.num_rows, 2000):
                    part = batch.slice(k, 2000)
                    found = [(i, *x) for i, w in enumerate(part.column("word").to_pylist()) for x in keys(w, rest)]
                    at, *more = zip(*found, strict=True) if found else [()] * (1 + len(columns))
                    own = part.take(pa.array(at, pa.int32()))
                    arrays = [pa.array(c, t) for c, t in zip(more, columns.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*own.columns, *arrays], names=[*own.schema.names, *columns])

        return run

    read = words.select("word", "n")
    chunks = read.mapInArrow(keyed(chunk_keys, {"k": pa.int64(), "r": pa.string(), "last": pa.bool_()}), "word string, n long, k long, r string, last boolean")
    grams = read.mapInArrow(keyed(gram_keys, {"k": pa.int64(), "r": pa.string()}), "word string, n long, k long, r string")
    c, g = chunks.alias("c"), grams.alias("g")
    longer = F.length("g.word") > F.length("c.word")
    once = (longer & (F.col("c.last") | ~F.startswith("g.r", "c.r"))) | (~longer & (F.col("c.word") < F.col("g.word")))
    near = c.join(g.hint("merge"), (F.col("c.k") == F.col("g.k")) & once & (F.levenshtein(F.col("c.word"), F.col("g.word"), 1) == 1))
    both = near.select(F.explode(F.array(
        F.struct(F.col("c.word").alias("word"), F.col("c.n").alias("n"), F.col("g.word").alias("near"), F.col("g.n").alias("near_n")),
        F.struct(F.col("g.word").alias("word"), F.col("g.n").alias("n"), F.col("c.word").alias("near"), F.col("c.n").alias("near_n")),
    )).alias("x"))
    return both.select("x.*")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form) in which words are distinct and chains end: the last form of each chain."""
    now = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = 97, least_length: int = 5, least_count: int = 3, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n): words of at least so many code points and occurrences. A word's form is its
    most frequent near word, if that is at least `ratio` times as frequent."""
    words = stored(count_words(docs, id_col, text_col, damage, least_length).where(F.col("n") >= least_count), "words")
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form"))).alias("b"))
    form_n = -F.col("b.m")
    fits = form_n >= ratio * F.col("n")
    found = stored(
        words.join(best.hint("merge"), "word", "left").select(
            "word", F.when(fits, F.col("b.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, form_n).alias("form_n")
        ), "forms",
    )
    ends = roots(found.where("form is not null"))
    return found.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
