"""N-gram Jaccard join by parity sketches.

A text's set of five-word shingles is XOR-hashed into a sketch of blocks: each shingle toggles one cell of one block,
and a block is stored as the XOR of its toggled cells' keys. A shingle in one set alone changes one block at most, so
the number of differing blocks (the Hamming distance of the sketches, block by block) never exceeds the symmetric
difference, which is at most (|A| + |B|) / 7 for a Jaccard similarity of 3/4. By the pigeonhole principle linked texts
agree on all but so many of their non-empty blocks. Sketches are compared within bands of set sizes; a text also
enters the next band if its partners may lie there.

Blocks are joined rarest first (prefix filtering), so that passages which many texts share produce no candidates.
Of long texts only the first `blocks` non-empty blocks in hash order are used. Shingle hashes are random, so the number
of them on which a pair at the limit of the similarity agrees is binomial: its quantile for a probability of `loss` is how
many have to agree (23 to 26 of 64 for 1e-6); for texts of up to `blocks` blocks the pigeonhole bound itself is used and nothing is
left to chance. Candidates pass a 512-bit parity sketch, whose Hamming distance is a lower bound in the same way, and
are then verified exactly on their sets of 64-bit shingle hashes.

Texts with equal sets form one class beforehand. Within a block that several classes share, members are not paired
with each other: in each round every class is compared with a few leaders of its blocks (first those that share most,
then others by hash) that are not yet in its component, and components are formed anew; so a large group of near copies
falls into few components in a number of pairs that grows with its size. What large blocks leave open is then compared with
hubs, the texts with the fewest shingles of their own, which takes in those on the rim of a group. Then the pairs that still lie in different
components, of fitting sizes and sketches, are compared, so that no component is split: all pairs of blocks of few rows, and in
larger blocks those that share one of their rarest shingles, at places that leave enough to share, as all similar pairs do. A passage that many texts share
fills large blocks, but is not among the rarest shingles of texts that are not similar.
Where they are asked for, links are counted inside the components, tile by tile, as products of 0/1 matrices of their
shingles: no rows are made for pairs, but the arithmetic grows with the square of a component.

Null or empty text: an empty set, linked with nothing. Texts of fewer words than a shingle: the whole sequence is one
shingle. Rows are known by the hash of their id and text, so rows with a repeated id and different texts are compared
each for itself, and rows without an id link like others; their component_id is the smallest id that they reach, null if
there is none. An empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, chunks, mix, shingles, stored, words

SKETCH_LONGS = 8
FIRST_BAND = 64


def bands(n: int) -> list[tuple[int, int, int]]:
    """(band, number of blocks, most differing blocks) for a set of n shingles: its own band, and the next one if a
    larger partner may lie there."""
    band, top = 0, FIRST_BAND
    while n > top:
        band, top = band + 1, top * 2
    largest = n * 4 // 3
    out = [(band, top if band else 1 << 16, (n + min(top, largest)) // 7)]
    if largest > top:
        out.append((band + 1, top * 2, (n + largest) // 7))
    return out


@cache
def least_agreeing(blocks: int, load: float, loss: float) -> int:
    """How many of so many non-empty blocks of a text a partner at the limit of the similarity has as well, but for a
    probability of `loss`; load: shingles for each block of the sketch, in hundredths rounded up.

    A block agrees if it holds none of the differing shingles. The worst partner is a part of the text, three quarters of
    it: of the shingles, a quarter differs. (A larger one, and one as large, leave more blocks as they are.)"""
    same = (1 - math.exp(-0.75 * load)) * math.exp(-0.25 * load) / (1 - math.exp(-load))
    below = 0.0
    for k in range(blocks + 1):
        below += math.comb(blocks, k) * same**k * (1 - same) ** (blocks - k)
        if below > loss:
            break
    return k


def block_keys(s: np.ndarray, blocks: int = 64, loss: float = 1e-6) -> list[tuple[np.ndarray, int]]:
    """For each band of a sorted set of shingle hashes: keys of its first non-empty blocks, and how many of them a
    linked text has at least."""
    out = []
    for band, m, differ in bands(len(s)):
        # The block is given by the leading bits, so that equal blocks stand together in the sorted set.
        block = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        start = np.nonzero(np.concatenate(([True], block[1:] != block[:-1])))[0]
        value = np.bitwise_xor.reduceat(mix(s), start)
        keys = mix(value ^ mix(block[start] + np.uint64(band << 48)))
        least = len(keys[:blocks]) - differ
        if len(keys) > blocks:
            keys, least = keys[:blocks], max(least, least_agreeing(blocks, math.ceil(100 * len(s) / m) / 100, loss))
        out.append((keys, max(1, least)))
    return out


def parity_bits(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((mix(s) & np.uint64(64 * SKETCH_LONGS - 1)).astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def fingerprint(s: np.ndarray) -> int:
    """A 64-bit number of the whole set, signed."""
    keyed = np.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)), mix(np.array([len(s)], np.uint64)))
    return int(keyed.sum(dtype=np.uint64).view(np.int64))


def _sets(texts: list[bytes | None], hashes: WordHashes, k: int) -> Iterator[np.ndarray]:
    for text in texts:
        yield shingles(hashes.of(words(text)), k)


def summarise(docs: DataFrame, k: int, blocks: int, loss: float) -> DataFrame:
    """doc_id, row (the row's hash), n, fp and the block keys by band. A task gives the blocks of equal sets once."""
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            ids, texts = batch.select(["doc_id", "row"]), batch.column("text").to_pylist()
            for own, some in chunks([*range(len(texts))], texts):
                n, fp, keys = [], [], ([], [], [], [])
                for s in _sets(some, hashes, k):
                    n.append(len(s))
                    fp.append(fingerprint(s) if len(s) else None)
                    found = block_keys(s, blocks, loss) if len(s) and fp[-1] not in seen else []
                    seen.add(fp[-1])
                    for i in range(2):
                        keys[2 * i].append(found[i][0].view(np.int64) if i < len(found) else None)
                        keys[2 * i + 1].append(found[i][1] if i < len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [*ids.slice(own[0], len(own)).columns, pa.array(n, pa.int64()), pa.array(fp, pa.int64()), pa.array(keys[0], longs),
                     pa.array(keys[1], pa.int32()), pa.array(keys[2], longs), pa.array(keys[3], pa.int32())],
                    names=["doc_id", "row", "n", "fp", "own", "own_least", "next", "next_least"],
                )

    schema = "doc_id long, row long, n long, fp long, own array<long>, own_least int, next array<long>, next_least int"
    return docs.mapInArrow(run, schema)


def candidates(summary: DataFrame) -> DataFrame:
    """(key, fp, n, weight): the blocks by which classes may find a partner."""
    rows = [
        summary.where(F.col(c).isNotNull()).select(
            F.explode(c).alias("key"), "fp", F.col("n").cast("int").alias("n"), F.col(f"{c}_least").alias("least"), F.lit(i).alias("role")
        )
        for i, c in enumerate(("own", "next"))
    ]
    blocks = rows[0].unionByName(rows[1])
    shared = (
        blocks.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"), F.count("*").alias("df")).where("lo < hi")
    )
    met = blocks.join(shared.select("key", "df"), "key").distinct()
    mine = Window.partitionBy("fp", "role")  # a class has a bounded number of blocks
    ranked = met.withColumn("rank", F.row_number().over(mine.orderBy("df", "key"))).withColumn("met", F.count("*").over(mine))
    ranked = ranked.withColumn("weight", F.sum("df").over(mine))  # of near copies the least changed shares most
    return ranked.where(F.col("rank") <= F.col("met") - F.col("least") + 1).select("key", "fp", "n", "weight")


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, comp) of undirected edges (a, b): the smallest node of each component, by alternating stars."""

    def keep(pairs: DataFrame) -> DataFrame:
        return stored(pairs.where("a <> b").distinct(), "stars")

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()

    now = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before = state(now)
    for _ in range(most):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = keep(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = keep(small.unionByName(low.select("a", F.col("m").alias("b"))))
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def class_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(fp, n, s0..s7, set) of the rows of docs named by wanted (row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for _, some in chunks(texts, texts):
                found = [*_sets(some, hashes, k)]
                bits = np.array([parity_bits(s) for s in found]).reshape(len(found), SKETCH_LONGS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([fingerprint(s) for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int64()),
                     *(pa.array(bits[:, i].copy()) for i in range(SKETCH_LONGS)), pa.array([s.tobytes() for s in found], pa.binary())],
                    names=["fp", "n", *(f"s{i}" for i in range(SKETCH_LONGS)), "set"],
                )

    schema = "fp long, n long, " + ", ".join(f"s{i} long" for i in range(SKETCH_LONGS)) + ", set binary"
    picked = docs.join(wanted, "row", "left_semi").select("text").mapInArrow(run, schema)
    return stored(picked.dropDuplicates(["fp"]), "sets")


def sketches_fit(a: str, b: str, percent: int) -> Column:
    """Whether sizes and parity sketches (columns <a>_n, <a>_s0, ...) allow the similarity: for p per cent,
    difference * (100 + p) <= total * (100 - p)."""
    differ = sum((F.bit_count(F.col(f"{a}_s{i}").bitwiseXOR(F.col(f"{b}_s{i}"))) for i in range(SKETCH_LONGS)), F.lit(0))
    n, m = F.col(f"{a}_n"), F.col(f"{b}_n")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (differ * (100 + percent) <= (n + m) * (100 - percent))


def _side(name: str, df: DataFrame) -> DataFrame:
    return df.select(F.col("fp").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in df.columns if c != "fp"))


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets have the similarity, as a stored table."""
    light, whole = sets.drop("set"), sets.select("fp", "set")
    near = pairs.join(_side("a", light), "a").join(_side("b", light), "b").where(sketches_fit("a", "b", percent))
    both = near.select("a", "b").join(_side("a", whole), "a").join(_side("b", whole), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_set"), batch.column("b_set"), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                same = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * same >= percent * (len(s) + len(t) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(both.select("a", "b", "a_set", "b_set").mapInArrow(run, "a long, b long"), "links")


def _pairs_with_leaders(here: DataFrame, turn: int, leaders: int) -> DataFrame:
    """(a, b): each class with some leaders of its blocks from other components."""
    if turn:
        order = F.struct(F.xxhash64("fp", "key", F.lit(turn)).alias("h"), "fp", "comp")
    else:
        order = F.struct(F.col("weight").alias("h"), "fp", "comp")
    heads = here.groupBy("key").agg(F.max(order).alias("head"))
    met = here.join(heads, "key").where("comp <> head.comp").select("fp", F.col("head.fp").alias("b"), F.col("head.h").alias("h")).distinct()
    few = Window.partitionBy("fp").orderBy(F.desc("h"), "b")  # a class has a bounded number of blocks
    return met.withColumn("rank", F.row_number().over(few)).where(F.col("rank") <= leaders).select(F.col("fp").alias("a"), "b")


def _dealt(rows: DataFrame, groups: DataFrame, key: str, by: Column, least: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on (key, part): groups holds one row a key with its size m. Keys of `least` rows or more have
    m / least parts; there are few of them by the choice of least, so they are broadcast to deal their rows by hash."""
    parts = F.ceil(F.col("m") / least)
    hot = F.broadcast(groups.where(F.col("m") >= least).select(key, parts.alias("parts")))
    spread = rows.join(hot, key, "left").withColumn("part", F.coalesce(F.pmod(by, "parts"), F.lit(0).cast("long"))).drop("parts")
    return spread, groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("m")


def _tiled(rows: DataFrame, group: str, slots: Column, by: str) -> DataFrame:
    """The rows of each group dealt by hash to slots, once for each pair of slots (lo <= hi) that they belong to."""
    own = rows.withColumn("slots", slots).withColumn("slot", F.pmod(F.xxhash64(by, group), "slots"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)))
    return own.withColumn("lo", F.least("slot", "other")).withColumn("hi", F.greatest("slot", "other")).drop("slots", "other")


def _pairs_left(here: DataFrame, sets: DataFrame, percent: int, most: int = 64) -> DataFrame:
    """(a, b): pairs that share a block, lie in different components and may be similar by size and sketch. In blocks of
    at most so many rows all pairs are made; rows of larger blocks meet by their rarest shingles."""
    few, hot = _by_size(here, most)
    return _pairs_of_few(few, sets, percent).unionByName(_pairs_by_rare_shingles(_rare_shingles(hot, sets, percent), percent)).distinct()


def _by_size(here: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows (key, fp, comp) of blocks of at most so many rows, and the classes (fp, comp) of larger ones."""
    size = here.groupBy("key").agg(F.count("*").alias("m"))
    rows = stored(here.join(size, "key").select("key", "fp", "comp", "m"), "sized")
    return rows.where(F.col("m") <= most).select("key", "fp", "comp"), rows.where(F.col("m") > most).select("fp", "comp").distinct()


def _pairs_of_few(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    full = rows.join(sets.drop("set"), "fp")
    a, b = _side("a", full), _side("b", full)
    return a.join(b, (a.a_key == b.b_key) & (F.col("a_comp") < F.col("b_comp")) & sketches_fit("a", "b", percent)).select("a", "b")


def _rare_shingles(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles h of the classes (fp, comp), with their place in the class's set, whether they are early, and
    the number `met` of the class's shingles that others have; as a stored table with sizes and sketches.

    Sets of n <= m shingles with a similarity of p per cent share at least 2 p / (100 + p) n and p m / 100. With shingles in
    one order, rarest among these classes first, the first shingle that two sets share is then among the first n / 7 + 1
    of the smaller (early ones) and m / 4 + 1 of the larger one (for p = 75)."""
    own = rows.join(sets.select("fp", "n", "set"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = np.frombuffer(batch.column("set")[i].as_buffer(), np.int64)
                for at in range(0, len(s), 100_000):
                    part = s[at : at + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), batch.column(c)[i].as_py())) for c in ("fp", "n")] + [pa.array(part)], names=["fp", "n", "h"])

    shingle = own.select("fp", "n", "set").mapInArrow(run, "fp long, n long, h long")
    often = shingle.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    met = shingle.join(often, "h")
    mine = Window.partitionBy("fp")  # a set, which one task has made
    met = met.withColumn("met", F.count("*").over(mine))
    place = F.col("n") - F.col("met") + F.row_number().over(mine.orderBy("df", "h"))  # after those that no other has
    smaller = F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1
    larger = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    first = met.withColumn("place", place).where(F.col("place") <= larger).select("fp", "h", "place", "met", (F.col("place") <= smaller).alias("early"))
    return stored(first.join(rows, "fp").join(sets.drop("set"), "fp"), "rare")


def _pairs_with_hubs(rare: DataFrame, percent: int, hubs: int = 4) -> DataFrame:
    """(a, b): each class with a few classes of other components that share one of its rarest shingles and have the
    fewest of their own. A text on the rim of a large group is linked with those if with any of the group; once it is
    in their component, it needs no comparison with all others there."""
    heads = rare.groupBy("h").agg(F.max_by(F.struct("fp", "comp", "n", *(f"s{i}" for i in range(SKETCH_LONGS))), F.struct(F.col("met") / F.col("n"), "fp")).alias("b"),
                                  F.max(F.col("met") / F.col("n")).alias("share"))
    a, b = _side("a", rare), heads.select("h", "share", F.col("b.fp").alias("b"), *(F.col(f"b.{c}").alias(f"b_{c}") for c in ("comp", "n", *(f"s{i}" for i in range(SKETCH_LONGS)))))
    met = a.join(b, (a.a_h == b.h) & (F.col("a_comp") != F.col("b_comp")) & sketches_fit("a", "b", percent)).select("a", "b", "share").distinct()
    few = Window.partitionBy("a").orderBy(F.desc("share"), "b")  # a class has a bounded share of its shingles here
    return met.withColumn("rank", F.row_number().over(few)).where(F.col("rank") <= hubs).select("a", "b")


def _pairs_by_rare_shingles(rare: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of the classes of _rare_shingles() that share one of these, lie in different components and may be
    similar by size, sketch and place.

    A passage that many texts share makes them meet only where it leaves less than a seventh of a text its own, and such
    texts are similar and in one component by now. At places i and j the first shingle that two sets share leaves at most
    the rest of either to be shared: n - i and m - j, which with it have to reach p (n + m) / (100 + p). (Of a similar pair the
    first shared shingle passes, whatever the later ones do.)"""
    a, b = _side("a", rare.where("early")), _side("b", rare)
    order = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a") < F.col("b")))
    left = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place")) + 1
    enough = left * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    return a.join(b, (a.a_h == b.b_h) & order & (F.col("a_comp") != F.col("b_comp")) & enough & sketches_fit("a", "b", percent)).select("a", "b")


def common_counts(sets: list[np.ndarray], first: int, columns: int = 8192) -> np.ndarray:
    """How many values the first so many sets share with each of the others (with all of them if first is len(sets)):
    products of 0/1 matrices, so many columns at a time."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    place = np.cumsum(np.append(False, values[1:] != values[:-1]))
    often = np.bincount(place)[place] > 1
    place, owner = np.unique(place[often], return_inverse=True)[1], owner[often]
    rest = 0 if first == len(sets) else first
    out = np.zeros((first, len(sets) - rest), np.float32)
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
        i, j = np.searchsorted(place, (at, at + columns))
        here = np.zeros((len(sets), columns), np.float32)
        here[owner[i:j], place[i:j] - at] = 1
        out += here[:first] @ here[rest:].T
    return out.astype(np.int64)


def degrees(sets: DataFrame, labels: DataFrame, percent: int, most: int = 512, most_bytes: int = 8_000_000) -> DataFrame:
    """(fp, n_links): how many other classes each class is linked with. Links lie inside components, so all pairs of a
    component are compared: its classes are dealt by hash to slots of about `most` sets or most_bytes, and each pair of
    slots is one tile. Degrees leave a task, not links."""
    sized = labels.join(sets.select(F.col("fp").alias("node"), "n"), "node").groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("all"))
    slots = F.ceil(F.greatest(F.col("m") / most, F.col("all") * 8 / most_bytes))
    sized = stored(sized.where("m > 1").select("comp", "m", slots.alias("slots"), (F.col("all") * 8 * slots).alias("bytes")), "sized")
    rows, size = sized.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    groups = int(size // (2 * most_bytes)) + 1
    own, sized = _dealt(labels, sized.drop("bytes"), "comp", F.xxhash64("node"), rows // 1000 + 1)
    here = own.join(sized, ["comp", "part"]).select("comp", F.col("node").alias("fp"), "slots")
    here = _tiled(here, "comp", F.col("slots"), "fp")

    def run(t: pa.Table) -> pa.Table:
        comp, slot, lo, hi, n, fp = (t.column(c).to_numpy() for c in ("comp", "slot", "lo", "hi", "n", "fp"))
        packed = t.column("set")
        order = np.lexsort((slot, hi, lo, comp))
        new = np.zeros(len(order), np.bool_)
        for x in (comp, lo, hi):
            new[1:] |= x[order][1:] != x[order][:-1]
        found = np.zeros(len(fp), np.int64)
        for at in np.split(order, np.nonzero(new)[0]):
            cut = int((slot[at] == lo[at]).sum())  # rows of the tile's first slot stand first
            if len(at) < 2 or (lo[at[0]] != hi[at[0]] and cut in (0, len(at))):
                continue
            own = [np.frombuffer(packed[int(i)].as_buffer(), np.uint64) for i in at]
            rows, columns = at[:cut], at[cut:] if cut < len(at) else at
            same = common_counts(own, cut)
            linked = 100 * same >= percent * (n[rows][:, None] + n[columns] - same)
            if cut == len(at):
                np.fill_diagonal(linked, False)
                found[at] += linked.sum(axis=1)
            else:
                found[rows] += linked.sum(axis=1)
                found[columns] += linked.sum(axis=0)
        some = np.nonzero(found)[0]
        return pa.table({"fp": fp[some], "n_links": found[some]})

    whole = here.join(sets.select("fp", "n", "set"), "fp").withColumn("group", F.pmod(F.xxhash64("comp", "lo", "hi"), F.lit(groups)))
    return whole.groupBy("group").applyInArrow(run, "fp long, n_links long").groupBy("fp").agg(F.sum("n_links").alias("n_links"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """The key of a row: a hash of its id and text."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))


def compare(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, blocks: int, loss: float, rounds: int, leaders: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """summary of all rows; sets of the classes that share a block; labels (node, comp) of the classes with a link."""
    if percent < 75:
        raise ValueError("the bands and bounds hold for a similarity of 75 per cent or more")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), _rows(docs, id_col, text_col).alias("row"), F.col(text_col).cast("binary").alias("text"))
    summary = stored(summarise(docs, k, blocks, loss), "summary")
    met = stored(candidates(summary), "blocks")
    wanted = summary.where("fp is not null").groupBy("fp").agg(F.min("row").alias("row")).join(met.select("fp").distinct(), "fp", "left_semi").select("row")
    sets = class_sets(docs, wanted, k)

    links = tested = labels = rare = None
    for turn in range(rounds + 2):
        here = met.withColumn("comp", F.col("fp"))
        if labels is not None:
            here = met.join(labels, met.fp == labels.node, "left").withColumn("comp", F.coalesce("comp", "fp"))
        spread = here.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
        here = stored(here.join(spread, "key", "left_semi").select("key", "fp", "n", "weight", "comp"), "open")
        if here.isEmpty():
            break
        if turn < rounds:
            pairs = _pairs_with_leaders(here, turn, leaders if turn else 1)
        else:
            few, hot = _by_size(here, 64)
            if turn == rounds:
                rare = _rare_shingles(hot, sets, percent)
                pairs = _pairs_with_hubs(rare, percent)
            else:  # what is in large blocks now was in them before
                pairs = _pairs_of_few(few, sets, percent).unionByName(_pairs_by_rare_shingles(rare.drop("comp").join(hot, "fp"), percent))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if turn == rounds and pairs.isEmpty():
            continue
        found = verify(pairs, sets, percent)
        links = found if links is None else links.unionByName(found)
        tested = pairs if tested is None else tested.unionByName(pairs)
        labels = components(links)
    if links is None:
        labels = components(docs.sparkSession.createDataFrame([], "a long, b long"))
    labels = stored(labels.unionByName(labels.select(F.col("comp").alias("node"), "comp")).distinct(), "labels")
    return summary, sets, labels


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 75,
    blocks: int = 64,
    loss: float = 1e-6,
    rounds: int = 2,
    leaders: int = 2,
    count_links: bool = False,
) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, class_id and, with count_links, n_links.

    class_id is the smallest id of the texts with the same set, component_id that of all texts reachable by links.
    n_links counts the other classes that its class is linked with; the work for it grows with the square of a component. Similarities below 75 per cent are not supported: the
    bounds above are made for that. Classes and components that hold over a thousandth of all rows, a thousand at most,
    are dealt to parts of about that size in the joins on them."""
    summary, sets, labels = compare(docs, id_col, text_col, k, percent, blocks, loss, rounds, leaders)
    classes = summary.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("m"))
    least_hot = summary.count() // 1000 + 1
    linked = labels.withColumnRenamed("node", "fp").join(classes.drop("m"), "fp")
    if count_links:
        linked = linked.join(degrees(sets, labels, percent), "fp", "left")
    links = ["n_links"] * count_links
    linked = stored(linked, "linked")
    least = stored(linked.groupBy("comp").agg(F.min("class_id").alias("component_id"), F.count("*").alias("m")), "least")
    own, least = _dealt(linked, least, "comp", F.xxhash64("fp"), least_hot)
    linked = own.join(least, ["comp", "part"]).select("fp", "component_id", *links)
    alone = F.col("fp").isNull()
    # Rows without a set get a key of their own, so that they do not meet in one task.
    spread = F.coalesce("fp", F.xxhash64("doc_id", "row", F.lit("alone")))
    by_class = classes.join(linked, "fp", "left").select(F.col("fp").alias("key"), "class_id", "component_id", *links, "m")
    rows, by_class = _dealt(summary.select("doc_id", "n", "fp", "row", spread.alias("key")), by_class, "key", F.col("row"), least_hot)
    return (
        rows.join(by_class, ["key", "part"], "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component_id", "class_id")).alias("component_id"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            *(F.when(alone, 0).otherwise(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in links),
        )
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75, blocks: int = 64, loss: float = 1e-6, rounds: int = 2, leaders: int = 2
) -> DataFrame:
    """The documents (any columns), one of each component: a row with the smallest id, or one without an id if none has
    one; of rows with the same id and text any. Rows without a word stay."""
    summary, _, labels = compare(docs, id_col, text_col, k, percent, blocks, loss, rounds, leaders)
    first = summary.where("fp is not null").groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"))
    first = first.join(labels, first.fp == labels.node, "left").groupBy(F.coalesce("comp", "fp").alias("comp")).agg(F.min("best").alias("best"))
    best = first.select(F.col("best.row").alias("row"))
    name = "row"
    while name in docs.columns:
        name += "_"
    bare = F.btrim(F.col(text_col).cast("string"), F.lit(" \t\n\x0b\x0c\r"))
    empty = F.col(text_col).isNull() | (bare == "")
    kept = docs.where(~empty).withColumn(name, _rows(docs, id_col, text_col)).join(best.withColumnRenamed("row", name), name, "left_semi").dropDuplicates([name])
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(docs.where(empty))
