"""What several operators share: input tables, the shared folder, word and hash helpers for tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that a task works on at once, so that its memory does not follow the batch size.
CHUNK_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or what setCheckpointDir() was given. Only a local
    session, whose executors are this machine, may name none: it then gets one in its warehouse."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoint"
        spark.sparkContext.setCheckpointDir(place)
    return place


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet into the shared folder and read back: later steps survive lost executors and
    do not compute it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: str, n: int):
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def map_rows(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow over plain rows: function takes an iterator of lists of columns (Python values) and yields
    lists of columns in the order of schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    out = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function([c.to_pylist() for c in b.columns] for b in batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, out, strict=True)], schema=out
            )

    return df.mapInArrow(run, schema)


def chunks(ids: list, texts: list, most: int = CHUNK_CHARS) -> Iterator[tuple[list, list]]:
    """Slices of a batch of at most so many characters (or bytes), but of one row at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and size + n > most:
            yield ids[start:i], texts[start:i]
            start, size = i, 0
        size += n
    if start < len(ids):
        yield ids[start:], texts[start:]


def array_chunks(texts: pa.Array, most: int = 4 * CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of slices of an Arrow array of texts of at most so many bytes, but of one row at least."""
    size = np.cumsum(np.append(0, pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)))
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(size, size[start] + most, side="right")) - 1)
        yield start, end
        start = end


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: A-Z in lower case, split at space and \\x09-\\x0D. bytes.lower() and bytes.split()
    treat ASCII alone, which is just that definition."""
    return text.lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes by word, kept for words seen before; emptied when full so that memory stays bounded."""

    def __init__(self, seed: int = 0, most: int = 400_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit values (multiply and xor-shift)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive values, order included."""
    k = len(h) - n + 1
    if k <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(k, np.uint64)
    for i in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[i : i + k]
    return mix(out)


def shingles(h: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; the whole sequence as one if there are fewer words."""
    if len(h) == 0:
        return h
    return np.unique(rolling(h, min(n, len(h))))
