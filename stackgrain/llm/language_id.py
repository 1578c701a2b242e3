"""Language identification by interpolated Kneser-Ney models of characters.

A model is fitted for each language on a bounded sample of labelled texts: about ``train_docs`` documents a language,
chosen by a hash of their ids (the bound is the parameter; whole texts are used). Four-character counts come from one
Spark aggregation; lower orders use continuation counts. Each order is kept as a sorted array of hashed n-grams with
one log probability a language, and the backoff weights of contexts likewise; these arrays are broadcast, and their
size is bounded by the sample. A text gets the language of lowest cross-entropy a character. A tenth of the sample is
left out of the counts to calibrate: the sharpness of the score, and for each language the cross-entropy above which a
text counts as rejected (it is still given its likeliest language, as the contract asks).

Everything but letters is folded to single spaces, capitals to small letters. Null text, empty text and text without a
letter give ``und`` with score 0. Equal texts get equal predictions; a tie goes to the first language by name. With no
labelled text every prediction is ``und``. Texts are read whole, however long. Repeated rows are predicted row by row; an
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, fold, mix

ORDER = 4
_BITS = np.uint64(16)


@functools.cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), np.bool_)


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """16-bit codes of all texts, one array, and how many each text has (0 without a letter)."""
    is_letter = letters()
    parts, sizes = [], []
    for text in texts:
        c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where(is_letter[c], c, 32)
        keep = np.ones(len(c), np.bool_)
        keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
        c = c[keep]
        if len(c) == 0 or (len(c) == 1 and c[0] == 32):
            c = c[:0]
        parts.append(c)
        sizes.append(len(c))
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    return ((flat ^ (flat >> 16)) & 0xFFFF).astype(np.uint64), np.array(sizes, np.int64)


def grams(flat: np.ndarray, sizes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each code, packed 16 bits a character; before a text stand spaces."""
    out = flat.copy()
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for k in range(1, order):
        prior = np.full(len(flat), 32, np.uint64)
        prior[k:] = flat[:-k]
        prior[place < k] = 32
        out |= prior << np.uint64(16 * k)
    return out


def _inside(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), np.bool_)


def _suffix(keys: np.ndarray, k: int) -> np.ndarray:
    """The last k characters of packed n-grams."""
    return keys & np.uint64((1 << (16 * k)) - 1)


class KneserNey:
    """Log probabilities of several languages, by order: sorted hashes and one row of values each."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []
        self.unknown = np.zeros(len(languages), np.float32)
        self.sharpness, self.limits = 1.0, np.full(len(languages), np.inf)

    @classmethod
    def fit(cls, counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> KneserNey:
        """counts: by language the packed n-grams of the highest order and how often each was seen."""
        model = cls(sorted(counts))
        width = len(model.languages)
        for k in range(1, order + 1):
            own = []
            for name in model.languages:
                keys, n = counts[name]
                if k < order:
                    # Continuation counts: distinct (k + 1)-grams by their suffix.
                    longer = np.unique(_suffix(keys, k + 1))
                    keys, n = np.unique(_suffix(longer, k), return_counts=True)
                own.append((keys, n.astype(np.float64)))
            union = np.unique(np.concatenate([a for a, _ in own]))
            lower = model.log_prob(_suffix(union, k - 1), k - 1) if k > 1 else None
            logs = np.empty((len(union), width), np.float32)
            contexts = np.unique(union >> _BITS)
            weights = np.zeros((len(contexts), width), np.float32)
            for j, (keys, n) in enumerate(own):
                once, twice = (n == 1).sum(), (n == 2).sum()
                d = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
                seen, at = np.unique(keys >> _BITS, return_inverse=True)
                total, kinds = np.bincount(at, n), np.bincount(at)
                where, there = _inside(keys, union)
                c = np.where(there, n[where], 0.0)
                cx, known = _inside(seen, union >> _BITS)
                t = np.where(known, total[cx], 1.0)
                back = np.where(known, d * kinds[cx] / t, 1.0)
                below = np.exp(lower[:, j].astype(np.float64)) if k > 1 else 1.0 / 65536
                logs[:, j] = np.log(np.maximum(c - d, 0) / t + back * below)
                place = np.searchsorted(contexts, seen)
                weights[place, j] = np.log(d * kinds / total)
                if k == 1:
                    model.unknown[j] = np.log(d * kinds[0] / total[0] / 65536)
            for keys, values, into in ((union, logs, model.grams), (contexts, weights, model.contexts)):
                hashed = mix(keys)
                by = np.argsort(hashed)
                into.append((hashed[by], values[by]))
        return model

    def log_prob(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Natural logarithms of the probability of each packed k-gram's last character, a column a language."""
        hashes, values = self.grams[k - 1]
        at, there = _inside(hashes, mix(keys))
        out = values[at].copy()
        miss = np.nonzero(~there)[0]
        if len(miss) and k == 1:
            out[miss] = self.unknown
        elif len(miss):
            contexts, weights = self.contexts[k - 1]
            cx, known = _inside(contexts, mix(keys[miss] >> _BITS))
            out[miss] = np.where(known[:, None], weights[cx], 0) + self.log_prob(_suffix(keys[miss], k - 1), k - 1)
        return out

    def entropies(self, texts: list[str | None]) -> np.ndarray:
        """Cross-entropy a character of each text, a column a language; NaN where there is no letter."""
        flat, sizes = codes(texts)
        out = np.full((len(texts), len(self.languages)), np.nan)
        some = np.nonzero(sizes)[0]
        if len(some):
            distinct, at = np.unique(grams(flat, sizes), return_inverse=True)
            logs = self.log_prob(distinct, ORDER)
            start = (np.cumsum(sizes) - sizes)[some]
            for j in range(len(self.languages)):
                out[some, j] = -np.add.reduceat(logs[:, j][at].astype(np.float64), start) / sizes[some]
        return out

    def posteriors(self, entropy: np.ndarray) -> np.ndarray:
        z = -self.sharpness * (entropy - entropy.min(axis=1, keepdims=True))
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)

    def calibrate(self, entropy: np.ndarray, truth: list[str], quantile: float = 0.999, slack: float = 1.05) -> None:
        """Sharpness of greatest likelihood, and each language's largest usual cross-entropy."""
        index = np.array([self.languages.index(t) for t in truth], np.int64)
        best = -np.inf
        for sharpness in np.geomspace(0.5, 64, 22):
            self.sharpness, kept = sharpness, self.sharpness
            p = self.posteriors(entropy)[np.arange(len(index)), index] if len(index) else np.ones(1)
            gain = np.log(np.maximum(p, 1e-9)).mean()
            if gain <= best + 1e-6:
                self.sharpness = kept
            best = max(best, gain)
        for j in range(len(self.languages)):
            own = entropy[index == j, j]
            if len(own):
                self.limits[j] = np.quantile(own, quantile) * slack


def fit_languages(labelled: DataFrame, train_docs: int = 3000) -> KneserNey | None:
    """The model of (doc_id, text, lang); about train_docs documents a language are used."""
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, train_docs / n)).otherwise(share)
    sample = labelled.where((draw < share) & F.col("text").isNotNull())
    left_out = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("calibration")), F.lit(10)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            for name in sorted(set(langs)):
                mine = [t for t, x in zip(texts, langs, strict=True) if x == name]
                for _, some in chunks(mine, mine):
                    keys, n = np.unique(grams(*codes(some)), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "key", "n"],
                    )

    counted = sample.where(~left_out).select("lang", "text").mapInArrow(count, "lang string, key long, n long")
    got = counted.groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()  # bounded by the sample
    if not len(got):
        return None
    by_lang = {}
    for name, own in got.groupby("lang"):
        keys = own["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        by_lang[name] = (keys[order], own["n"].to_numpy()[order])
    model = KneserNey.fit(by_lang)
    check = sample.where(left_out & F.col("lang").isin(list(by_lang))).select("lang", "text")
    rows = predict_entropies(check, model).toPandas()
    if len(rows):
        entropy = np.array(rows["entropy"].tolist(), np.float64)
        fine = ~np.isnan(entropy).any(axis=1)
        model.calibrate(entropy[fine], [x for x, ok in zip(rows["lang"], fine, strict=True) if ok])
    return model


def predict_entropies(texts: DataFrame, model: KneserNey) -> DataFrame:
    """(lang, entropy array) of (lang, text)."""
    given = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            for names, some in chunks(langs, texts):
                entropy = given.value.entropies(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(entropy.tolist(), pa.list_(pa.float64()))],
                    names=["lang", "entropy"],
                )

    return texts.mapInArrow(run, "lang string, entropy array<double>")


def identify(docs: DataFrame, model: KneserNey | None, held_out=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score, cross_entropy, rejected."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, texts = (c.to_pylist() for c in batch.columns)
            for numbers, some in chunks([*range(len(ids))], texts):
                m, n = given.value, len(some)
                name, score, cross, rejected = ["und"] * n, np.zeros(n), [None] * n, [True] * n
                entropy = m.entropies(some) if m else np.full((n, 1), np.nan)
                fine = np.nonzero(~np.isnan(entropy[:, 0]))[0]
                if len(fine):
                    p = m.posteriors(entropy[fine])
                    for i, j, q in zip(fine.tolist(), entropy[fine].argmin(axis=1).tolist(), p.max(axis=1), strict=True):
                        name[i], score[i], cross[i] = m.languages[j], q, float(entropy[i, j])
                        rejected[i] = bool(entropy[i, j] > m.limits[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in numbers], pa.int64()), pa.array([held[i] for i in numbers], pa.bool_()),
                     pa.array(name), pa.array(score), pa.array(cross, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(held_out if held_out is not None else F.lit(False), F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    schema = "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"
    return source.mapInArrow(run, schema)


def identify_documents(docs: DataFrame, train_docs: int = 3000) -> DataFrame:
    """The contract's folds: documents whose crc32 modulo 5 is 0 are held out, the model learns from labelled others."""
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    labelled = docs.where(~held & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    return identify(docs, fit_languages(labelled, train_docs), held_out=held)
