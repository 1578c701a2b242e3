"""Quality rules with weak supervision, in DataFrame functions only.

Each rule looks at a document's counts and votes good (1), bad (-1) or abstains (0). A two-coin model estimates how
often each rule is right on good and on bad documents by expectation-maximisation, without labels; the posterior
probability of being good then decides. Expectation-maximisation needs only how many documents share each vote
pattern, so it runs on an aggregate of at most 3 ** rules rows whatever the corpus. All counts scale with the corpus:
pseudo-counts are a share of the documents, so copies of a whole corpus give the same posteriors.

Null or empty text: all counts 0, ``base_failed`` true, not kept. Repeated rows are counted and decided alike. An empty
table gives an empty result. Input columns beside the id and text keep their names and are never read by the rules;
``quality_filter`` returns exactly the input's columns, so clashing names cannot arise.

Eight-word windows of a document are compared by their 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# White space and symbols of the contract.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent short words of the languages that the corpus is expected to hold.
COMMON = ["the", "of", "and", "to", "in", "that", "for", "with", "de", "la", "que", "les", "des", "et", "en", "el",
          "los", "las", "y", "un", "der", "die", "und", "das", "den", "von", "mit", "zu"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body with value computed once: a lambda over an array of one element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(w: Column) -> Column:
    """Words of array w that lie in a window of eight found at least twice in it."""
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(w[i + k] for k in range(WINDOW))))

    def covered(h: Column) -> Column:
        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), twice)

    def twice(s: Column) -> Column:
        last = F.size(s) - 1
        again = F.filter(
            s,
            lambda e, j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["x"] == e["x"]))
            | ((j < last) & (s[F.least(j + 1, last)]["x"] == e["x"])),
        )
        places = F.sort_array(F.transform(again, lambda e: e["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )

    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    return F.when(n < WINDOW, 0).otherwise(some)


def counts(text: Column) -> Column:
    """One struct of a text's counts."""
    text = F.coalesce(text, F.lit(""))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("long")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(COMMON))).cast("long").alias("n_common"),
            F.size(F.filter(w, lambda x: ~F.rlike(x, F.lit(r"\p{L}")))).cast("long").alias("n_bare"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    bare = F.btrim(text, F.lit(SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    return F.struct(
        let(words, of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        left(SPACES).alias("word_chars"),
        left(f"[^{SYMBOLS}]+").alias("n_symbols"),
        left(r"[^\p{L}]+").alias("n_letters"),
        left(r"[^\p{Lu}]+").alias("n_upper"),
        left(r"[^!?]+").alias("n_shouts"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules(c: Callable[[str], Column]) -> dict[str, Column]:
    """The votes by name; c gives a count. Ratios are compared multiplied out: no division by zero."""
    words, chars = c("n_words"), c("word_chars")
    return {
        "length": _vote((words >= 50) & (words <= 100_000), words < 20),
        "repetition": _vote(c("n_repeat_words") * 20 <= words, c("n_repeat_words") * 10 > words * 3),
        "lines": _vote((c("n_lines") >= 3) & (c("n_dup_lines") == 0), c("n_dup_lines") * 10 > c("n_lines") * 3),
        "symbols": _vote(c("n_symbols") * 200 <= chars, c("n_symbols") * 40 > chars),
        "word_length": _vote((chars >= words * 3) & (chars <= words * 9), (chars * 2 < words * 5) | (chars > words * 12)),
        "capitals": _vote(c("n_upper") * 100 <= c("n_letters") * 15, c("n_upper") * 10 > c("n_letters") * 4),
        "letters": _vote(c("n_letters") * 100 >= chars * 85, c("n_letters") * 100 < chars * 75),
        "shouts": _vote(c("n_shouts") * 20 <= words, c("n_shouts") * 5 > words),
        "bare": _vote(c("n_bare") * 20 <= words, c("n_bare") * 5 > words),
        "common": _vote(c("n_common") * 20 >= words, (words >= 50) & (c("n_common") == 0)),
    }


FIELDS = {
    "n_words": "w.n_words", "word_chars": "word_chars", "n_symbols": "n_symbols", "n_dup_lines": "l.n_dup_lines",
    "n_repeat_words": "w.n_repeat_words", "n_common": "w.n_common", "n_bare": "w.n_bare", "n_lines": "l.n_lines", "n_letters": "n_letters",
    "n_upper": "n_upper", "n_shouts": "n_shouts",
}


def _fields(column: str) -> Callable[[str], Column]:
    return lambda name: F.col(f"{column}.{FIELDS[name]}")


def base_failed(c: Callable[[str], Column]) -> Column:
    return (c("n_words") < 20) | (c("n_repeat_words") * 100 > c("n_words") * 30)


class VoteModel:
    """Accuracy of each rule on good and on bad documents, and the share of good ones."""

    def __init__(self, prior: float, right: list[tuple[float, float]]):
        self.prior, self.right = prior, right

    def log_odds(self, votes: list[int]) -> float:
        total = math.log(self.prior / (1 - self.prior))
        for v, (good, bad) in zip(votes, self.right, strict=True):
            total += math.log(good / (1 - bad)) if v > 0 else math.log((1 - good) / bad) if v < 0 else 0.0
        return total

    def posterior(self, votes: list[Column]) -> Column:
        """The same as a Spark expression."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for v, (good, bad) in zip(votes, self.right, strict=True):
            total = total + F.when(v > 0, math.log(good / (1 - bad))).when(v < 0, math.log((1 - good) / bad)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


#: Where accuracies start and what pseudo-counts pull them to: a rule hardly ever fires on a good document, and finds
#: only one of several kinds of bad ones.
START = (0.99, 0.2)


def fit_votes(patterns: list[tuple[list[int], int]], k: int, rounds: int = 100, strength: float = 0.005) -> VoteModel:
    """Expectation-maximisation over (votes of k rules, how many documents).

    Pseudo-counts weigh the given share of all documents. A rule stays informative: a bad vote is always likelier on a
    bad document than on a good one, so that no class can turn into the other."""
    total = sum(n for _, n in patterns)
    model = VoteModel(0.8, [START] * k)
    for _ in range(rounds if total else 0):
        good_all = 0.0
        sums = [[0.0] * 4 for _ in range(k)]  # right and all votes on good, right and all votes on bad
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, model.log_odds(votes)))))
            good_all += n * p
            for s, v in zip(sums, votes, strict=True):
                if v:
                    s[0] += n * p * (v > 0)
                    s[1] += n * p
                    s[2] += n * (1 - p) * (v < 0)
                    s[3] += n * (1 - p)
        pseudo = strength * total
        right = []
        for a, b, c, d in sums:
            good = min(0.999, max(0.5, (a + START[0] * pseudo) / (b + pseudo)))
            bad = (c + START[1] * pseudo) / (d + pseudo)
            right.append((good, min(0.999, max(2 * (1 - good), bad))))
        new = VoteModel(min(0.99, max(0.01, (good_all + 0.8 * pseudo) / (total + pseudo))), right)
        moved = max(
            abs(new.prior - model.prior),
            *(abs(x - y) for a, b in zip(new.right, model.right, strict=True) for x, y in zip(a, b, strict=True)),
        )
        model = new
        if moved < 1e-6:
            break
    return model


def _patterns(voted: DataFrame, names: list[str]) -> list[tuple[list[int], int]]:
    rows = voted.groupBy(*names).count().collect()  # at most 3 ** rules rows
    return sorted(([r[x] for x in names], r["count"]) for r in rows)


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row a document: its counts, votes, posterior and verdict."""
    c = _fields("c")
    counted = docs.select(F.col(id_col).cast("long").alias("doc_id"), counts(F.col(text_col)).alias("c"))
    names = [f"vote_{x}" for x in rules(c)]
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    voted = stored(
        counted.select(
            "doc_id",
            *(c(x).alias(x) for x in shown),
            base_failed(c).alias("base_failed"),
            *(v.cast("int").alias(n) for n, v in zip(names, rules(c).values(), strict=True)),
        ),
        "votes",
    )
    model = fit_votes(_patterns(voted, names), len(names))
    p = model.posterior([F.col(x) for x in names])
    return voted.select(
        "doc_id", *shown, "base_failed", (~F.col("base_failed") & (p >= least)).alias("kept"),
        F.round(p, 6).alias("posterior"), *names,
    )


def quality_filter(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that score_quality keeps, with all their columns. Texts are counted once: rows are stored with
    their votes until the model is fitted."""
    name = "votes"
    while name in docs.columns:
        name += "_"
    c = _fields(name)
    votes = rules(c)
    counted = docs.withColumn(name, counts(F.col(text_col)))
    kept = F.struct(base_failed(c).alias("failed"), *(v.cast("tinyint").alias(n) for n, v in votes.items()))
    voted = stored(counted.withColumn(name, kept), "voted")
    names = [f"v{i}" for i in range(len(votes))]
    model = fit_votes(_patterns(voted.select(*(F.col(f"{name}.{v}").alias(n) for n, v in zip(names, votes, strict=True))), names), len(names))
    good = model.posterior([F.col(f"{name}.{v}") for v in votes]) >= least
    return voted.where(~F.col(f"{name}.failed") & good).select(*(F.col(f"`{x}`") for x in docs.columns))
