"""Secret scans: fixed patterns, and novelty under dictionary-primed zstandard.

A string in a sensitive context is reported (kind ``novel``) when it stays incompressible although the compressor was
primed with a dictionary of identifiers and with the text around the string: its *marginal* compressed bytes
(with the string less without it) are close to its length. Words, identifiers and repeated values cost few marginal
bytes. A context is a word like password, token or key shortly before on the same line, a bearer or basic header, or the
place of a password in a URL. A string begins after ``=`` and ``:``, so the name in ``name=value`` is context. The dictionary
holds a few words of configurations and the identifiers that most documents of the corpus have on lines with such
words: letters and underscores alone, in several documents, so that a secret is none, and bounded in number and bytes.
Strings of one class of characters (letters of one case, digits alone) need a higher
novelty and more length, because a word that the dictionary lacks is as new to the compressor as a secret. Strings that
a pattern has found already are measured too: n_confirmed counts the novel spans that touch a base span, n_novel those
that no pattern has found.

Null or empty text: no span. Texts are scanned whole, however long; of candidates that overlap, the first counts. Rows are independent, so repeated rows give equal results and
an empty table gives an empty result. Only the id and the text column are read; others may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

KINDS = ("assign", "access", "hex", "novel")
# The patterns of the contract.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a greedy run of 24 or more is the run that [0-9a-f]+ finds

#: What makes the text before a string a sensitive context.
CONTEXT = re.compile(
    r"(?:(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|signing|encryption)[_ -]?key|credentials?|bearer|authorization|basic)"
    r"[\"']?[^A-Za-z0-9\n]{1,8}(?:(?:(?:is|was|as|in|of|for|the|to|value|key|set|new|basic|bearer)[^A-Za-z0-9\n]{1,4}){0,4}"
    r"|(?:[A-Za-z]{1,12}[^A-Za-z0-9\n]{1,3}){0,3}[A-Za-z]{1,12}\x20?[:=>\"'`(\[]\x20?)"
    r"|://[^\s/:@]{1,64}:)$",
    re.ASCII,
)
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "authorization", "basic", "://")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~!%^*$#-]{8,}")
PART = re.compile(r"[^=]+(?:=+$)?")  # of a candidate: names and values apart, padding kept
NAME = re.compile(r"[A-Za-z][a-z]*(?:_?[A-Za-z]+)*")
_CLASSES = [re.compile(x) for x in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")]
IDENTIFIERS = (
    b"password passwd secret token api_key apikey access_key private_key credential authorization bearer "
    b"username user_name hostname localhost database connection_string default_value example placeholder "
    b"changeme your_api_key_here insert_token_here none null true false undefined self.config settings "
    b"os.environ process.env getenv configuration parameters request response session certificate encryption "
)


def learn_identifiers(docs: DataFrame, text_col: str = "text", most: int = 1500, most_bytes: int = 16_000, least_docs: int = 5) -> bytes:
    """The identifiers that most documents have on lines with a word of HINTS, the most frequent last, as the compressor
    likes them; of equal counts the smaller one counts as more frequent. Only so many, and so many bytes, leave Spark."""

    def run(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        for (texts,) in batches:
            counts: Counter[str] = Counter()
            for text in texts:
                low = (text or "").lower()
                if any(x in low for x in HINTS):
                    lines = (line for line in text.split("\n") if any(x in line.lower() for x in HINTS))
                    counts.update({w for line in lines for w in NAME.findall(line) if 4 <= len(w) <= 32})
            yield [list(counts), list(counts.values())]

    counted = map_rows(docs.select(text_col), run, "name string, n long").groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") >= least_docs)
    names = [r["name"] for r in counted.orderBy(F.desc("n"), "name").limit(most).collect()]
    out = b""
    for name in names:
        if len(out) + len(name) >= most_bytes:
            break
        out = name.encode() + b" " + out
    return IDENTIFIERS + out


def novelty(candidate: str, before: str, after: str, identifiers: bytes = IDENTIFIERS) -> float:
    """Marginal compressed bytes of candidate for each of its bytes, given the identifiers and the text around."""
    around = (before + "\n" + after).encode("utf-8", "replace")
    prime = zstandard.ZstdCompressionDict(identifiers + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compress = zstandard.ZstdCompressor(level=19, dict_data=prime, write_checksum=False, write_content_size=False).compress
    lead = before[-32:].encode("utf-8", "replace")
    own = candidate.encode()
    return (len(compress(lead + own)) - len(compress(lead))) / len(own)


def classes(own: str) -> int:
    """How many classes of characters a string mixes; a leading capital and inner hyphens or dots count for nothing."""
    own = re.sub(r"(?<=[A-Za-z])[-_.](?=[A-Za-z])", "", own[:1].lower() + own[1:])
    return sum(c.search(own) is not None for c in _CLASSES)


def find_spans(text: str | None, radius: int = 512, least: float = 0.7, identifiers: bytes = IDENTIFIERS) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, in order; kind indexes KINDS."""
    if not text:
        return []
    low = text.lower()
    spans = []
    if "password" in low or "passwd" in low or "secret" in low or "token" in low or "api" in low:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(x in low for x in HINTS):
        for m in CANDIDATE.finditer(text):
            for part in PART.finditer(text, m.start(), m.end()):
                s, own = part.start(), part[0].rstrip(".!")
                if len(own) < 8 or not CONTEXT.search(text, max(0, s - 96), s):
                    continue
                e, single = s + len(own), classes(own) < 2
                if single and len(own) < 16:
                    continue
                if novelty(own, text[max(0, s - radius) : s], text[e : e + radius], identifiers) >= (least + 1) / 2 * single + least * (not single):
                    spans.append((s, 3, e))
    return sorted(spans)


def joined(spans: list[tuple[int, int, int]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 512, least_novelty: float = 0.7, identifiers: bytes | None = None
) -> DataFrame:
    """One row a document: counts by kind, the digest of the pattern spans and all spans as text. identifiers: the
    dictionary; by default it is learned from these documents."""
    known = learn_identifiers(docs, text_col) if identifiers is None else identifiers

    def run(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        for ids, texts in batches:
            rows = []
            for text in texts:
                spans = find_spans(text, radius, least_novelty, known)
                n = [sum(k == i for _, k, _ in spans) for i in range(4)]
                base = [x for x in spans if x[1] < 3]
                again = sum(any(s < f and b < e for b, _, f in base) for s, k, e in spans if k == 3)
                digest = hashlib.sha256(joined(base, KINDS).encode()).hexdigest()
                rows.append((*n[:3], digest, joined(spans, KINDS), n[3] - again, again))
            yield [ids, *map(list, zip(*rows, strict=True))] if rows else [ids, *([] for _ in range(7))]

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long, n_confirmed long"
    return map_rows(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run, schema)
