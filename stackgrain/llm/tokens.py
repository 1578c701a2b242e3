"""Token ids of whole texts by the tokenizers library, fast enough for a corpus.

The tokenizer splits a text into pieces before its merges, so equal pieces always give equal ids; a worker therefore
asks the library once for each distinct run between white space, and keeps what it has learnt from task to task. Texts
are cut into runs and their distinct runs found by Arrow; ids are then gathered by numpy. Runs are split the way the vocabulary file says (NFC, white space
dropped, lower case, split into contractions, letter runs, single digits and runs of other characters). This is done
here only for characters below U+0250, whose case and class never changed between Unicode versions and which NFC
leaves alone; a white-space separated run with any other character goes to the library as it is. A file with other
rules is used through the library alone, text by text.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

assert sys.byteorder == "little" and array("I").itemsize == 4

DEFAULT_FILE = "word_bpe_49k.json"
_EASY = 0x250
# The rules of the vocabulary file that this module follows itself.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


def _char_class(*starts: str) -> str:
    return "".join(f"\\u{c:04x}" for c in range(_EASY) if unicodedata.category(chr(c)).startswith(starts))


def _byte_chars() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte: itself where Latin-1 prints it, and
    else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def follows_the_rules(path: str) -> bool:
    """Whether the file splits texts as this module does."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    normal = [x.get("type") for x in (given.get("normalizer") or {}).get("normalizers", [])]
    parts = (given.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = [(x.get("pattern") or {}).get("Regex") for x in parts if x.get("type") == "Split"]
    plain = all(x["content"].startswith("<|") for x in given.get("added_tokens", []))
    return plain and normal == _NORMALIZERS and split == [_SPLIT] and [x.get("type") for x in parts] == ["Split", "ByteLevel"]


class PieceIds(dict):
    """Little-endian 32-bit ids by piece. Emptied when full: memory stays bounded."""

    def __init__(self, path: str, most: int = 400_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.most, self.split = self.tokenizer.model, most, follows_the_rules(path)
        self.byte_chars = _byte_chars()
        letter, number, space = _char_class("L"), _char_class("N"), "\\x09-\\x0d\\x20\\x85\\xa0"
        self.pieces = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+"
        ).findall
        self.hard = re.compile(f"[^\\x00-{chr(_EASY - 1)}]|İ|<\\|").search
        self.of_run = RunIds(self, most + most // 4)

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        found = self[piece] = self.ask(piece)
        return found

    def ask(self, piece: str) -> bytes:
        written = piece
        if not (piece.isascii() and piece.isprintable()):
            written = piece.encode().decode("latin-1").translate(self.byte_chars)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids of the whole text as little-endian unsigned 32-bit integers."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each text's followed by end if that is given, and how many each
        text has. Null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self.split:
            cut = pc.ascii_split_whitespace(texts)
            runs, bounds = cut.flatten().dictionary_encode(), cut.offsets.to_numpy()
            code = runs.indices.to_numpy()
            own = [*map(self.of_run.__getitem__, runs.dictionary.to_pylist())]
            bounds = bounds - bounds[0]
        else:
            own = [*map(self.library, texts.to_pylist())]
            code, bounds = np.arange(len(own)), np.arange(len(own) + 1)
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        flat = np.frombuffer(b"".join(own), "<u4")
        starts, n = np.cumsum(sizes) - sizes, sizes[code]
        ends = np.concatenate(([0], np.cumsum(n)))
        ids = flat[np.repeat(starts[code] - ends[:-1], n) + np.arange(ends[-1])]
        ends = ends[bounds]
        if end is not None:
            ids = np.insert(ids, ends[1:], end)
        return ids.astype("<u4", copy=False), np.diff(ends) + (end is not None)


@lru_cache(maxsize=1)
def piece_ids(path: str) -> PieceIds:
    """One for each worker process, so that tasks find what those before them have learnt."""
    return PieceIds(path)


class RunIds(dict):
    """Ids by white-space separated run, one level above the pieces. When full, only the runs that are met again are
    carried on, so that frequent ones stay and memory stays bounded."""

    def __init__(self, pieces: PieceIds, most: int):
        super().__init__()
        self.pieces, self.most, self.before = pieces, most, {}

    def __missing__(self, run: str) -> bytes:
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        found = self.before.get(run)
        if found is None:
            p = self.pieces
            if run.isalpha() and run.isascii():
                found = array("I", [t.id for t in p.model.tokenize(run.lower())]).tobytes()
            elif p.hard(run):
                found = p.library(run)
            else:
                pieces = p.pieces(run.lower())
                found = p.ask(pieces[0]) if len(pieces) == 1 else b"".join(map(p.__getitem__, pieces))
        self[run] = found
        return found
