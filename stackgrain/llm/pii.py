"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions trained in numpy.

The patterns give the base spans. The network is trained on the base spans of a bounded sample of documents
(about ``train_docs``; of their windows at most ``windows``), each text as it is and once more with its spans rewritten
into forms that the patterns miss: written-out at-signs and dots, spaced or bracketed dots, other separators, numbers
that run into one another, phones without their plus. It tags characters as outside, beginning or inside one of the four
kinds. It reads overlapping windows around digits, at-signs and bracketed words at and dot: every kind of span holds one,
so other places cannot begin or end a span. Each window is decoded with the CRF's best path; where windows overlap, each
character takes the tag of the window in whose middle it lies best, and spans are formed over the whole text from these
tags. Spans that no base span touches are added when their form is plausible (card numbers must pass Luhn, parts of an
address be at most 255) and the network is sure of every character; how sure it has to be is calibrated on windows held
out from training.

Positions are code points of the text, ends exclusive. Null or empty text: no span. Very long texts are read whole,
window by window. Of spans that touch, base ones stay and of the network's the first. Repeated rows give equal results;
an empty table gives an empty result, and without any training span only base spans are given. Only the id and text
columns are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_rows

KINDS = ("email", "ip", "card", "phone")
# The patterns of the contract. An email is found from its at-sign, whose local part is the run of
# LOCAL before it, and a run of digits is never entered in its middle: the same matches, in linear time on long runs.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def base_spans(text: str | None) -> list[Span]:
    if not text:
        return []
    out: list[Span] = []
    if "@" in text:
        out += [(s, 0, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        for m in IP.finditer(text):
            if all(int(x) <= 255 for x in m[0].split(".") if len(x.lstrip("0")) <= 3) and all(len(x.lstrip("0")) <= 3 for x in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# --- characters and windows ---

SYMBOLS = "@.-_+()%:/ \n,;=\"'[]"
N_CODES = len(SYMBOLS) + 4
_CODES = np.full(128, N_CODES - 1, np.int64)
for _i, _c in enumerate(SYMBOLS):
    _CODES[ord(_c)] = _i
_CODES[ord("0") : ord("9") + 1] = len(SYMBOLS)
_CODES[ord("a") : ord("z") + 1] = len(SYMBOLS) + 1
_CODES[ord("A") : ord("Z") + 1] = len(SYMBOLS) + 2

WIDTH, STEP = 64, 32
N_TAGS = 1 + 2 * len(KINDS)  # outside; beginning and inside of each kind


def char_codes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(c < 128, _CODES[np.minimum(c, 127)], N_CODES - 1)


def window_starts(text: str) -> list[int]:
    """Starts of windows that overlap by half and cover every trigger with room on both sides."""
    starts: list[int] = []
    for m in _TRIGGER.finditer(text):
        first = max(0, (m.start() - STEP) // STEP)
        for k in (first, first + 1):
            if (not starts or k * STEP > starts[-1]) and k * STEP < len(text):
                starts.append(k * STEP)
    return starts


def gold_tags(n: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(n, np.int64)
    for s, kind, e in spans:
        if not tags[s:e].any():
            tags[s] = 1 + 2 * kind
            tags[s + 1 : e] = 2 + 2 * kind
    return tags


def _card(r: np.random.Generator) -> str:
    digits = "".join(map(str, r.integers(0, 10, 15)))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def rewritten(own: str, kind: int, r: np.random.Generator) -> str:
    """A span's text in a form that the patterns miss."""
    pick = lambda *x: x[int(r.integers(len(x)))]
    if kind == 0:
        name, _, host = own.partition("@")
        at, dot = pick((" (at) ", "."), ("[at]", "."), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" @ ", "."), ("@", "[dot]"), (" (at) ", " (dot) "))
        return name + at + host.replace(".", dot)
    if kind == 1:
        return own.replace(".", pick("[.]", "(.)", " . ", ",", "[dot]"))
    digits = re.sub("[^0-9]", "", own)
    if kind == 2:
        return pick(".", "/", "_", "  ", " - ").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    tail = f"{digits[-7:-4]}{pick('-', ' ', '.')}{digits[-4:]}"
    area, land = digits[-10:-7], digits[:-10]
    return pick(f"({area}) {tail}", f"{area}-{tail}", f"00{land} {area} {tail}", f"+{land}/{area}/{digits[-7:]}", f"{land} ({area}) {tail}", f"tel:{land}{area}{digits[-7:]}")


def broken(text: str, spans: list[Span]) -> tuple[str, list[Span]]:
    """The text with its spans rewritten, and where they are now. Some numbers get another one after a space, so that
    the patterns read both as one and drop it. The draw hangs on the text alone."""
    r = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))
    out, where, size, at = [], [], 0, 0
    for s, kind, e in spans:
        if s < at:
            continue
        out.append(text[at:s])
        size += s - at
        parts = [(kind, text[s:e])]
        if kind >= 2 and r.random() < 0.5:
            parts.append((2, _card(r)) if kind == 2 else (1, ".".join(map(str, r.integers(10, 256, 4)))))
        elif r.random() < 0.8:
            parts = [(kind, rewritten(text[s:e], kind, r))]
        for i, (k, own) in enumerate(parts):
            lead = " " * (i > 0)
            where.append((size + len(lead), k, size + len(lead) + len(own)))
            out.append(lead + own)
            size += len(lead) + len(own)
        at = e
    return "".join((*out, text[at:])), where


def windows_of(codes: np.ndarray, starts: list[int], fill: int = N_CODES - 1) -> np.ndarray:
    out = np.full((len(starts), WIDTH), fill, codes.dtype)
    for i, s in enumerate(starts):
        own = codes[s : s + WIDTH]
        out[i, : len(own)] = own
    return out


# --- the network ---


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Embedding, one LSTM in each direction, a linear layer and CRF transitions."""

    def __init__(self, size: int = 16, embed: int = 8, seed: int = 7):
        r = np.random.default_rng(seed)
        draw = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.size, self.limit = size, 0.8
        self.p = {"e": draw(N_CODES, embed), "out": draw(2 * size, N_TAGS), "out_b": np.zeros(N_TAGS, np.float32),
                  "move": np.zeros((N_TAGS, N_TAGS), np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": draw(embed, 4 * size), f"h{d}": draw(size, 4 * size), f"b{d}": np.zeros(4 * size, np.float32)}
            self.p[f"b{d}"][size : 2 * size] = 1  # remember at first

    def _lstm(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states of inputs (time, window, embedding), in the order given."""
        n, size = x.shape[1], self.size
        h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
        out = np.empty((len(x), n, size), np.float32)
        inputs = x @ self.p[f"x{d}"] + self.p[f"b{d}"]
        for t in range(len(x)):
            z = inputs[t] + h @ self.p[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * size])
            i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
            g = np.tanh(z[:, 3 * size :])
            before = (h, c)
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep is not None:
                keep.append((before, i, f, o, g, tc))
        return out

    def scores(self, codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Tag scores (time, window, tag) of windows of codes (window, time)."""
        x = self.p["e"][codes.T]
        kept: dict[str, list | None] = {"f": None, "b": None} if keep is None else {"f": [], "b": []}
        both = np.concatenate((self._lstm(x, "f", kept["f"]), self._lstm(x[::-1], "b", kept["b"])[::-1]), axis=2)
        if keep is not None:
            keep |= {"x": x, "both": both, **kept}
        return both @ self.p["out"] + self.p["out_b"]

    def _back_lstm(self, dh_all: np.ndarray, d: str, x: np.ndarray, kept: list, grad: dict) -> np.ndarray:
        size = self.size
        dz_all = np.empty((*dh_all.shape[:2], 4 * size), np.float32)
        dh, dc = np.zeros_like(dh_all[0]), np.zeros_like(dh_all[0])
        for t in range(len(x) - 1, -1, -1):
            (h0, c0), i, f, o, g, tc = kept[t]
            dh = dh + dh_all[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate((dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)), axis=1)
            dz_all[t] = dz
            grad[f"h{d}"] += h0.T @ dz
            dc = dc * f
            dh = dz @ self.p[f"h{d}"].T
        flat = dz_all.reshape(-1, 4 * size)
        grad[f"x{d}"] += x.reshape(-1, x.shape[2]).T @ flat
        grad[f"b{d}"] += flat.sum(axis=0)
        return dz_all @ self.p[f"x{d}"].T

    def _chains(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log sums of the CRF."""
        move = self.p["move"]
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[0] = score[0]
        for t in range(1, len(score)):
            alpha[t] = score[t] + _log_sum(alpha[t - 1][:, :, None] + move, 1)
        for t in range(len(score) - 2, -1, -1):
            beta[t] = _log_sum(move[None] + (score[t + 1] + beta[t + 1])[:, None, :], 2)
        return alpha, beta

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags under the CRF, and its gradients."""
        keep: dict = {}
        score = self.scores(codes, keep)
        steps, n, _ = score.shape
        move, gold = self.p["move"], tags.T
        alpha, beta = self._chains(score)
        z = _log_sum(alpha[-1], 1)
        at = np.arange(n)
        best = sum(score[t, at, gold[t]] for t in range(steps)) + sum(move[gold[t - 1], gold[t]] for t in range(1, steps))
        d_score = np.exp(alpha + beta - z[None, :, None])
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(steps):
            d_score[t, at, gold[t]] -= 1
            if t:
                pair = alpha[t - 1][:, :, None] + move + (score[t] + beta[t])[:, None, :] - z[:, None, None]
                grad["move"] += np.exp(pair).sum(axis=0)
                np.subtract.at(grad["move"], (gold[t - 1], gold[t]), 1)
        d_score /= n
        grad["move"] /= n
        grad["out"] = keep["both"].reshape(-1, 2 * self.size).T @ d_score.reshape(-1, N_TAGS)
        grad["out_b"] = d_score.sum(axis=(0, 1))
        d_both = d_score @ self.p["out"].T
        dx = self._back_lstm(d_both[:, :, : self.size], "f", keep["x"], keep["f"], grad)
        dx = dx + self._back_lstm(d_both[::-1, :, self.size :], "b", keep["x"][::-1], keep["b"], grad)[::-1]
        np.add.at(grad["e"], codes.T, dx)
        return float((z - best).mean()), grad

    def train(self, codes: np.ndarray, tags: np.ndarray, epochs: int = 12, batch: int = 32, rate: float = 0.02, seed: int = 3) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        r, step, losses = np.random.default_rng(seed), 0, []
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for epoch in range(epochs):
            order, total = r.permutation(len(codes)), 0.0
            for a in range(0, len(order), batch):
                own = order[a : a + batch]
                loss, grad = self.gradients(codes[own], tags[own])
                total += loss * len(own)
                step += 1
                pace = rate * (0.5 if epoch >= epochs // 2 else 1)
                for k, g in grad.items():
                    g = np.clip(g, -5, 5)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= (pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(total / len(codes))
        return losses

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best path of each window, and the posterior probability of each of its characters' kinds."""
        score = self.scores(codes)
        steps, n, _ = score.shape
        back = np.empty((steps, n, N_TAGS), np.int8)
        best = score[0]
        for t in range(1, steps):
            through = best[:, :, None] + self.p["move"]
            back[t] = through.argmax(axis=1)
            best = through.max(axis=1) + score[t]
        path = np.empty((steps, n), np.int64)
        path[-1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            path[t - 1] = back[t, np.arange(n), path[t]]
        alpha, beta = self._chains(score)
        sure = np.exp(alpha + beta - _log_sum(alpha[-1], 1)[None, :, None])
        kind = (path + 1) // 2  # a beginning and an inside of one kind count together
        same = (np.arange(N_TAGS) + 1) // 2
        right = (sure * (same[None, None, :] == kind[:, :, None])).sum(axis=2)
        return path.T, right.T


def reconcile(n: int, starts: list[int], paths: np.ndarray, sure: np.ndarray) -> list[tuple[Span, float]]:
    """Spans over a text of n characters from its decoded windows, with the least confidence along each."""
    tag, conf, depth = np.zeros(n, np.int64), np.zeros(n), np.full(n, -1)
    for i, s in enumerate(starts):
        m = min(WIDTH, n - s)
        inner = np.minimum(np.arange(m), WIDTH - 1 - np.arange(m))
        own = slice(s, s + m)
        better = inner > depth[own]
        tag[own] = np.where(better, paths[i, :m], tag[own])
        conf[own] = np.where(better, sure[i, :m], conf[own])
        depth[own] = np.maximum(depth[own], inner)
    spans, i = [], 0
    hot = np.nonzero(tag)[0]
    at = 0
    while at < len(hot):
        i = int(hot[at])
        kind, j = (int(tag[i]) + 1) // 2 - 1, i + 1
        while j < n and tag[j] == 2 + 2 * kind:
            j += 1
        if tag[i] % 2:  # it starts with a beginning
            spans.append(((i, kind, j), float(conf[i:j].min())))
        at = int(np.searchsorted(hot, j))
    return spans


def _plausible(text: str, span: Span) -> bool:
    s, kind, e = span
    own = text[s:e]
    groups = re.findall("[0-9]+", own)
    digits = sum(map(len, groups))
    if kind == 0:
        plain = re.sub(r"\s*[\[(]dot[\])]\s*", ".", re.sub(r"\s*[\[(]at[\])]\s*|\s*@\s*", "@", own))
        return plain.count("@") == 1 and bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", plain))
    if kind == 1:
        return len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups) and not re.search("[A-Za-z]", own.replace("[dot]", ""))
    if re.search("[A-Za-z@]", own):
        return False
    if kind == 2:
        return 12 <= digits <= 19 and luhn("".join(groups))
    return 9 <= digits <= 15 and len(own) <= 2 * digits


def model_spans(model: Tagger | None, texts: list[str | None], least_confidence: float | None) -> list[list[Span]]:
    """Spans the network is sure of, for each text; None takes the calibrated limit."""
    out: list[list[Span]] = [[] for _ in texts]
    if model is None:
        return out
    limit = model.limit if least_confidence is None else least_confidence
    rows, starts_of, where = [], [], []
    for i, text in enumerate(texts):
        starts = window_starts(text) if text else []
        if starts:
            rows.append(windows_of(char_codes(text), starts))
            starts_of.append(starts)
            where.append(i)
    if not rows:
        return out
    every = np.concatenate(rows)
    decoded = [model.decode(x) for x in np.array_split(every, -(-len(every) // 1024))]
    paths, sure = (np.concatenate([d[k] for d in decoded]) for k in (0, 1))
    at = 0
    for i, starts in zip(where, starts_of, strict=True):
        own = slice(at, at + len(starts))
        at += len(starts)
        for span, confidence in reconcile(len(texts[i]), starts, paths[own], sure[own]):
            if confidence >= limit and _plausible(texts[i], span):
                out[i].append(span)
    return out


def training_windows(docs: DataFrame, id_col: str, text_col: str, train_docs: int) -> DataFrame:
    """(codes, tags) of the windows of about train_docs documents that hold a digit or an at-sign, chosen by hash; of
    those with spans once more with the spans rewritten."""
    text = F.col(text_col)
    some = docs.where(text.rlike("[0-9@]")).select(F.pmod(F.xxhash64(F.col(id_col), text), F.lit(1 << 40)).alias("h"), text.alias("text"))
    n = some.count()
    chosen = some.where(F.col("h") < int(min(1.0, train_docs / max(n, 1)) * (1 << 40))).select("text")

    def run(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        for (texts,) in batches:
            for t in texts:
                spans = base_spans(t)
                for own, where in ((t, spans), broken(t, spans)) if spans else ((t, spans),):
                    starts = window_starts(own)
                    codes = windows_of(char_codes(own), starts).astype(np.uint8)
                    tags = windows_of(gold_tags(len(own), where), starts, fill=0).astype(np.uint8)
                    yield [[c.tobytes() for c in codes], [x.tobytes() for x in tags]]

    return map_rows(chosen, run, "codes binary, tags binary")


def fit_tagger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = 400, epochs: int = 14, windows: int = 4000) -> Tagger | None:
    """The network, trained on the base spans of about train_docs documents and at most so many windows."""
    rows = training_windows(docs, id_col, text_col, train_docs).orderBy(F.xxhash64("codes"), "codes", "tags").limit(8 * windows).collect()
    if not rows:
        return None
    codes = np.frombuffer(b"".join(r["codes"] for r in rows), np.uint8).reshape(-1, WIDTH).astype(np.int64)
    tags = np.frombuffer(b"".join(r["tags"] for r in rows), np.uint8).reshape(-1, WIDTH).astype(np.int64)
    marked = tags.any(axis=1)
    if not marked.any():
        return None
    # No more windows without a span than with one.
    with_span = np.nonzero(marked)[0][: windows // 2]
    without = np.nonzero(~marked)[0][: max(len(with_span), 64)]
    own = np.concatenate((with_span, without))
    held = np.arange(len(own)) % 5 == 0
    model = Tagger()
    model.train(codes[own[~held]], tags[own[~held]], epochs)
    model.limit = calibrated(model, codes[own[held]], tags[own[held]])
    return model


def calibrated(model: Tagger, codes: np.ndarray, tags: np.ndarray, precision: float = 0.97, floor: float = 0.5) -> float:
    """The least confidence at which so many of the spans that the network finds in held-out windows are right. Spans
    at a window's edge, which go on outside, do not count."""
    seen = []
    for path, sure, gold in zip(*model.decode(codes), tags, strict=True):
        found, want = reconcile(WIDTH, [0], path[None], sure[None]), {x for x, _ in reconcile(WIDTH, [0], gold[None].astype(np.int64), sure[None])}
        seen += [(confidence, span in want) for span, confidence in found if span[0] > 0 and span[2] < WIDTH]
    seen.sort(reverse=True)
    limit, right = 0.95, 0
    for i, (confidence, good) in enumerate(seen, 1):
        right += good
        if right >= precision * i:
            limit = confidence
    return max(floor, min(0.95, limit))


def merged(base: list[Span], more: list[Span]) -> list[Span]:
    """Model spans that touch no base span, as kinds after the base kinds."""
    return [(s, len(KINDS) + k, e) for s, k, e in more if not any(a < e and s < b for a, _, b in base)]


NAMES = (*KINDS, *(f"model_{k}" for k in KINDS))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{NAMES[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = 400, least_confidence: float | None = None
) -> DataFrame:
    """One row a document: counts of base spans, their digest, all spans as text, and how many the model added."""
    given = docs.sparkSession.sparkContext.broadcast(fit_tagger(docs, id_col, text_col, train_docs))

    def run(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        for ids, texts in batches:
            for own, some in chunks(ids, texts):
                rows = []
                for text, more in zip(some, model_spans(given.value, some, least_confidence), strict=True):
                    base = base_spans(text)
                    added = merged(base, more)
                    n = [sum(k == i for _, k, _ in base) for i in range(4)]
                    rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added)))
                yield [own, *map(list, zip(*rows, strict=True))]

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_model long"
    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, schema)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in capitals, in brackets."""
    out, at = [], 0
    for s, k, e in sorted(spans):
        if s >= at:
            out += (text[at:s], f"[{KINDS[k % len(KINDS)].upper()}]")
        at = max(at, e)
    return "".join((*out, text[at:]))


def redact_documents(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars", id_col: str = "doc_id",
                     train_docs: int = 400, least_confidence: float | None = None) -> DataFrame:
    """The documents with personal data replaced; size_col, where there is one, counts the new text's characters."""
    given = docs.sparkSession.sparkContext.broadcast(fit_tagger(docs, id_col, text_col, train_docs))
    at, size = docs.columns.index(text_col), docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            done, n = [], []
            for _, some in chunks(texts, texts):
                for text, more in zip(some, model_spans(given.value, some, least_confidence), strict=True):
                    base = base_spans(text)
                    spans = base + merged(base, more)
                    done.append(redact(text, spans) if spans else text)
                    n.append(len(done[-1]) if spans else None)
            columns = batch.columns
            columns[at] = pa.array(done, columns[at].type)
            if size is not None:
                old = columns[size].to_pylist()
                columns[size] = pa.array([a if b is None else b for a, b in zip(old, n, strict=True)], columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
