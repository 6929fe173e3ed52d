"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over tokens."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import sampled_texts, small_batches

# The base patterns, and the least lengths of what they must find.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "crf")

# Words that announce a secret, for the context of a token.
KEYWORDS = (
    "password passwd passphrase pwd secret token apikey api_key api-key access_key secret_key private_key auth_token "
    "authorization bearer credential credentials key"
).split()

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
LEAST_SPAN = 8  # characters of a span that the field may add
REDACTED = "[REDACTED]"


@dataclass(frozen=True)
class Training:
    """Bounds and steps of the training; the sample is the only thing the driver gathers."""

    docs: int = 400  # each of documents with and without a base match
    chars: int = 20_000  # of a sampled document
    window: int = 24  # tokens
    made_up: int = 1000
    steps: int = 70
    rate: float = 0.3
    decay: float = 1e-4
    seed: int = 42


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, value_start)`` of the base matches, by start and kind."""
    found = []
    if (":" in text or "=" in text) and any(k in (low := text.lower()) for k in ("pass", "secret", "token", "key")):
        long = (m for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= ASSIGN_LEAST)
        found += [(m.start(), 0, m.end(), m.start(2)) for m in long]
    if "AKIA" in text:
        long = (m for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST)
        found += [(m.start(), 1, m.end(), m.start()) for m in long]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


# ---- tokens and their features -------------------------------------------------------------

CHAR = np.full(128, 6, np.uint8)  # other symbols
CHAR[:33] = 0
CHAR[127] = 0
for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "_+/-"), 1):
    CHAR[[ord(c) for c in chars]] = k
LOWERED = np.arange(128, dtype=np.uint64)
LOWERED[65:91] += 32
POWERS = np.array([pow(1_000_003, k, 2**64) for k in range(32)], np.uint64)
KEYWORD_HASHES = np.array(
    [sum(ord(c) * pow(1_000_003, k, 2**64) for k, c in enumerate(word)) % 2**64 for word in KEYWORDS], np.uint64
)

# Coarse kinds of a token, for its neighbours.
NOTHING, WORD, KEY, ASSIGNS, QUOTE, DOT, SYMBOL, WITH_DIGIT, LONG = range(9)
FEATURES = {"shape": 100, "changes": 4, "before": 9, "before2": 9, "before3": 9, "after": 9, "file": 8}
LENGTHS = np.array([4, 8, 16, 24, 40])


@dataclass
class Tokens:
    """Tokens of several texts: runs of word characters or of symbols, with their features."""

    text: np.ndarray  # number of the text
    start: np.ndarray  # in the text, in code points
    end: np.ndarray
    features: dict[str, np.ndarray]
    counts: np.ndarray  # per text: tokens, those that look like data, keywords


def file_feature(counts: np.ndarray) -> np.ndarray:
    share = counts[:, 1] / np.maximum(counts[:, 0], 1)
    return np.searchsorted([0.001, 0.02, 0.1], share, "right") * 2 + (counts[:, 2] > 0)


def tokenize(texts: list[str]) -> Tokens:
    """All tokens of all texts, by whole-array operations on the code points."""
    joined = " \n ".join([*texts, ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_codes = np.minimum(codes, 127)
    kind = CHAR[ascii_codes]
    kind[codes >= 128] = 1
    del codes
    group = np.where(kind == 0, 0, np.where(kind <= 4, 1, 2)).astype(np.int8)
    change = np.flatnonzero(np.diff(group, prepend=0, append=0))
    begins = change[change < len(group)]
    begins = begins[group[begins] > 0]
    ends = change[np.searchsorted(change, begins, "right")]

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return total[ends] - total[begins]

    lower, upper, digit, joint = (count(kind == k) for k in (1, 2, 3, 4))
    length = ends - begins
    symbols = group[begins] == 2
    changes = count(np.concatenate([[False], (kind[1:] == 3) != (kind[:-1] == 3)])) if len(kind) else length
    has = ((lower > 0) * 1 + (upper > 1) * 2 + (digit > 0) * 4 + (joint > 0) * 8).astype(np.int16)
    first = ascii_codes[begins]
    sign = np.select(
        [np.isin(first, [ord("="), ord(":")]), np.isin(first, [34, 39, 96]), first == ord(".")], [ASSIGNS, QUOTE, DOT], SYMBOL
    )
    bucket = np.searchsorted(LENGTHS, length, "right")
    shape = np.where(symbols, 96 + sign - ASSIGNS, has * 6 + bucket)

    at = np.arange(len(kind), dtype=np.int32)
    place = at - np.maximum.accumulate(np.where(np.diff(group, prepend=0) != 0, at, 0))
    value = LOWERED[ascii_codes] * POWERS[np.minimum(place, 31)]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    keyword = np.isin(total[ends] - total[begins], KEYWORD_HASHES) & (length <= 14)

    coarse = np.select(
        [symbols, keyword, (length >= 16) & (digit > 0), digit > 0, length >= 24], [sign, KEY, LONG, WITH_DIGIT, LONG], WORD
    )
    sizes = np.array([len(t) + 3 for t in texts], np.int64)
    offsets = np.cumsum(sizes) - sizes
    text = np.searchsorted(offsets, begins, "right") - 1

    def neighbour(by: int) -> np.ndarray:
        out = np.full(len(coarse), NOTHING)
        if by > 0 and len(out) > by:
            out[by:] = np.where(text[by:] == text[:-by], coarse[:-by], NOTHING)
        elif by < 0 and len(out) > -by:
            out[:by] = np.where(text[:by] == text[-by:], coarse[-by:], NOTHING)
        return out

    marks = (np.ones(len(text)), coarse >= WITH_DIGIT, keyword)
    counts = np.stack([np.bincount(text, mark, len(texts)) for mark in marks], axis=1)
    features = {
        "shape": shape,
        "changes": np.searchsorted([1, 3, 6], changes, "right"),
        "before": neighbour(1),
        "before2": neighbour(2),
        "before3": neighbour(3),
        "after": neighbour(-1),
        "file": file_feature(counts)[text],
    }
    start = begins - offsets[text]
    return Tokens(text, start, start + length, features, counts)


# ---- the field ------------------------------------------------------------------------------


class Field:
    """Scores of labels given features, and of neighbouring labels. A text begins and ends outside."""

    def __init__(self):
        self.p = {name: np.zeros((size, 3)) for name, size in FEATURES.items()}
        self.p["steps"] = np.zeros((3, 3))

    def scores(self, features: dict[str, np.ndarray]) -> np.ndarray:
        return sum(self.p[name][values] for name, values in features.items())

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The best labels of all tokens, by Viterbi's algorithm.

        Where being outside leads by more than any change of two steps can bring, every best
        labelling is outside; the texts fall apart there, and only the stretches between are searched,
        all of them together.
        """
        scores, steps = self.scores(tokens.features), self.p["steps"]
        labels = np.zeros(len(scores), np.int64)
        lead = scores[:, OUTSIDE] - np.maximum(scores[:, BEGIN], scores[:, INSIDE])
        open_ = np.flatnonzero(lead <= 2 * (steps.max() - steps.min()))
        if not len(open_):
            return labels
        breaks = (np.diff(open_) > 1) | (np.diff(tokens.text[open_]) != 0)
        heads = np.concatenate([[0], np.flatnonzero(breaks) + 1])
        sizes = np.diff(np.append(heads, len(open_)))
        order = np.argsort(-sizes, kind="stable")
        heads, sizes = open_[heads[order]], sizes[order]
        best = steps[OUTSIDE] + scores[heads]
        came: list[np.ndarray] = []
        last = np.zeros((len(heads), 3))
        for t in range(1, sizes[0] + 1):
            n = np.searchsorted(-sizes, -t, "right")  # stretches of at least t tokens
            longer = np.searchsorted(-sizes, -(t + 1), "right")
            last[longer:n] = best[longer:n]
            if longer == 0:
                break
            ways = best[:longer, :, None] + steps
            came.append(ways.argmax(axis=1))
            best = ways.max(axis=1) + scores[heads[:longer] + t]
        label = (last + steps[:, OUTSIDE]).argmax(axis=1)
        for t in range(sizes[0] - 1, -1, -1):
            n = np.searchsorted(-sizes, -(t + 1), "right")
            labels[heads[:n] + t] = label[:n]
            if t:
                label[:n] = came[t - 1][np.arange(n), label[:n]]
        return labels

    def gradient(self, features: dict[str, np.ndarray], labels: np.ndarray, real: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log-likelihood; arrays are (time, sequences), ``real`` marks what is no padding.

        Forward and backward sums give the expected counts; padding counts as outside for certain.
        """
        steps = self.p["steps"]
        scores = self.scores(features)
        scores[~real] = [0, -1e9, -1e9]
        length, n = labels.shape
        forward, backward = np.empty((length, n, 3)), np.empty((length, n, 3))
        total = lambda x, axis: (top := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(
            np.exp(x - top).sum(axis=axis)
        )
        forward[0] = steps[OUTSIDE] + scores[0]
        for t in range(1, length):
            forward[t] = scores[t] + total(forward[t - 1][:, :, None] + steps, 1)
        backward[-1] = steps[:, OUTSIDE]
        for t in range(length - 2, -1, -1):
            backward[t] = total(steps + (scores[t + 1] + backward[t + 1])[:, None, :], 2)
        norm = total(forward[-1] + steps[:, OUTSIDE], 1)
        chance = np.exp(forward + backward - norm[:, None])
        missed = (np.eye(3)[labels] - chance) * real[:, :, None]
        used = real.sum()
        grad = {}
        for name, size in FEATURES.items():
            flat = features[name].ravel()
            grad[name] = np.stack([np.bincount(flat, missed[:, :, y].ravel(), size) for y in range(3)], axis=1) / used
        pairs = np.exp(
            forward[:-1, :, :, None] + steps + (scores[1:] + backward[1:])[:, :, None, :] - norm[:, None, None]
        )
        both = (real[:-1] & real[1:])[:, :, None, None]
        seen = np.eye(3)[labels[:-1]][:, :, :, None] * np.eye(3)[labels[1:]][:, :, None, :]
        grad["steps"] = ((seen - pairs) * both).sum(axis=(0, 1)) / used
        return grad

    def train(self, features: dict[str, np.ndarray], labels: np.ndarray, real: np.ndarray, how: Training) -> Field:
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, how.steps + 1):
            for k, g in self.gradient(features, labels, real).items():
                g -= how.decay * self.p[k]
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.p[k] += how.rate * change
        return self


# ---- training -------------------------------------------------------------------------------


def made_up_line(random: np.random.Generator, words: list[str]) -> tuple[str, int, int]:
    """A line with a secret of a common format, or with something that only looks like one (then empty)."""
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    hexes, capitals = np.array(list("0123456789abcdef")), np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    draw = lambda symbols, low, high: "".join(random.choice(symbols, random.integers(low, high)))
    before = " ".join(random.choice(words, random.integers(2, 8)))
    after = " ".join(random.choice(words, random.integers(2, 8)))
    value = [
        lambda: draw(letters, 20, 44),
        lambda: draw(hexes, 32, 65),
        lambda: "AKIA" + draw(capitals, 16, 17),
        lambda: random.choice(["ghp_", "gho_", "sk_live_", "xoxb-", "glpat-", "AIza"]) + draw(letters, 24, 40),
        lambda: draw(letters, 24, 40) + "/" + draw(letters, 8, 20),
    ][random.integers(5)]()
    if random.random() < 0.35:
        number = lambda n: draw(np.array(list("0123456789")), n, n + 1)
        look = [
            f"{random.choice(words)}@{random.choice(words)}.com",
            f"+{number(2)} {number(3)} {number(7)}",
            f"{number(3)}-{number(3)}-{number(4)}",
            f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}",
            f"https://www.{random.choice(words)}.com/{random.choice(words)}/{number(4)}",
            f"20{number(2)}-0{number(1)}-1{number(1)}",
            f"{number(1)}.{number(1)}.{number(2)}",
            f"{random.choice(words)} = {number(2)}",
            f"{random.choice(words)}: {random.choice(words)}",
            f"{random.choice(KEYWORDS)}: {random.choice(words)}",
        ][random.integers(10)]
        return f"{before} {look} {after}", 0, 0
    key = random.choice(KEYWORDS)
    lead = random.choice(
        [f"{key} = ", f'{key} = "', f"{key}=", f'"{key}": "', f"{key}: ", "Authorization: Bearer ", "", f"export {key.upper()}="]
    )
    close = '"' if lead.endswith('"') else ""
    start = len(before) + 1 + len(lead)
    return f"{before} {lead}{value}{close} {after}", start, start + len(value)


def train_field(docs: DataFrame, how: Training | None = None, text: str = "text") -> Field:
    """A field learned from base matches in a bounded sample of documents, and from made-up lines.

    The sample is what comes first in a hash order of the texts, with and without a match. Without any
    documents the made-up lines are all there is.
    """
    how = how or Training()
    rows = docs.select(F.col(text).alias("text")).where("text is not null")
    likely = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{12}"
    found = sampled_texts(
        rows.select(F.col("text").rlike(likely).alias("kind"), F.xxhash64("text").alias("place"), "text"),
        how.docs,
        chars=how.chars,
    )
    plain = [text for has, text in found if not has]
    texts = [text for has, text in found if has] + plain
    random = np.random.default_rng(how.seed)
    words = [w for t in plain[:100] for w in re.findall(r"[^\W\d_]+", t)[:50]] or ["and", "the", "of"]
    lines = [made_up_line(random, words) for _ in range(how.made_up)]
    spans = [[(value, end) for _, _, end, value in base_spans(t)] for t in texts]
    spans += [[(a, b)] if b else [] for _, a, b in lines]
    tokens = tokenize(texts + [line for line, _, _ in lines])
    labels = np.zeros(len(tokens.text), np.int64)
    heads = np.searchsorted(tokens.text, np.arange(len(spans) + 1))
    for k, marked in enumerate(spans):
        part = slice(heads[k], heads[k + 1])
        for a, b in marked:
            inside = np.flatnonzero((tokens.start[part] < b) & (tokens.end[part] > a)) + heads[k]
            labels[inside[1:]] = INSIDE
            labels[inside[:1]] = BEGIN
    # Windows of tokens: around the secrets, from each made-up line, and some from anywhere.
    centres = np.flatnonzero(labels == BEGIN)
    anywhere = random.integers(0, max(1, len(labels)), how.docs) if len(labels) else centres
    firsts = np.unique(np.concatenate([centres, anywhere, heads[len(texts) : -1]])) - how.window // 2
    at = firsts + np.arange(how.window)[:, None]
    inside = (at >= 0) & (at < len(labels))
    at = np.clip(at, 0, max(0, len(labels) - 1))
    if not len(labels):
        return Field()
    centre = np.clip(firsts + how.window // 2, 0, len(labels) - 1)
    real = inside & (tokens.text[at] == tokens.text[centre])
    features = {k: v[at] for k, v in tokens.features.items()}
    return Field().train(features, np.where(real, labels[at], 0), real, how)


# ---- scanning -------------------------------------------------------------------------------


# Runs of characters that are one token, as in ``tokenize``.
WORDS = r"[A-Za-z0-9_+/\-\u0080-\U0010ffff]+"
SIGNS = r"[^\x00-\x20\x7fA-Za-z0-9_+/\-\u0080-\U0010ffff]+"
RUNS = (re.compile(WORDS), re.compile(SIGNS))
RUN = re.compile(f"{WORDS}|{SIGNS}")


def pieces(texts: list[str], most: int) -> Iterator[tuple[int, int, str]]:
    """``(number, start, piece)``: the texts, the longer ones cut behind the token that reaches ``most``
    characters, so no token is cut.
    """
    for k, text in enumerate(texts):
        start = 0
        while len(text) - start > most:
            end = start + most
            for run in RUNS:
                if run.match(text, end - 1) and (rest := run.match(text, end)):
                    end = rest.end()
            yield k, start, text[start:end]
            start = end
        if start < len(text) or not start:
            yield k, start, text[start:]


def margins(text: str, start: int, end: int, tokens: int) -> tuple[int, int]:
    """Where a part of a text starts and ends with ``tokens`` whole tokens more on both sides."""
    last = end
    for token in islice(RUN.finditer(text, end), tokens):
        last = token.end()
    reach = 16 * tokens
    while True:
        low = max(0, start - reach)
        heads = [t.start() for t in RUN.finditer(text, low, start)][1 if low else 0 :]  # the first one may be cut
        if len(heads) >= tokens or not low:
            return (heads[-tokens] if len(heads) >= tokens else 0), last
        reach *= 4


@dataclass
class Piece:
    """A part of a text to decode: spans that start in its inner part count."""

    number: int  # of the text
    offset: int
    text: str
    first: int = 0  # the inner part, in the piece
    last: int | None = None
    counts: np.ndarray | None = None  # of the whole text, if the piece is only a part


def scan(
    texts: list[str], field: Field, chunk_chars: int = 1_000_000, margin: int = 256
) -> list[tuple[list, list[tuple[int, int]]]]:
    """Per text its base spans, and the spans of the field that reach beyond what these hide.

    The field reads about ``chunk_chars`` characters at a time, and a longer text in pieces, so its
    memory is bounded. Pieces share ``margin`` tokens with those beside them, and know the features of
    the whole text.
    """
    added: list[list[tuple[int, int]]] = [[] for _ in texts]

    def parts() -> Iterator[Piece]:
        for k, text in enumerate(texts):
            if len(text) <= chunk_chars:
                yield Piece(k, 0, text)
                continue
            counts = sum(tokenize([piece]).counts for _, _, piece in pieces([text], chunk_chars))
            for _, start, piece in pieces([text], chunk_chars):
                low, high = margins(text, start, start + len(piece), margin)
                yield Piece(k, low, text[low:high], start - low, start - low + len(piece), counts[0])

    def decode(chunk: list[Piece]) -> None:
        tokens = tokenize([x.text for x in chunk])
        if any(x.counts is not None for x in chunk):
            counts = np.stack([own if x.counts is None else x.counts for x, own in zip(chunk, tokens.counts, strict=True)])
            tokens.features["file"] = file_feature(counts)[tokens.text]
        labels = field.decode(tokens)
        marked = np.flatnonzero(labels)
        if not len(marked):
            return
        first = np.ones(len(marked), bool)
        first[1:] = (np.diff(marked) > 1) | (np.diff(tokens.text[marked]) != 0) | (labels[marked[1:]] == BEGIN)
        last = np.append(first[1:], True)
        spans = zip(tokens.text[marked[first]], tokens.start[marked[first]], tokens.end[marked[last]], strict=True)
        for k, start, end in spans:
            part = chunk[k]
            if end - start >= LEAST_SPAN and part.first <= start and (part.last is None or start < part.last):
                added[part.number].append((part.offset + int(start), part.offset + int(end)))

    chunk, size = [], 0
    for part in parts():
        if chunk and size + len(part.text) > chunk_chars:
            decode(chunk)
            chunk, size = [], 0
        chunk.append(part)
        size += len(part.text)
    if chunk:
        decode(chunk)
    found = []
    for text, own in zip(texts, added, strict=True):
        base = base_spans(text)
        hidden = sorted((value, end) for _, _, end, value in base)
        starts = [a for a, _ in hidden]
        reached = [0, *accumulate((b for _, b in hidden), max)]  # by what starts before
        joins = [0, *accumulate(range(1, len(hidden)), lambda j, k: j if starts[k] <= reached[k] else k, initial=0)] if base else [0]
        # A span is covered if what starts at it or before joins up to its end.
        inside = [(s, e, bisect_left(starts, e)) for s, e in own]
        found.append((base, [(s, e) for s, e, k in inside if reached[k] < e or starts[joins[k]] > s]))
    return found


def secrets(text: Column, field: Field) -> Column:
    """A struct of what was found in a text: counts, digest of the base spans, all spans.

    Spans are ``kind:start:end`` in code points, by start and kind, joined by commas. A null text is
    an empty one: no spans, and the digest of nothing.
    """

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for base, added in scan([t or "" for t in texts], field):
                kinds = [x[1] for x in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                spans = _joined(sorted([*base, *((s, 3, e, s) for s, e in added)]))
                rows.append((*(kinds.count(k) for k in range(3)), digest, spans, len(added)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"])

    return found(text)


def _joined(spans: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def redacted(text: Column, field: Field) -> Column:
    """The text with every secret replaced; of an assignment only the value. Null stays null."""

    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = scan([t or "" for t in texts], field)
            spans = [[(value, end) for _, _, end, value in base] + added for base, added in found]
            masked_texts = [t and mask(t, s) for t, s in zip(texts, spans, strict=True)]
            yield pd.Series(masked_texts, dtype=object)

    return masked(text)


def mask(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with the union of ``spans`` replaced, one replacement for what touches."""
    out, end = [], 0
    for a, b in sorted(spans):
        if not out or a > end:
            out += [text[end:a], REDACTED]
        end = max(end, b)
    return "".join([*out, text[end:]])


def find_secrets(docs: DataFrame, how: Training | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf`` for every row of ``docs(doc_id, text)``.

    Repeated rows give repeated results; other columns are ignored.
    """
    field = train_field(docs, how)
    return small_batches(docs).select("doc_id", secrets(F.col("text"), field).alias("found")).select("doc_id", "found.*")
