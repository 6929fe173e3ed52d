"""Language of documents: a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import crc_remainder, sampled_texts, small_batches, unused

UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")

# The network reads lower case; all other ASCII bytes that are no letters look like a space.
SYMBOL = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)])
SPACE = 32
# Languages up to which a batch of windows has its full size; more take smaller ones, so memory is bounded.
FEW = 64


@dataclass(frozen=True)
class Training:
    """Bounds and steps of the training; the sample is the only thing the driver gathers."""

    docs_per_language: int = 500
    docs: int = 32_000  # of all languages; more languages get fewer documents each, but one at least
    chars: int = 1_024  # of a document, at a place that its hash tells
    windows: int = 160  # in a step
    window: int = 64  # bytes
    steps: int = 300  # for up to 64 languages, and in proportion for more
    rate: float = 0.02
    hidden: int = 10
    seed: int = 42


class ByteGRU:
    """One layer in each direction, and a softmax over the languages at every byte.

    ``inputs`` are the rows that a byte adds to the gates (its embedding times the input weights, plus
    bias). Gates are stacked as reset, update, candidate. Arrays hold one column per window, so all windows
    of a batch take a step together.
    """

    def __init__(self, languages: list[str], hidden: int, seed: int = 42):
        random = np.random.default_rng(seed)
        shape = {"inputs": (2, 3 * hidden, 256), "state": (2, 3 * hidden, hidden), "out": (len(languages), 2 * hidden)}
        self.languages, self.hidden = languages, hidden
        self.p = {k: random.normal(0, 0.3, v).astype(np.float32) for k, v in shape.items()}
        self.p["bias"] = np.zeros((len(languages), 1), np.float32)

    def _run(self, symbols: np.ndarray, keep: bool) -> tuple[list[np.ndarray], list[list]]:
        """States of both directions after each step: arrays (time, hidden, windows)."""
        steps, n = symbols.shape
        h2, states, traces = 2 * self.hidden, [], []
        for way in (0, 1):
            table, weights = self.p["inputs"][way], self.p["state"][way]
            out = np.empty((steps, self.hidden, n), np.float32)
            h, trace = np.zeros((self.hidden, n), np.float32), []
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                x, g = table.take(symbols[t], axis=1), weights @ h
                gates = x[:h2]
                gates += g[:h2]
                np.negative(gates, out=gates)
                np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                reset, update = gates[: self.hidden], gates[self.hidden :]
                new = reset * g[h2:]
                new += x[h2:]
                np.tanh(new, out=new)
                if keep:
                    trace.append((t, h, reset, update, new, g[h2:]))
                h = (h - new) * update
                h += new
                out[t] = h
            states.append(out)
            traces.append(trace)
        return states, traces

    def _softmax(self, states: list[np.ndarray]) -> np.ndarray:
        """Probabilities (time, languages, windows)."""
        out = self.p["out"]
        scores = np.matmul(out[:, : self.hidden], states[0])
        scores += np.matmul(out[:, self.hidden :], states[1])
        scores += self.p["bias"]
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def label(self, symbols: np.ndarray) -> np.ndarray:
        """Probability of each language at each byte: (time, languages, windows)."""
        return self._softmax(self._run(symbols, keep=False)[0])

    def gradient(self, symbols: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all bytes, and its gradient by backpropagation through time."""
        steps, n = symbols.shape
        hidden, h2 = self.hidden, 2 * self.hidden
        states, traces = self._run(symbols, keep=True)
        error = self._softmax(states)
        loss = -float(np.log(error[:, target, np.arange(n)] + 1e-9).mean())
        error[:, target, np.arange(n)] -= 1
        error /= steps * n
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["bias"] = error.sum(axis=(0, 2))[:, None]
        for way in (0, 1):
            columns = slice(way * hidden, (way + 1) * hidden)
            grad["out"][:, columns] = np.einsum("tln,thn->lh", error, states[way])
            from_out = np.matmul(self.p["out"][:, columns].T, error)
            weights, dh = self.p["state"][way], np.zeros((hidden, n), np.float32)
            for t, before, reset, update, new, recurrent in reversed(traces[way]):
                dh = dh + from_out[t]
                d_new = dh * (1 - update) * (1 - new * new)
                d_update = dh * (before - new) * update * (1 - update)
                d_reset = d_new * recurrent * reset * (1 - reset)
                d_input = np.concatenate([d_reset, d_update, d_new])
                d_state = np.concatenate([d_reset, d_update, d_new * reset])
                one_hot = np.zeros((n, 256), np.float32)
                one_hot[np.arange(n), symbols[t]] = 1
                grad["inputs"][way] += d_input @ one_hot
                grad["state"][way] += d_state @ before.T
                dh = dh * update + weights.T @ d_state
        return loss, grad

    def train(self, texts: list[bytes], target: np.ndarray, how: Training) -> ByteGRU:
        """Adam on windows drawn at random; each language is drawn as often as any other."""
        random = np.random.default_rng(how.seed)
        ends = np.cumsum(np.bincount(target, minlength=len(self.languages)))
        of_language = np.split(np.argsort(target, kind="stable"), ends[:-1])
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        steps = how.steps * max(FEW, len(self.languages)) // FEW
        part = max(1, how.windows * FEW // max(FEW, len(self.languages)))
        for step in range(1, steps + 1):
            chosen = random.integers(0, len(self.languages), how.windows)
            docs = [random.choice(of_language[k]) for k in chosen]
            symbols = np.full((how.window, how.windows), SPACE)
            for j, doc in enumerate(docs):
                start = random.integers(0, max(1, len(texts[doc]) - how.window + 1))
                piece = SYMBOL[np.frombuffer(texts[doc][start : start + how.window], np.uint8)]
                symbols[: len(piece), j] = piece
            grad: dict[str, np.ndarray] = {}
            for a in range(0, how.windows, part):
                some = self.gradient(symbols[:, a : a + part], chosen[a : a + part])[1]
                share = len(chosen[a : a + part]) / how.windows
                grad = {k: g if share == 1 else grad.get(k, 0) + share * g for k, g in some.items()}
            rate = how.rate * min(1, 2 * (1 - step / (steps + 1)))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1, 1 / (norm + 1e-9))
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                self.p[k] -= (rate * change).astype(np.float32)
        return self

    def documents(self, texts: list[str | None], window: int = 128, batch: int = 2048) -> np.ndarray:
        """Mean probability of each language over all bytes of each text: (texts, languages).

        Every byte is labelled; a text is read in windows, which start without memory.
        """
        data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(d) for d in data], np.int64)
        n_windows = -(-sizes // window)
        whole = np.frombuffer(b"".join(data), np.uint8)
        owner = np.repeat(np.arange(len(data)), n_windows)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        start = np.repeat(np.cumsum(sizes) - sizes, n_windows) + place * window
        length = np.minimum(window, sizes[owner] - place * window)
        total = np.zeros((len(data), len(self.languages)))
        batch = max(1, batch * FEW // max(FEW, len(self.languages)))
        offsets = np.arange(window)[:, None]
        for a in range(0, len(owner), batch):
            part = slice(a, a + batch)
            inside = offsets < length[part]
            at = np.minimum(start[part] + offsets, len(whole) - 1)
            symbols = np.where(inside, SYMBOL[whole[at]], SPACE)
            probability = self.label(symbols)
            probability *= inside[:, None, :]
            np.add.at(total, owner[part], probability.sum(axis=0, dtype=np.float64).T)
        return total / np.maximum(sizes, 1)[:, None]


def train_language_model(
    labelled: DataFrame, how: Training | None = None, text: str = "text", lang: str = "lang", doc_id: str = "doc_id"
) -> ByteGRU | None:
    """A model learned from a bounded sample: of each language the documents first in a hash order, of each of them at most
    ``how.chars`` characters.

    Rows without language or without a letter in the text are left out. Every value of ``lang`` is a
    language, however many there are. Without any language to learn from there is no model: None.
    """
    how = how or Training()
    rows = labelled.select(F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(
        r"lang is not null and text rlike '\\p{L}'"
    )
    sample = sampled_texts(
        rows.selectExpr("lang as kind", "xxhash64(lang, doc_id, text) as place", "text"), how.docs_per_language, how.docs, how.chars
    )
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    texts = [t.encode("utf-8", "surrogatepass") for _, t in sample]
    number = {lang: k for k, lang in enumerate(languages)}
    target = np.array([number[lang] for lang, _ in sample])
    return ByteGRU(languages, how.hidden, how.seed).train(texts, target, how)


def language(text: Column, model: ByteGRU | None) -> Column:
    """``struct(lang_pred, score)`` of a text column.

    ``score`` is the mean probability of the predicted language over all bytes. A text that is null
    or has no letter is ``und`` with score 0, as is every text without a model.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            known = [model is not None and t is not None and bool(LETTER.search(t)) for t in texts]
            out = pd.DataFrame({"lang_pred": UNDETERMINED, "score": 0.0}, index=range(len(texts)))
            if any(known):
                shares = model.documents(list(texts[known]))
                out.loc[known, "lang_pred"] = np.array(model.languages, object)[shares.argmax(axis=1)]
                out.loc[known, "score"] = np.clip(shares.max(axis=1), 0, 1)
            yield out

    # A filter on what is predicted must not be moved below it, where it would predict once more.
    return predicted.asNondeterministic()(text)


def keep_known(
    docs: DataFrame, model: ByteGRU | None, least: float, wanted: list[str] | None = None, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` whose language is one of ``wanted`` (any by default) and predicted with a score of ``least`` or
    more; ``lang`` becomes the prediction, all other columns stay.

    Texts that are null or have no letter have no language and go, as do all texts without a model.
    """
    found = unused(docs, "found")
    told = small_batches(docs).withColumn(found, language(F.col(f"`{text}`"), model))
    kept = told.where(F.col(f"`{found}`.lang_pred") != UNDETERMINED).where(F.col(f"`{found}`.score") >= least)
    if wanted is not None:
        kept = kept.where(F.col(f"`{found}`.lang_pred").isin(wanted))
    return kept.select(*[F.col(f"`{found}`.lang_pred").alias(c) if c == lang else F.col(f"`{c}`") for c in docs.columns])


def identify(
    docs: DataFrame, modulus: int = 3, held_out: int = 1, how: Training | None = None
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs(doc_id, text, lang)``.

    Documents whose id's crc32 leaves ``held_out`` modulo ``modulus`` are not learned from; nor
    are rows without id. Predictions see the text only. Repeated rows give
    repeated results; other columns are ignored. An empty table gives no rows.
    """
    remainder = crc_remainder("doc_id", modulus)
    model = train_language_model(docs.where((remainder != held_out) & (remainder >= 0)), how)
    return small_batches(docs).select(
        "doc_id", (remainder == held_out).alias("held_out"), language(F.col("text"), model).alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")
