"""Text quality learned from trusted positives and unlabelled text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import crc_remainder, hash_sample, small_batches

THRESHOLD = 0.3  # Fixed value: from this score on a text is predicted to be good.

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
UPPER, DIGIT = slice(65, 91), slice(48, 58)
PROSE = [ord(c) for c in ".,;'\"-"]
SYMBOLS = [b for b in range(33, 127) if not LETTER[b] and not 48 <= b < 58 and b not in PROSE]

FEATURES = (
    "words chars letters upper digits prose_marks symbols spaces lines word_length long_words distinct_words top_word "
    "distinct_pairs repeated_lines sentence_words top_symbol marked_words short_lines byte_entropy doubled_words distinct_triples"
).split()


def features(text: str | None) -> np.ndarray:
    """What a whole text looks like, as numbers that do not depend on its language."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, words = max(1, len(data)), data.split()
    n_words = max(1, len(words))
    letters = max(1, counts[LETTER].sum())
    lines = [line for line in data.split(b"\n") if line.strip()]
    n_lines = max(1, len(lines))
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    doubled = sum(a == b for a, b in zip(words, words[1:], strict=False))
    symbols = counts[SYMBOLS]
    share = counts[counts > 0] / n
    marked = sum(not LETTER[w[-1]] and w[-1] not in b".,;:!?)\"'" for w in words)
    return np.array(
        [
            np.log1p(len(words)),
            np.log1p(len(data)),
            letters / n,
            counts[UPPER].sum() / letters,
            counts[DIGIT].sum() / n,
            counts[PROSE].sum() / n,
            symbols.sum() / n,
            (counts[32] + counts[9:14].sum()) / n,
            n_lines / n_words,
            sum(map(len, words)) / n_words,
            sum(len(w) > 14 for w in words) / n_words,
            len(seen) / n_words**0.9,
            max(seen.values(), default=0) / n_words,
            pairs / n_words,
            1 - len(set(lines)) / n_lines,
            np.log1p(n_words / (1 + counts[46])),
            symbols.max() / n,
            marked / n_words,
            sum(len(line) < 30 for line in lines) / n_lines,
            -(share * np.log2(share)).sum() if len(share) else 0.0,
            doubled / n_words,
            triples / n_words,
        ]
    )


@dataclass(frozen=True)
class Training:
    """Bounds and steps of the training; the samples are the only thing the driver gathers."""

    positives: int = 3000
    unlabelled: int = 6000
    tails: tuple[float, ...] = (0.003, 0.006, 0.01, 0.015, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.35, 0.5)
    steps: int = 600
    rate: float = 0.2
    decay: float = 2e-5
    prior_step: float = 0.02


class QualityModel:
    """A logistic score that is additive in binned features.

    Learned by minimising the non-negative unbiased risk of Kiryo et al. (2017): with the class
    prior p, positives P and unlabelled texts U, it is ``p * loss(P, +) + max(0, loss(U, -) - p *
    loss(P, -))``. Where the second part would be negative the model has begun to memorise, and the
    step goes the other way in that part.
    """

    def __init__(self, unlabelled: np.ndarray, tails: tuple[float, ...]):
        # What is rare is at the ends of a feature, so bins are finer there.
        at = sorted({*tails, *(1 - t for t in tails)})
        cuts = np.quantile(unlabelled, at, axis=0) if len(unlabelled) else np.zeros((0, len(FEATURES)))
        self.cuts = [np.unique(cuts[:, k]) for k in range(len(FEATURES))]
        self.first = np.cumsum([0, *(len(c) + 1 for c in self.cuts)])
        self.weights, self.bias, self.prior = np.zeros(self.first[-1]), 0.0, 0.5

    def cells(self, rows: np.ndarray) -> np.ndarray:
        """Positions in ``weights``, one for each feature of each row."""
        bins = [np.searchsorted(cuts, rows[:, k], "right") for k, cuts in enumerate(self.cuts)]
        return np.stack(bins, axis=1) + self.first[:-1]

    def margin(self, cells: np.ndarray) -> np.ndarray:
        return self.weights[cells].sum(axis=1) + self.bias

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.cells(rows)), -30, 30)))

    def risks(self, positives: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
        """The two parts of the risk for rows of ``cells``: of positives as positive, and of negatives as negative."""
        mp, mu = self.margin(positives), self.margin(unlabelled)
        # Logistic loss: of being positive log(1 + exp(-m)), of being negative log(1 + exp(m)).
        return prior * np.logaddexp(0, -mp).mean(), np.logaddexp(0, mu).mean() - prior * np.logaddexp(0, mp).mean()

    def gradients(self, positives: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
        """The gradients of the two parts with respect to the weights and, last, the bias."""

        def down(cells: np.ndarray, slope: np.ndarray) -> np.ndarray:
            each = np.repeat(slope, cells.shape[1])
            return np.append(np.bincount(cells.ravel(), each, len(self.weights)), slope.sum()) / max(1, len(cells))

        good_p, good_u = (1 / (1 + np.exp(-self.margin(cells))) for cells in (positives, unlabelled))
        return prior * down(positives, good_p - 1), down(unlabelled, good_u) - prior * down(positives, good_p)

    def train(self, positives: np.ndarray, unlabelled: np.ndarray, prior: float, how: Training) -> QualityModel:
        self.prior = prior
        p, u = self.cells(positives), self.cells(unlabelled)
        size = len(self.weights)
        first, second = np.zeros(size + 1), np.zeros(size + 1)
        for step in range(1, how.steps + 1):
            positive, negative = self.gradients(p, u, prior)
            g = positive + (negative if self.risks(p, u, prior)[1] >= 0 else -negative)
            g[:size] += how.decay * self.weights
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            change = how.rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            self.weights -= change[:size]
            self.bias -= change[size]
        return self


def estimate_prior(positives: np.ndarray, unlabelled: np.ndarray, step: float) -> float:
    """The share of positives among the unlabelled: the largest that their distribution leaves room for.

    On any set of texts the unlabelled share is at least the prior times the positive share. Sets are the
    lower and upper tails of each feature; the one with the least bound, two standard deviations of
    sampling noise included, gives the estimate (best-bin estimation, Garg et al. 2021).
    """
    if not len(positives) or not len(unlabelled):
        return 0.5
    bound, prior = np.inf, 1.0
    for k in range(positives.shape[1]):
        for cut in np.unique(np.quantile(positives[:, k], np.linspace(step, 1 - step, 25))):
            for part_p, part_u in (
                ((positives[:, k] <= cut).mean(), (unlabelled[:, k] <= cut).mean()),
                ((positives[:, k] > cut).mean(), (unlabelled[:, k] > cut).mean()),
            ):
                if part_p > 0.2:
                    spread = part_u * (1 - part_u) / len(unlabelled) + part_p * (1 - part_p) / len(positives)
                    noise = 2 * np.sqrt(spread)
                    if (part_u + noise) / part_p < bound:
                        bound, prior = (part_u + noise) / part_p, part_u / part_p
    return float(np.clip(prior, 0.05, 0.99))


def train_quality(docs: DataFrame, labels: DataFrame, how: Training | None = None) -> QualityModel:
    """A model from bounded samples: positives of ``labels`` with their texts, and texts of any kind.

    Both are what comes first in a hash order of the ids. ``docs(doc_id, text)`` and
    ``labels(doc_id, quality)`` hold only what may be learned from. Of rows that share an id one
    text is used. Null texts count as empty; labels that are null are left out.
    """
    how = how or Training()
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("place")).where("doc_id is not null")
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.xxhash64("doc_id").alias("place"))

    def ids(of: DataFrame, wanted: int) -> DataFrame:
        return hash_sample(of.select(F.lit(True).alias("kind"), "place"), wanted).select("place")

    def looks(chosen: DataFrame) -> np.ndarray:
        @F.pandas_udf("array<double>")
        def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series([features(t) for t in batch], dtype=object)

        # Ids are of a bounded sample; the texts are measured where they lie.
        found = texts.join(F.broadcast(chosen), "place").groupBy("place").agg(F.min("text").alias("text"))
        rows = found.select("place", measured("text").alias("x")).orderBy("place").collect()
        return np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES))

    positives, unlabelled = looks(ids(trusted, how.positives)), looks(ids(texts, how.unlabelled))
    model = QualityModel(unlabelled if len(unlabelled) else positives, how.tails)
    if not len(positives) or not len(unlabelled):
        return model
    # A first model's score separates better than any feature, and so bounds the prior better.
    model.train(positives, unlabelled, estimate_prior(positives, unlabelled, how.prior_step), how)
    scored = [np.column_stack([rows, model.score(rows)]) for rows in (positives, unlabelled)]
    again = QualityModel(unlabelled, how.tails)
    return again.train(positives, unlabelled, estimate_prior(*scored, how.prior_step), how)


def quality(text: Column, model: QualityModel) -> Column:
    """The score, 0 to 1, of a whole text; a null text is an empty one."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            rows = np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(rows))

    return scored(text)


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 5, how: Training | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Nothing is learned from ids whose crc32 leaves 0 modulo ``modulus``, nor from rows without id.
    Scores see the text only; without positives or texts to learn from every score is 0.5. Repeated
    rows give repeated results; other columns are ignored. An empty table gives no rows.
    """
    remainder = crc_remainder("doc_id", modulus)
    model = train_quality(docs.where(remainder > 0), labels.where(remainder > 0), how)
    score = quality(F.col("text"), model).alias("score")
    scored = small_batches(docs).select("doc_id", (remainder == 0).alias("held_out"), score)
    return scored.selectExpr("*", f"if(score >= {THRESHOLD}, 1, 0) as predicted")
