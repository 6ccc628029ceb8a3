"""Toxicity: a factorization machine over hashed terms.

Terms are the words of a text and their beginnings, so that inflected forms share terms. A
term's presence adds its weight, and each pair of present terms adds the product of their
factor vectors, so that two words can be toxic together that are harmless alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardweave.llm.kernel import SpanHasher, word_spans
from cardweave.llm.learning import Adam, fold, labelled_sample, scored, sigmoid

BUCKET_BITS = 20
FACTORS = 8
#: Bounds of the learning sample.
SAMPLE_ROWS, SAMPLE_CHARS = 12_000, 50_000
#: Beginnings of these many bytes are terms besides the word itself.
BEGINNINGS = (3, 4, 5, 6)
#: Learnt are terms in so many documents of the sample whose share differs between the labels
#: by so many standard errors, and of those so many that differ most.
LEAST_DOCUMENTS, LEAST_ERRORS, MOST_TERMS = 3, 4.0, 4096
EPOCHS = 30
#: The share of terms hidden at each visit, so that one telling term is enough where several are usual.
DROPOUT = 0.25
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1


def _separators() -> np.ndarray:
    """Every ASCII byte that is neither a letter nor a digit separates terms."""
    table = np.zeros(256, bool)
    for b in range(128):
        table[b] = not chr(b).isalnum()
    return table


def terms(data: np.ndarray, bounds: np.ndarray, hasher: SpanHasher, rows: np.ndarray | None = None) -> tuple:
    """Distinct (text, bucket) pairs of the texts, as two arrays sorted by text.

    With ``rows``, the row of each bucket takes its place, and buckets without one are left out.
    """
    starts, ends = word_spans(data, bounds, _separators())
    text = np.searchsorted(bounds, starts, side="right") - 1
    shift, found = np.uint64(64 - BUCKET_BITS), []
    for size in (*BEGINNINGS, None):
        longer = slice(None) if size is None else np.flatnonzero(ends - starts > size)
        a = starts[longer]
        bucket = (hasher.words(data, a, ends[longer] if size is None else a + size) >> shift).astype(np.int64)
        own = text[longer]
        if rows is not None:
            bucket = rows[bucket].astype(np.int64)
            own, bucket = own[bucket >= 0], bucket[bucket >= 0]
        found.append(own << BUCKET_BITS | bucket)
    both = np.sort(np.concatenate(found))
    both = both[np.append(True, both[1:] != both[:-1])[: len(both)]]
    return both >> BUCKET_BITS, both & ((1 << BUCKET_BITS) - 1)


def term_hasher() -> SpanHasher:
    return SpanHasher(21, fold_case=True)


@dataclass(frozen=True)
class FactorizationMachine:
    """``rows``: the row of each bucket, -1 for those not learnt; row by row a weight and a factor vector."""

    rows: np.ndarray
    constant: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, text: np.ndarray, row: np.ndarray, texts: int) -> np.ndarray:
        linear = np.bincount(text, self.weights[row], texts)
        pairs = np.zeros(texts)
        for f in range(self.factors.shape[1]):
            v = self.factors[row, f].astype(float)
            pairs += np.bincount(text, v, texts) ** 2 - np.bincount(text, v * v, texts)
        return self.constant + linear + pairs / 2

    def scorer(self):
        hasher = term_hasher()

        def score(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
            text, row = terms(data, bounds, hasher, self.rows)
            return sigmoid(self.margin(text, row, len(bounds) - 1))

        return score


def train(sample: list[tuple[bytes, int]], seed: int = 3) -> FactorizationMachine:
    """Fit by Adam on the log loss with weight decay. Without both labels it says the share of label 1."""
    rng, hasher = np.random.default_rng(seed), term_hasher()
    labels = np.array([y for _, y in sample], float)
    base = (labels.sum() + 1) / (len(labels) + 2)
    constant = float(np.log(base / (1 - base)))
    rows = np.full(1 << BUCKET_BITS, -1, np.int32)
    empty = np.zeros(0, np.int64)
    own = [terms(np.frombuffer(t, np.uint8), np.array([0, len(t)]), hasher)[1] for t, _ in sample]
    if len(set(labels.tolist())) < 2:
        return FactorizationMachine(rows, constant, np.zeros(1), np.zeros((1, FACTORS)))
    counts = [
        np.bincount(np.concatenate([empty, *(b for b, y in zip(own, labels) if y == label)]), minlength=len(rows))
        for label in (0, 1)
    ]
    documents, texts = counts[0] + counts[1], np.bincount(labels.astype(int))
    share = np.clip(documents / len(labels), 1e-9, 1 - 1e-9)
    apart = np.abs(counts[1] / texts[1] - counts[0] / texts[0]) / np.sqrt(share * (1 - share) * (1 / texts).sum())
    known = np.flatnonzero((documents >= LEAST_DOCUMENTS) & (apart >= LEAST_ERRORS))
    known = np.sort(known[np.argsort(-apart[known], kind="stable")][:MOST_TERMS])
    if not len(known):
        return FactorizationMachine(rows, constant, np.zeros(1), np.zeros((1, FACTORS)))
    rows[known] = np.arange(len(known), dtype=np.int32)
    own = [r[r >= 0] for r in (rows[b] for b in own)]
    values = {
        "constant": np.array([constant]),
        "weights": np.zeros(len(known)),
        "factors": rng.normal(0, 0.01, (len(known), FACTORS)),
    }
    optimiser, batch = Adam(values, 0.02), 256
    for epoch in range(EPOCHS):
        optimiser.rate = 0.02 * (1 - epoch / EPOCHS) + 0.001
        order = rng.permutation(len(sample))
        for k in range(0, len(order), batch):
            chosen = order[k : k + batch]
            text = np.repeat(np.arange(len(chosen)), [len(own[i]) for i in chosen])
            row = np.concatenate([own[i] for i in chosen])
            shown = rng.random(len(row)) >= DROPOUT
            text, row = text[shown], row[shown]
            machine = FactorizationMachine(rows, float(values["constant"][0]), values["weights"], values["factors"])
            error = (sigmoid(machine.margin(text, row, len(chosen))) - labels[chosen]) / len(chosen)
            gradient = {"constant": np.array([error.sum()])}
            gradient["weights"] = np.bincount(row, error[text], len(known)) + 3e-5 * values["weights"]
            gradient["factors"] = 1e-4 * values["factors"]
            for f in range(FACTORS):
                v = values["factors"][row, f]
                sums = np.bincount(text, v, len(chosen))
                gradient["factors"][:, f] += np.bincount(row, error[text] * (sums[text] - v), len(known))
            optimiser.step(gradient)
    return FactorizationMachine(rows, float(values["constant"][0]), values["weights"], values["factors"])


def fit_toxicity(df: DataFrame, labels: DataFrame, learnable: Column) -> FactorizationMachine:
    return train(labelled_sample(df, labels, "toxic", learnable, SAMPLE_ROWS, SAMPLE_CHARS))


def score_toxicity(df: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """``df`` with score: the probability of toxic 1 of each whole text; a text without known terms has the base rate."""
    return scored(df, machine.scorer)


def judge_toxicity(df: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with held_out, score and predicted, learnt from the labels that are not held out.

    Input columns of these names are replaced. Only doc_id, for the fold, and text are used;
    labels may be empty, then every text gets the same score. Repeated rows are scored alike.
    """
    machine = fit_toxicity(df, labels, fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    rows = score_toxicity(df.drop("held_out", "predicted"), machine)
    held_out = (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    return rows.select("*", held_out, (F.col("score") >= threshold).cast("int").alias("predicted"))
