"""Quality classifier: a byte-level convolutional network in numpy.

Filters slide over the bytes of the whole document. A document is a row of overlapping
chunks of two blocks each; every filter is max-pooled over each chunk. The largest pooled
value over all chunks and the mean over chunks go, for each filter, through a rectifier
into one logistic unit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardweave.llm.kernel import expand
from cardweave.llm.learning import Adam, fold, labelled_sample, scored, sigmoid

#: A chunk is two blocks; chunks overlap by one block.
BLOCK = 256
WIDTH = 6
FILTERS = 16
#: Bounds of the learning sample, and of the text shown of a document at each visit.
SAMPLE_ROWS, SAMPLE_CHARS, VISIT_BLOCKS = 4000, 50_000, 16
EPOCHS = 8
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0


@dataclass(frozen=True)
class ByteNetwork:
    """``filters``: width x 256 bytes x filters; ``weights``: two for each filter, then the constant."""

    filters: np.ndarray
    weights: np.ndarray

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each text of ``data`` between ``bounds``."""
        pooled, starts = self._pooled(data, bounds)
        return sigmoid(_features(pooled, starts)[0] @ self.weights[:-1] + self.weights[-1])

    def _pooled(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest value of each filter in each block, and each text's first block."""
        width, filters = self.filters.shape[0], self.filters.shape[2]
        lengths = np.diff(bounds)
        # The filters see zeros behind each text, and an empty one has a position too.
        places = lengths + 1
        first = np.cumsum(lengths + width) - lengths - width
        padded = np.zeros(int((lengths + width).sum()) + width, np.uint8)
        padded[expand(first, lengths)] = data
        blocks = -(-places // BLOCK)
        block_starts = np.repeat(first, blocks) + expand(np.zeros_like(blocks), blocks) * BLOCK
        ends = np.minimum(block_starts + BLOCK, np.repeat(first + places, blocks))
        starts = np.cumsum(blocks) - blocks
        pooled = np.empty((len(block_starts), filters), np.float32)
        at = 0
        while at < len(block_starts):  # about 32,000 positions at a time
            stop = max(int(np.searchsorted(ends, block_starts[at] + 32_768, side="right")), at + 1)
            a, b = block_starts[at], ends[stop - 1] + 1
            value = self.filters[0][padded[a:b]]
            for k in range(1, width):
                value += self.filters[k][padded[a + k : b + k]]
            # From each start to its end; what lies between a text's end and the next start is left out.
            edges = np.stack([block_starts[at:stop], ends[at:stop]], axis=1).ravel() - a
            pooled[at:stop] = np.maximum.reduceat(value, edges, axis=0)[::2]
            at = stop
        return pooled, starts


def _features(pooled: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rectified maximum and mean over chunks for each text; and the block each chunk takes its value from."""
    nearest = np.arange(len(pooled))
    following = np.minimum(nearest + 1, len(pooled) - 1)
    final = np.zeros(len(pooled), bool)
    final[np.append(starts[1:], len(pooled)) - 1] = True
    following[final] = nearest[final]
    later = pooled[following] > pooled
    chunks = np.maximum(np.where(later, pooled[following], pooled), 0.0)
    counts = np.diff(np.append(starts, len(pooled)))[:, None]
    features = np.hstack([np.maximum.reduceat(chunks, starts, axis=0), np.add.reduceat(chunks, starts, axis=0) / counts])
    return features, np.where(later, following[:, None], nearest[:, None])


def train(sample: list[tuple[bytes, int]], seed: int = 7) -> ByteNetwork:
    """Fit by Adam on the log loss. Without both labels the network says the share of label 1."""
    rng = np.random.default_rng(seed)
    labels = np.array([y for _, y in sample], float)
    base = (labels.sum() + 1) / (len(labels) + 2)
    constant = np.log(base / (1 - base))
    filters = rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32)
    if len(set(labels.tolist())) < 2:
        return ByteNetwork(filters, np.append(np.zeros(2 * FILTERS), constant).astype(np.float32))
    values = {"filters": filters, "weights": np.append(rng.normal(0, 0.1, 2 * FILTERS), constant).astype(np.float32)}
    optimiser = Adam(values, 0.01)
    batch = 32
    for epoch in range(EPOCHS):
        optimiser.rate = 0.01 * (1 - epoch / EPOCHS) + 0.001
        order = rng.permutation(len(sample))
        for k in range(0, len(order), batch):
            rows = order[k : k + batch]
            optimiser.step(_gradients(values, [_visit(sample[i][0], rng) for i in rows], labels[rows]))
    return ByteNetwork(values["filters"], values["weights"])


def _visit(text: bytes, rng: np.random.Generator) -> np.ndarray:
    """The text, or a random run of VISIT_BLOCKS blocks of a longer one."""
    data, most = np.frombuffer(text, np.uint8), BLOCK * VISIT_BLOCKS
    at = int(rng.integers(0, len(data) - most + 1)) if len(data) > most else 0
    return data[at : at + most]


def _gradients(values: dict[str, np.ndarray], texts: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    filters, weights = values["filters"], values["weights"]
    blocks = np.array([-(-(len(t) + 1) // BLOCK) for t in texts])
    starts = np.cumsum(blocks) - blocks
    padded = np.zeros((int(blocks.sum()), BLOCK + WIDTH - 1), np.uint8)
    inside = np.zeros(padded.shape, bool)
    for text, first, n in zip(texts, starts, blocks):
        whole = np.zeros(n * BLOCK + WIDTH - 1, np.uint8)
        whole[: len(text)] = text
        padded[first : first + n] = np.lib.stride_tricks.sliding_window_view(whole, BLOCK + WIDTH - 1)[::BLOCK]
        real = np.arange(n * BLOCK).reshape(n, BLOCK) <= len(text)
        inside[first : first + n, :BLOCK] = real
    value = filters[0][padded[:, :BLOCK]]
    for k in range(1, WIDTH):
        value += filters[k][padded[:, k : BLOCK + k]]
    value[~inside[:, :BLOCK]] = -np.inf
    place = value.argmax(axis=1)
    pooled = np.take_along_axis(value, place[:, None, :], axis=1)[:, 0]
    features, source = _features(pooled, starts)
    error = (sigmoid(features @ weights[:-1] + weights[-1]) - labels) / len(labels)
    gradient = {"weights": np.append(features.T @ error + 1e-4 * weights[:-1], error.sum()).astype(np.float32)}
    into = np.zeros_like(pooled)
    column = np.arange(FILTERS)
    chunks = np.take_along_axis(pooled, source, axis=0)
    document = np.repeat(np.arange(len(texts)), blocks)
    towards_mean = error[document, None] * weights[FILTERS:-1] / blocks[document, None] * (chunks > 0)
    np.add.at(into, (source, column), towards_mean)
    for d, (first, n) in enumerate(zip(starts, blocks)):
        best = first + chunks[first : first + n].argmax(axis=0)
        towards_max = error[d] * weights[:FILTERS] * (features[d, :FILTERS] > 0)
        into[source[best, column], column] += towards_max
    gradient["filters"] = 1e-6 * filters
    block, which = np.nonzero(into)
    at = place[block, which]
    for k in range(WIDTH):
        np.add.at(gradient["filters"][k], (padded[block, at + k], which), into[block, which])
    return gradient


def fit_quality(df: DataFrame, labels: DataFrame, learnable: Column) -> ByteNetwork:
    return train(labelled_sample(df, labels, "quality", learnable, SAMPLE_ROWS, SAMPLE_CHARS))


def score_quality(df: DataFrame, network: ByteNetwork) -> DataFrame:
    """``df`` with score: the probability of quality 1 of each whole text; null and empty texts have one too."""
    return scored(df, lambda: network.score)


def judge_quality(df: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with held_out, score and predicted, learnt from the labels that are not held out.

    Input columns of these names are replaced. Only doc_id, for the fold, and text are used;
    labels may be empty, then every text gets the same score. Repeated rows are scored alike.
    """
    network = fit_quality(df, labels, fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    rows = score_quality(df.drop("held_out", "predicted"), network)
    held_out = (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    return rows.select("*", held_out, (F.col("score") >= threshold).cast("int").alias("predicted"))
