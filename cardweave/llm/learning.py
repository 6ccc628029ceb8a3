"""What the trained operators share: a bounded labelled sample and one optimiser."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.llm.kernel import releasing, slices, text_buffers


def fold(key: Column, modulus: int) -> Column:
    """CRC-32 of the key as text, modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def hashed_share(key: Column, rows: int, of: int) -> Column:
    """A condition that about ``rows`` of ``of`` rows meet, by a hash of ``key``; all, when there are no more.

    Put before a sorted limit it keeps what meets in the limit's one task small, however many rows there are.
    """
    return F.pmod(F.xxhash64(key), F.lit(1 << 40)) < F.lit(int(min(1.0, rows / max(of, 1)) * (1 << 40)))


def labelled_sample(
    df: DataFrame, labels: DataFrame, label: str, learnable: Column, rows: int, most_chars: int
) -> list[tuple[bytes, int]]:
    """At most ``rows`` labelled texts of at most ``most_chars`` characters, in a fixed order.

    ``learnable`` is a condition on doc_id. Rows are chosen by a hash of doc_id. A label
    other than 0 and 1, a null label or doc_id, and a null text teach nothing; of several labels
    for one document the largest counts.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learnable)
    usable = usable.where(hashed_share(F.col("doc_id"), 8 * rows, labels.count()))
    chosen = usable.groupBy("doc_id").agg(F.max(label).alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = df.select("doc_id", "text").where(F.length("text") <= most_chars)
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "_label")
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows)
    return [(row["text"].encode(), int(row["_label"])) for row in sample.toLocalIterator()]


class Adam:
    """Adam over a dictionary of arrays, changed in place."""

    def __init__(self, values: dict[str, np.ndarray], rate: float):
        self.values, self.rate, self.time = values, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in values.items()}
        self.square = {k: np.zeros_like(v) for k, v in values.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.time += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.time) / (1 - 0.9**self.time)
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            self.values[k] -= rate * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def scored(df: DataFrame, scorer: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]]) -> DataFrame:
    """``df`` with a column score.

    ``scorer`` makes, in each task, a function from the bytes of some texts and their bounds
    to their scores. An input column score is replaced.
    """
    df = df.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            parts = [score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    return df.mapInArrow(releasing(run), T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType())]))
