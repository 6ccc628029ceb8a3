"""Best-fit packing of token sequences by a configuration linear program.

Documents become pieces of at most ``capacity`` tokens. Only the histogram of piece lengths,
at most ``capacity`` numbers, reaches the driver. A configuration says how many pieces of
which lengths fill one sequence. Multiplicative weights price the lengths, a knapsack
dynamic program finds the configuration of the highest price, and how often each was found
is the fractional solution of the covering program. It is rounded down; what is left
of the histogram is packed by best fit. Pieces then find their sequence by their
length and their number among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.llm.kernel import releasing, slices, text_buffers
from cardweave.llm.ranks import numbered
from cardweave.llm.tokens import WordTokens
from cardweave.storage import stage

CAPACITY = 1024
END_ID = 2
ROUNDS = 600
#: The largest share of a length's demand covered in one round, and how fast prices fall.
_STEP, _RATE = 0.25, 4.0


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _pieces(ranks: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens(ranks)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for first, last in slices(offsets):
                base = offsets[first]
                ids, counts = words.encode(data[base : offsets[last]], offsets[first : last + 1] - base)
                rows, piece, start, length, crc = [], [], [], [], []
                stop = np.cumsum(counts)
                for row, (a, b) in enumerate(zip((stop - counts).tolist(), stop.tolist()), first):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    # Only the first piece may be shorter than ``capacity``.
                    short = (len(own) - 1) % capacity + 1
                    for k, end in enumerate(range(short, len(own) + 1, capacity)):
                        at = max(end - capacity, 0)
                        part = own[at:end]
                        rows.append(row)
                        piece.append(k)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                yield pa.record_batch(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return releasing(run)


def token_pieces(df: DataFrame, ranks: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document: its ids, then ``end_id``, cut so that all pieces but the first have ``capacity`` ids."""
    id_type = df.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return df.select("doc_id", "text").mapInArrow(_pieces(ranks or default_ranks(), capacity, end_id), schema)


def _best_configuration(prices: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per length of the fullest configuration of the highest price: an unbounded knapsack."""
    lengths = np.flatnonzero(prices > 0)
    value, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    worth = prices[lengths]
    for room in range(1, capacity + 1):
        fit = int(np.searchsorted(lengths, room, side="right"))
        value[room] = value[room - 1]
        if fit:
            gains = value[room - lengths[:fit]] + worth[:fit]
            k = int(np.argmax(gains))
            if gains[k] > value[room]:
                value[room], choice[room] = gains[k], lengths[k]
    counts, room = np.zeros(len(prices), np.int64), capacity
    while room > 0:
        if choice[room]:
            counts[choice[room]] += 1
            room -= choice[room]
        else:
            room -= 1
    return counts


def _fractional(histogram: np.ndarray, capacity: int, rounds: int) -> dict[tuple, float]:
    """Configurations and how often to use each, by multiplicative weights.

    A length starts at the price of its share of a sequence, and each time a configuration
    covers a part of its demand its price falls by a factor. Lengths are therefore covered
    evenly, and what rounding leaves is shaped like the whole.
    """
    demand = histogram.astype(float)
    size = np.arange(len(demand)) / capacity
    logs, chosen = np.zeros_like(demand), {}
    covered, total = 0.0, float((demand * size).sum())
    if not total:
        return chosen
    for _ in range(rounds):
        # Below exp(-30) a price no longer matters; shifting all logs changes no choice.
        prices = np.where(demand > 0, size * np.exp(np.maximum(logs - logs.max(initial=-np.inf, where=demand > 0), -30.0)), 0.0)
        counts = _best_configuration(prices, capacity)
        used = np.flatnonzero(counts)
        if not len(used):
            break
        scarce = counts[used] > histogram[used]
        if scarce.any():  # not enough pieces for even one use
            logs[used[scarce]] -= 1.0
            continue
        times = _STEP * float((demand[used] / counts[used]).min())
        logs[used] -= _RATE * counts[used] * times / demand[used]
        key = tuple((int(n), int(counts[n])) for n in used)
        chosen[key] = chosen.get(key, 0.0) + times
        covered += float((counts * size).sum()) * times
        if covered >= total:
            break
    return chosen


@dataclass(frozen=True)
class Plan:
    """Rows for each length: ranks from ``low`` on go to ``sequence``, ``each`` of them to one sequence."""

    length: np.ndarray
    low: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int


def _best_fit(histogram: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest pieces first, each into the fullest sequence that has room.

    Sequences of the same content are one entry with a count, so the work depends on the
    number of lengths and not on the number of pieces.
    """
    by_room: list[list[tuple[dict[int, int], int]]] = [[] for _ in range(capacity + 1)]

    def put(content: dict[int, int], times: int, room: int, length: int, each: int) -> None:
        by_room[room - each * length].append(({**content, length: content.get(length, 0) + each}, times))

    for length in range(len(histogram) - 1, 0, -1):
        left = int(histogram[length])
        while left:
            room = next((r for r in range(length, capacity + 1) if by_room[r]), None)
            content, times = by_room[room].pop() if room is not None else ({}, left)
            room = capacity if room is None else room
            each = min(room // length, left)
            filled = min(times, left // each)
            put(content, filled, room, length, each)
            left -= filled * each
            if content and times > filled:
                by_room[room].append((content, times - filled))
    return [entry for entries in by_room for entry in entries]


def plan_sequences(histogram: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """Which sequence the r-th piece of each length goes to."""
    left = histogram.astype(np.int64).copy()
    uses: list[tuple[dict[int, int], int]] = []
    for key, times in sorted(_fractional(histogram, capacity, rounds).items(), key=lambda x: -sum(a * b for a, b in x[0])):
        whole = min([int(times), *(int(left[n]) // c for n, c in key)])
        if whole:
            uses.append((dict(key), whole))
            for n, c in key:
                left[n] -= c * whole
    uses += _best_fit(left, capacity)
    taken, rows, sequence = np.zeros(len(histogram), np.int64), [], 0
    for content, times in uses:
        offset = 0
        for n, c in content.items():
            rows.append((n, taken[n], sequence, c, offset))
            taken[n] += c * times
            offset += n * c
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*table.T, sequence)


def _assign(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.searchsorted(plan.length, np.arange(plan.length.max(initial=0) + 2))
        span = int(plan.low.max(initial=0)) + 1
        keys = plan.length * span + plan.low
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            # The last row of the length that starts at the rank or before it.
            row = np.searchsorted(keys, length * span + np.minimum(rank, span - 1), side="right") - 1
            row = np.clip(row, edges[length], edges[length + 1] - 1)
            within = rank - plan.low[row]
            sequence = plan.sequence[row] + within // plan.each[row]
            offset = plan.offset[row] + within % plan.each[row] * length
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.record_batch(
                [*(batch.column(n) for n in names), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*names, "sequence_id", "offset"],
            )

    return releasing(run)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Add sequence_id and offset to pieces, which have doc_id, piece and a length up to ``capacity``.

    ``pieces`` is read twice, so it should be a stored table.
    """
    counts = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts:
        histogram[row["length"]] = row["count"]
    plan = plan_sequences(histogram, capacity, rounds)
    keyed = F.struct("doc_id", "piece", *([] if "ids_crc32" not in pieces.columns else ["ids_crc32"]))
    ranked = numbered(pieces, ["length"], keyed, "rank", int(histogram.sum()), ["doc_id", "piece"])
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*pieces.columns, "rank").mapInArrow(_assign(plan), schema)


def pack_documents(
    df: DataFrame, ranks: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, rounds: int = ROUNDS
) -> DataFrame:
    """Pieces of every document (doc_id, text) with their sequence and place.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty
    text is one piece that holds ``end_id`` alone. Repeated rows and rows with a null doc_id
    are packed like all others. Other columns are not read. No rows give no rows.
    """
    return pack_pieces(stage(token_pieces(df, ranks, capacity, end_id), "token-pieces"), capacity, rounds)
