"""Centroid clustering of integer vectors by scalar lookup tables.

Vectors are turned into integers and stored once, in blocks: for every dimension the values that
occur in the block, ascending, and for every vector which of them it has. In each round a block
tabulates, dimension by dimension, the squared difference of each of those values to each centroid;
the distances of all its vectors are sums of gathered table rows, and no vector is subtracted from a
centroid. What a task sends on is, for each cluster, the sum of each component and the count, so the
traffic of a round depends on the number of tasks and not on the number of vectors. All arithmetic is exact:
in 64-bit integers where no sum can leave them, else in Python's.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.storage import stage

SCALE, DIMENSION, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1
BLOCK_ROWS = 8192
_WORD = 62
#: Sums travel in digits of this many bits, so that those of any size are added up exactly.
_DIGIT = 40


def kept_vectors(df: DataFrame, dimension: int = DIMENSION, scale: int = SCALE) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors of that dimension that are finite, also after scaling."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")))
    return df.where(F.size("embedding") == dimension).where(fine).select("vec_id", doubles.alias("embedding"))


def _integers(scaled: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as Python's where one does not fit."""
    if np.abs(scaled).max(initial=0) < 2.0**_WORD:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)


def _blocks(dimension: int, scale: int):
    """Arrow batches of vectors to rows of ids, occurring values, their number by dimension, and codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
                scaled = np.floor(flat * scale).reshape(part.num_rows, dimension)
                values, sizes, codes = [], [], np.empty((dimension, part.num_rows), "<u2")
                for d in range(dimension):
                    occurring, codes[d] = np.unique(scaled[:, d], return_inverse=True)
                    values.append(occurring)
                    sizes.append(len(occurring))
                ids = part.column("vec_id")
                yield pa.record_batch(
                    [
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                        pa.array([sizes], pa.list_(pa.int32())),
                        pa.array([np.concatenate(values).astype("<f8").tobytes()], pa.binary()),
                        pa.array([codes.tobytes()], pa.binary()),
                    ],
                    ["ids", "sizes", "occurring", "codes"],
                )

    return run


def _opened(row: dict, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The occurring values of every dimension, and the codes, one row for each dimension."""
    sizes = row["sizes"]
    values = _integers(np.frombuffer(row["occurring"], "<f8"))
    return np.split(values, np.cumsum(sizes)[:-1]), np.frombuffer(row["codes"], "<u2").reshape(len(sizes), n)


def nearest(values: list[np.ndarray], codes: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of the nearest centroid, the smallest of several, and its squared distance."""
    far = max([abs(int(v)) for own in values for v in (own[0], own[-1])] + [abs(c) for row in centroids for c in row])
    exact = np.int64 if len(values) * (2 * far) ** 2 < 1 << 63 else object
    points = np.array(centroids, exact)
    total = np.zeros((codes.shape[1], len(points)), exact)
    for d, own in enumerate(values):
        table = (own.astype(exact)[:, None] - points[None, :, d]) ** 2
        total += table[codes[d]]
    cluster = np.argmin(total, axis=1)
    return cluster, total[np.arange(len(cluster)), cluster]


def _digits(n: int) -> list[int]:
    """``n`` as digits of ``_DIGIT`` bits, the lowest first; the last one has the sign."""
    out = []
    while not -(1 << _DIGIT) < n < 1 << _DIGIT:
        out.append(n & ((1 << _DIGIT) - 1))
        n >>= _DIGIT
    return [*out, n]


def _sums(centroids: list[list[int]]):
    """Sum of every component, and the count as component -1, of each cluster over a task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        sums = [[0] * len(c) for c in centroids]
        counts = [0] * k
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["codes"]) // (2 * len(row["sizes"]))
                values, codes = _opened(row, n)
                cluster, _ = nearest(values, codes, centroids)
                for i, count in enumerate(np.bincount(cluster, minlength=k).tolist()):
                    counts[i] += count
                for d, own in enumerate(values):
                    # How often each cluster has each value: the values weighted by it are the sum.
                    seen = np.bincount(cluster * len(own) + codes[d], minlength=k * len(own)).reshape(k, len(own))
                    wide = own if max(abs(int(own[0])), abs(int(own[-1]))) * n < 1 << 63 else own.astype(object)
                    for i, total in enumerate((seen * wide).sum(axis=1).tolist()):
                        sums[i][d] += int(total)
        rows = [
            (i, d, place, digit)
            for i in range(k)
            if counts[i]
            for d, total in enumerate([counts[i], *sums[i]], -1)
            for place, digit in enumerate(_digits(total))
        ]
        if rows:
            names = ["cluster", "component", "place", "digit"]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

    return run


def _assigned(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            for i, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                own = ids.slice(i, 1).flatten()
                cluster, distance = nearest(*_opened(row, len(own)), centroids)
                if distance.dtype == object:
                    distance = [x if x < 1 << 63 else None for x in distance.tolist()]
                columns = [own, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
                yield pa.record_batch(columns, ["vec_id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, k: int, scale: int, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors whose ids hash smallest; equal hashes, of repeated rows, by the vector itself."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(F.asc_nulls_last(order), "embedding").limit(k).collect()
    return [[math.floor(x * scale) for x in row["embedding"]] for row in rows]


def moved(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round: the floored mean of their vectors, or the same where there are none."""
    parts = blocks.mapInArrow(_sums(centroids), "cluster int, component int, place int, digit bigint")
    # At most a row for each centroid, component and digit.
    rows = parts.groupBy("cluster", "component", "place").agg(F.sum("digit").alias("digit")).collect()
    totals: dict[tuple[int, int], int] = {}
    for r in rows:
        key = r["cluster"], r["component"]
        totals[key] = totals.get(key, 0) + (r["digit"] << (_DIGIT * r["place"]))
    return [
        [totals[i, d] // totals[i, -1] for d in range(len(old))] if (i, -1) in totals else old
        for i, old in enumerate(centroids)
    ]


def cluster_vectors(
    df: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimension: int = DIMENSION, scale: int = SCALE, seed: int = SEED
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part.

    ``df`` has vec_id and embedding; other columns are not read. A vector takes part when it has
    ``dimension`` components, none null or non-finite, also after multiplication with ``scale``. Repeated
    rows are vectors of their own, and so are rows without vec_id, which come last among the first centroids.
    With fewer than ``k`` vectors each is a first centroid. An empty table gives no rows. A
    distance, or a sum of distances, beyond a bigint is null; the assignment is exact all the same.
    """
    vectors = kept_vectors(df, dimension, scale)
    centroids = first_centroids(vectors, k, scale, seed)
    id_type = df.schema["vec_id"].dataType.simpleString()
    result = T.StructType([df.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    stored = f"ids array<{id_type}>, sizes array<int>, occurring binary, codes binary"
    blocks = stage(vectors.mapInArrow(_blocks(dimension, scale), stored), "vector-blocks")
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    assigned = stage(blocks.mapInArrow(_assigned(centroids), result), "assigned")
    parts = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("unknown")
    )
    known = {r["cluster"]: None if r["unknown"] else int(r["total"]) for r in parts.collect()}  # at most ``k`` rows
    whole = None if None in known.values() else sum(known.values())
    fits = lambda n: n if n is not None and n < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(i, fits(n), fits(whole), digest[i]) for i, n in known.items()]
    summary = df.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(summary), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
