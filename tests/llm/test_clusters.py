import hashlib
import math
import random

import numpy as np
import pytest

import cardweave.llm.clusters as clusters
from cardweave.llm.clusters import _digits, cluster_vectors, nearest

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, k, rounds, dimension, scale=64):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in kept[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min(range(len(centroids)), key=lambda i: (far(v, centroids[i]), i))
    for _ in range(rounds):
        own = [[v for _, v in kept if near(v) == i] for i in range(len(centroids))]
        centroids = [[sum(x) // len(x) for x in zip(*vs)] if vs else c for vs, c in zip(own, centroids)]
    placed = [(i, near(v), far(v, centroids[near(v)])) for i, v in kept]
    total = lambda c: sum(d for _, own, d in placed if c in (None, own))
    fits = lambda n: n if n < 1 << 63 else None
    unknown = any(d >= 1 << 63 for _, _, d in placed)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        (str(i), c, fits(d), fits(total(c)), None if unknown else fits(total(None)), digest[c]) for i, c, d in placed
    )


def frame(spark, rows, kind="DOUBLE"):
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame(rows, f"vec_id BIGINT, embedding ARRAY<{kind}>").repartition(3)


def result(df, **options):
    return sorted((str(r[0]), *r[1:]) for r in cluster_vectors(df, **options).select(*COLUMNS).collect())


@pytest.mark.parametrize("block", [7, 8192])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(clusters, "BLOCK_ROWS", block)
    rng = random.Random(3)
    rows = [(i, [rng.choice([0, 0.5, -0.25, rng.gauss(0, 1)]) for _ in range(4)]) for i in range(200)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 320)]  # a third are one vector
    rows += [(400, None), (401, []), (402, [1.0, None, 0, 0]), (403, [float("nan")] * 4), (404, [float("-inf"), 0, 0, 0])]
    rows += [(405, [1.0] * 3), (406, [1.0] * 5), (None, [2.0, 0, 0, 0]), rows[0], rows[0]]
    assert result(frame(spark, rows), k=6, dimension=4) == brute(rows, 6, 3, 4)


def test_sums_and_distances_beyond_64_bits_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1), rng.gauss(0, 1) * 1e12]) for i in range(20)] + [(50, [1e300, 1.0]), (51, [-3e30, 2.0])]
    rows += [(52, [1.7e308, 0.0])]  # not finite after scaling
    got = result(frame(spark, rows), k=3, dimension=2)
    assert got == brute(rows[:-1], 3, 3, 2)
    assert any(r[2] is None for r in got) and any(r[2] is not None for r in got)


def test_floats_as_in_the_tables(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.2, (90, 64)).astype(np.float32))]
    assert result(frame(spark, rows, "FLOAT")) == brute(rows, 16, 3, 64)


def test_few_rows(spark):
    assert result(frame(spark, []), dimension=2) == []
    assert result(frame(spark, [(1, [1.0])]), dimension=2) == []
    few = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-1.0, 0.0])]
    clash = frame(spark, few).selectExpr("*", "1 AS cluster", "2 AS ids", "3 AS inertia", "4 AS distance", "5 AS codes")
    assert result(clash, dimension=2) == brute(few, 16, 3, 2)


def test_tables_give_the_distances():
    rng = np.random.default_rng(6)
    rows = rng.integers(-9, 9, (50, 3))
    pairs = [np.unique(rows[:, d], return_inverse=True) for d in range(3)]
    centroids = rng.integers(-9, 9, (4, 3))
    cluster, distance = nearest([v for v, _ in pairs], np.array([c for _, c in pairs]), centroids.tolist())
    every = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_digits_add_up():
    for n in [0, 1, -1, 1 << 40, -(1 << 40), (1 << 90) + 5, -(1 << 90) - 5]:
        digits = _digits(n)
        assert sum(d << (40 * i) for i, d in enumerate(digits)) == n and all(abs(d) <= 1 << 40 for d in digits)
