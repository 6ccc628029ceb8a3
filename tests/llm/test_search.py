import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import cardweave.llm.search as search
from cardweave.llm.search import KDTree, top_k


def brute(rows, every, k=10):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints = [math.floor(1024 * x) for x in v]
            usable[i] = min(usable.get(i, ints), ints)
    out = []
    for q, a in usable.items():
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q and len(b) == len(a)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def vectors(spark, rows):
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").repartition(3)


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many shards and blocks, tiny leaves
        for name, n in (("SHARD_ROWS", 40), ("BLOCK_ROWS", 3), ("LEAF_ROWS", 4), ("SHARDS_IN_TURN", 2)):
            monkeypatch.setattr(search, name, n)
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1, -0.5, 0, 0.25, 0.5, rng.gauss(0, 1)]) for _ in range(5)]) for i in range(300)]
    rows += [(300 + i, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(150)]  # ties
    rows += [(500, None), (510, [1.0, None, 0, 0, 0]), (520, [float("nan")] * 5), (530, [float("inf"), 0, 0, 0, 0]), (None, [1.0] * 5)]
    rows += [(540, [1.0, 2.0]), (550, [3.0, 1.0]), (560, []), (570, [1e9] * 5), (580, [9.0]), rows[10], (20, [0.0] * 5)]
    got = top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 10)


def test_few_rows(spark):
    assert top_k(vectors(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    assert top_k(vectors(spark, [(0, [1.0])]), F.col("vec_id") % 10 == 0).collect() == []
    clash = vectors(spark, [(0, [1.0]), (3, [2.0])]).selectExpr("*", "1 AS score", "2 AS query_id", "3 AS ints", "4 AS dimension")
    got = top_k(clash, F.col("vec_id") % 10 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 3, 2 * 1024 * 1024)]


def test_boxes_are_tight_and_bounds_hold():
    rng = np.random.default_rng(1)
    rows = rng.integers(-900, 900, (700, 6)).astype(float)
    tree = KDTree(np.arange(700), rows)
    queries = rng.integers(-900, 900, (20, 6)).astype(float)
    bounds = tree.bounds(queries)
    seen = []
    for node, members in enumerate(tree.leaf):
        if members is not None:
            seen += members.tolist()
            own = tree.rows[members]
            assert (own.min(axis=0) == tree.low[node]).all() and (own.max(axis=0) == tree.high[node]).all()
            assert (own @ queries.T).max(axis=0) == pytest.approx(np.minimum(bounds[:, node], (own @ queries.T).max(axis=0)))
    assert sorted(seen) == list(range(700))


def test_search_skips_most_of_a_clustered_shard(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1000, (64, 3))
    rows = np.floor(np.repeat(centres, 64, axis=0) + rng.normal(0, 5, (4096, 3)))
    tree, looked = KDTree(np.arange(4096), rows), []
    query = rows[77]
    bounds = tree.bounds(query[None])[0]

    class Leaves(list):
        def __getitem__(self, node):
            if list.__getitem__(self, node) is not None:
                looked.append(node)
            return list.__getitem__(self, node)

    leaves = sum(x is not None for x in tree.leaf)
    tree.leaf = Leaves(tree.leaf)
    got = tree.search(query, 77, bounds, [], 10)
    expected = sorted(((float(s), -i) for i, s in enumerate(rows @ query) if i != 77), reverse=True)[:10]
    assert sorted(got, reverse=True) == expected
    assert len(set(looked)) < leaves / 4
