"""Exact top-k search with one KD-tree for each shard.

Vectors are dealt to shards of a few thousand rows, queries to blocks. Every shard meets every
block of queries: the stated queries go against all rows. A shard's tree splits at the median
of the widest dimension and keeps the tight box of every node. For a query the nodes are visited
best first, by the largest inner product their box allows, until none can reach the k-th
score. The k-th score a query has from one shard is where its search of the next one starts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardweave.storage import stage

SCALE = 1024
K = 10
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 4096, 1024, 64
#: Shards that one task searches one after the other for a block, handing on the k-th scores.
SHARDS_IN_TURN = 8
_EXACT = float(1 << 53)


class KDTree:
    """Rows (ids ascending) under median splits; nodes are numbered, the root is 0."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.low, self.high, self.least_id, self.children, self.leaf = [], [], [], [], []
        self._build(np.arange(len(ids)))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _build(self, members: np.ndarray) -> int:
        node, own = len(self.low), self.rows[members]
        low, high = own.min(axis=0), own.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.least_id.append(int(self.ids[members].min()))
        self.children.append(None)
        self.leaf.append(None)
        wide = int(np.argmax(high - low)) if len(low) else 0
        if len(members) <= LEAF_ROWS or not len(low) or high[wide] == low[wide]:
            self.leaf[node] = np.sort(members)
            return node
        half = len(members) // 2
        order = np.argpartition(own[:, wide], half)
        self.children[node] = self._build(members[order[:half]]), self._build(members[order[half:]])
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, the largest inner product with a point of the node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, own_id: int, bounds: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """The ``k`` best of ``best`` and the tree, a heap of (score, -id) with the worst on top."""
        heap = list(best)
        queue = [(-bounds[0], self.least_id[0], 0)]
        while queue:
            bound, least_id, node = heapq.heappop(queue)
            if len(heap) == k and (-bound, -least_id) <= heap[0]:
                if -bound < heap[0][0]:
                    break  # no other node can do better
                continue  # at best equal scores, with larger ids
            if self.leaf[node] is None:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bounds[child], self.least_id[child], child))
                continue
            members = self.leaf[node]
            scores = self.rows[members] @ query
            if len(heap) == k:
                near = scores >= heap[0][0]
                members, scores = members[near], scores[near]
            if len(members) > k:  # ids ascend, so a stable order prefers small ones
                top = np.argsort(-scores, kind="stable")[: k + 1]
                members, scores = members[top], scores[top]
            for score, i in zip(scores.tolist(), self.ids[members].tolist()):
                if i == own_id:
                    continue
                if len(heap) < k:
                    heapq.heappush(heap, (score, -i))
                elif (score, -i) > heap[0]:
                    heapq.heapreplace(heap, (score, -i))
        return heap


def _packed(table: pa.Table) -> pa.Table:
    ids = table.column("vec_id").to_numpy()
    rows = table.column("ints").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.table(
        {
            "part": table.column("part").slice(0, 1),
            "dimension": table.column("dimension").slice(0, 1),
            "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "rows": pa.array([rows.tobytes()], pa.binary()),
        }
    )


def _matrix(ids: bytes, rows: bytes, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(rows, np.int64).reshape(len(ids), dimension)


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, best = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if turn != (row["block"], row["turn"], row["dimension"]):
                    turn, best = (row["block"], row["turn"], row["dimension"]), {}
                ids, rows = _matrix(row["ids"], row["rows"], row["dimension"])
                query_ids, queries = _matrix(row["query_ids"], row["query_rows"], row["dimension"])
                # In doubles where every sum is exact there, else in 64-bit integers.
                reach = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * row["dimension"]
                kind = np.float64 if reach < _EXACT else np.int64
                tree, queries = KDTree(ids, rows.astype(kind)), queries.astype(kind)
                bounds = tree.bounds(queries)
                out: list[tuple] = []
                for q, query_id in enumerate(query_ids.tolist()):
                    before = best.get(query_id, [])
                    best[query_id] = tree.search(queries[q], query_id, bounds[q], before, k)
                    known = set(before)
                    out += [(query_id, -i, int(score)) for score, i in best[query_id] if (score, i) not in known]
                if out:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], ["query_id", "vec_id", "score"])

    return run


def quantised(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, ints (floor of ``scale`` times each component) and dimension of the usable vectors."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = df.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(fine)
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    # Of several rows with one vec_id the smallest vector counts.
    return usable.groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(F.min(ints).alias("ints")).withColumn(
        "dimension", F.size("ints")
    )


def top_k(df: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` rows of the highest inner product for each query.

    ``df`` has an integer vec_id and embedding; ``is_query`` is a condition on vec_id. A query
    is compared with all rows but its own, ties go to the smaller vec_id, and with fewer rows
    all are returned. Null vectors and those with a null or non-finite component take no
    part, nor do rows without vec_id; rows with the same vec_id are one vector; vectors of different
    length are not compared. An empty table, or a query alone, gives no rows.
    """
    vectors = stage(quantised(df, scale), "vectors")
    queries = vectors.where(is_query)
    n_rows, n_queries = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n_rows // SHARD_ROWS)), max(1, -(-n_queries // BLOCK_ROWS))
    packed = "part bigint, dimension int, ids binary, rows binary"
    deal = lambda rows, n: (
        rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(n))).groupBy("part", "dimension").applyInArrow(_packed, packed)
    )
    asked = deal(queries, blocks).toDF("block", "dimension", "query_ids", "query_rows")
    each_block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block")
    held = deal(vectors, shards).select("*", (F.col("part") % -(-shards // SHARDS_IN_TURN)).alias("turn"))
    met = stage(held, "shards").select("*", each_block).join(asked, ["block", "dimension"])
    met = met.repartition("block", "turn", "dimension").sortWithinPartitions("block", "turn", "dimension", "part")
    found = met.mapInArrow(_searched(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
