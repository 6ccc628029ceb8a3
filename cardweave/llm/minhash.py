"""MinHash near-dedup with tensored banding.

Two collections of half-keys, each made of a few minhashes, are computed for a document. Every
pair of one half-key of each collection is a table key, so 10 + 10 half-keys of two minhashes
(40 minhashes) give 100 tables of four. Documents that share a key are candidates; they are
confirmed on their full shingle sets.

Inside a bucket nobody is paired with everybody. First, every document is compared with
the smallest document of each of its buckets. Links found make components. Where the documents
around one smallest document still fall into several components, those outside the largest
are compared, in blocks, with all others there. So any two documents that share a bucket end in
one component or have been compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave.functions.plan import fits_broadcast
from cardweave.llm.components import connected
from cardweave.llm.kernel import SpanHasher, mix, releasing, slices, text_buffers, word_spans
from cardweave.storage import stage

#: Half-keys of each collection and minhashes of each half-key. A pair at similarity s is
#: missed with probability below 2 (1 - s**ROWS) ** HALVES: 7e-5 at 0.8, 4e-7 at 0.88.
HALVES, ROWS = 10, 2
#: Documents of one block of an exact comparison.
BLOCK = 512
#: A hot document's comparisons are dealt to so many groups.
SALTS = 16


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int, hasher: SpanHasher) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with too few words, one for the whole sequence."""
    starts, ends = word_spans(data, bounds)
    hashes = hasher.words(data, starts, ends)
    edges = np.searchsorted(starts, bounds)
    sets = []
    for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = hashes[first:last]
        if not len(own):
            sets.append(own)
            continue
        size = min(words, len(own))
        shingle = own[: len(own) - size + 1].copy()
        for k in range(1, size):
            shingle = mix(shingle * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size)) + own[k : len(own) - size + 1 + k]
        shingle = np.sort(mix(shingle + np.uint64(size)))
        sets.append(shingle[np.append(True, shingle[1:] != shingle[:-1])])
    return sets


def word_hasher() -> SpanHasher:
    return SpanHasher(31, fold_case=True)


def _signatures(words: int, halves: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(5)
        hashes = 2 * halves * rows
        factors = random.integers(0, 1 << 63, hashes, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        shifts = random.integers(0, 1 << 63, hashes, dtype=np.uint64)[:, None]
        hasher = word_hasher()
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for first, last in slices(offsets):
                base = offsets[first]
                sets = shingle_sets(data[base : offsets[last]], offsets[first : last + 1] - base, words, hasher)
                sums, mixes, keys = [], [], []
                for own in sets:
                    if not len(own):
                        sums.append(0)
                        mixes.append(0)
                        keys.append(None)
                        continue
                    spread = mix(own)
                    sums.append(int(spread.sum().view(np.int64)))
                    mixes.append(int(np.bitwise_xor.reduce(mix(spread + np.uint64(1))).view(np.int64)))
                    least = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
                    for k in range(0, len(own), 4096):
                        np.minimum(least, (own[k : k + 4096] * factors + shifts).min(axis=1), out=least)
                    half = least.reshape(2 * halves, rows)
                    key = half[:, 0]
                    for k in range(1, rows):
                        key = mix(key) + half[:, k]
                    keys.append(mix(key).view(np.int64))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(sums, pa.int64()),
                        pa.array(mixes, pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_sum", "set_mix", "halves"],
                )

    return releasing(run)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            texts = [pack.compress((t or "").encode()) for t in part.column(1).to_pylist()]
            yield pa.record_batch([part.column(0), pa.array(texts, pa.binary())], ["id", "packed"])


def _set_of(packed: bytes, words: int, hasher: SpanHasher, unpack: zstandard.ZstdDecompressor) -> np.ndarray:
    data = np.frombuffer(unpack.decompress(packed), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]), words, hasher)[0]


def _similar(shared: np.ndarray | int, a: int, b: np.ndarray | int, percent: int) -> np.ndarray | bool:
    return 100 * shared >= percent * (a + b - shared)


def _against_pivot(words: int, percent: int):
    """Rows of one (pivot, salt) come in a row, the pivot's own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, unpack = word_hasher(), zstandard.ZstdDecompressor()
        pivot, own = None, None
        parts = (batch.slice(first, 256) for batch in batches for first in range(0, batch.num_rows, 256))
        for batch in parts:
            kept = []
            columns = (batch.column(n).to_pylist() for n in ("pivot", "id", "packed"))
            for k, (p, i, packed) in enumerate(zip(*columns)):
                if p != pivot and i != p:
                    raise ValueError("a pivot's own text must come first")
                shingles = _set_of(packed, words, hasher, unpack)
                if i == p:
                    pivot, own = p, shingles
                elif _similar(len(np.intersect1d(own, shingles, assume_unique=True)), len(own), len(shingles), percent):
                    kept.append(k)
            if kept:
                part = batch.take(pa.array(kept))
                yield pa.record_batch([part.column("pivot"), part.column("id")], ["a", "b"])

    return releasing(run)


def _block_links(words: int, percent: int):
    """One link from each outlier of the block to each other component it is similar to."""
    def run(table: pa.Table) -> pa.Table:
        hasher, unpack = word_hasher(), zstandard.ZstdDecompressor()
        ids, components, outside = (table.column(n).to_pylist() for n in ("id", "component", "outside"))
        sets: dict = {}
        for i, packed in zip(ids, table.column("packed").to_pylist()):
            if i not in sets:
                sets[i] = _set_of(packed, words, hasher, unpack)
        outliers = [k for k, o in enumerate(outside) if o]
        members = [k for k, o in enumerate(outside) if not o]
        a, b = [], []
        if outliers and members:
            # For each shingle of the outliers, the outliers that have it.
            shingles = np.concatenate([sets[ids[k]] for k in outliers])
            owner = np.repeat(np.arange(len(outliers)), [len(sets[ids[k]]) for k in outliers])
            order = np.argsort(shingles, kind="stable")
            shingles, owner = shingles[order], owner[order]
            sizes = np.array([len(sets[ids[k]]) for k in outliers])
            linked = set()
            for m in members:
                own = sets[ids[m]]
                low, high = np.searchsorted(shingles, own), np.searchsorted(shingles, own, side="right")
                hit = high > low
                if not hit.any():
                    continue
                counts = high[hit] - low[hit]
                places = np.repeat(low[hit] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                shared = np.bincount(owner[places], minlength=len(outliers))
                for o in np.flatnonzero((shared > 0) & _similar(shared, len(own), sizes, percent)).tolist():
                    k = outliers[o]
                    link = (ids[k], components[m])
                    if components[k] != components[m] and link not in linked:
                        linked.add(link)
                        a.append(components[k])
                        b.append(components[m])
        field = table.schema.field("component").type
        return pa.table({"a": pa.array(a, field), "b": pa.array(b, field)})

    return run


def candidate_pairs(sets: DataFrame, halves: int = HALVES) -> DataFrame:
    """(pivot, id): each document with the smallest document of each of its buckets.

    Pairs whose sizes alone rule out the similarity are kept: the documents around a pivot must be
    together for the second comparison. ``sets`` has id and halves.
    """
    first = sets.select("id", "halves", F.posexplode(F.slice("halves", 1, halves)).alias("i", "half"))
    second = first.select("id", "i", "half", F.posexplode(F.slice("halves", halves + 1, halves)).alias("j", "other"))
    keyed = second.select(F.xxhash64("i", "half", "j", "other").alias("key"), "id")
    buckets = keyed.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("_ids")).where("_ids > 1")
    # Written down, so that both sides of the join are plain exchanges: the adaptive skew join splits hot keys.
    buckets = stage(buckets.drop("_ids"), "buckets")
    return keyed.join(buckets.hint("merge"), "key").where("id > pivot").select("pivot", "id").distinct()


def near_duplicates(
    df: DataFrame, words: int = 5, percent: int = 80, halves: int = HALVES, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``df`` (doc_id, text).

    Two documents are linked when 100 times the size of the intersection of their sets of
    ``words``-word shingles is at least ``percent`` times that of the union. A component is all
    documents connected by links, named by its smallest doc_id, whose document is kept. A null or
    empty text or one without words has no shingles, no links, and is kept. Rows with the same
    doc_id are one document. A null doc_id is never linked: its component is null and it is
    kept. Other columns are not read. No rows give no rows.
    """
    name = df.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {name}, n_shingles bigint, set_sum bigint, set_mix bigint, halves array<bigint>"
    documents = df.select("doc_id", "text")
    all_rows = stage(documents.mapInArrow(_signatures(words, halves, rows), schema), "signatures")
    same = ["n_shingles", "set_sum", "set_mix"]
    linkable = all_rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    sets = linkable.groupBy(*same).agg(F.min("doc_id").alias("id"), F.first("halves").alias("halves"))
    sets = stage(sets, "distinct-sets")
    pairs = stage(candidate_pairs(sets, halves), "candidates")
    needed = stage(pairs.select("id").union(pairs.select("pivot")).distinct(), "candidate-ids")
    # Below 64 MB of ids only the texts of candidates are shuffled, beyond it all texts are.
    if fits_broadcast(needed):
        needed = F.broadcast(needed)
    packed = documents.mapInArrow(_packed, f"id {name}, packed binary").join(needed, "id", "left_semi")
    # Rows with the same doc_id may differ; the smallest packed text then stands for the document.
    texts = stage(packed.groupBy("id").agg(F.min("packed").alias("packed")), "candidate-texts")

    # Written down, so that both sides of the joins below are plain exchanges, in which a hot pivot can be split.
    sized = stage(sets.groupBy("id").agg(F.min("n_shingles").alias("n")), "set-sizes")
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    near = (
        salted.join(sized, "id")
        .join(sized.select(F.col("id").alias("pivot"), F.col("n").alias("m")), "pivot")
        .where(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
        .select("pivot", "salt", "id")
    )
    near = stage(near, "near")
    own = near.select("pivot", "salt", F.col("pivot").alias("id")).distinct()
    together = near.union(own).join(texts, "id").select("pivot", "salt", "id", "packed")
    # Comparing costs more than its bytes tell, so the groups are not merged into few tasks.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = together.repartition(tasks, "pivot", "salt").sortWithinPartitions("pivot", "salt", F.col("id") != F.col("pivot"), "id")
    links = dealt.mapInArrow(_against_pivot(words, percent), f"a {name}, b {name}")
    components = stage(connected(stage(links, "links")), "components")

    # Documents around one pivot that are still in several components.
    around = pairs.union(pairs.select("pivot", F.col("pivot").alias("id")).distinct())
    labelled = around.join(components.withColumnRenamed("node", "id"), "id", "left").select(
        "pivot", "id", F.coalesce("component", "id").alias("component")
    )
    labelled = stage(labelled, "around")
    parts = labelled.groupBy("pivot", "component").agg(F.count("*").alias("n"))
    groups = parts.groupBy("pivot").agg(
        F.count("*").alias("_parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("_main")
    )
    groups = groups.where("_parts > 1").select(
        "pivot",
        F.col("_main.component").alias("main"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("member_blocks"),
        F.ceil((F.col("n") - F.col("_main.n")) / BLOCK).cast("int").alias("outlier_blocks"),
    )
    rest = labelled.join(stage(groups, "groups"), "pivot")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = rest.select(
        "pivot", "id", "component", F.lit(False).alias("outside"),
        block("member_blocks").alias("mb"), each("outlier_blocks").alias("ob"),
    )
    outliers = rest.where("component != main").select(
        "pivot", "id", "component", F.lit(True).alias("outside"),
        each("member_blocks").alias("mb"), block("outlier_blocks").alias("ob"),
    )
    compared = members.union(outliers).join(texts, "id").repartition(tasks, "pivot", "mb", "ob").groupBy("pivot", "mb", "ob")
    further = compared.applyInArrow(_block_links(words, percent), f"a {name}, b {name}")
    merged = connected(stage(further, "links")).select(F.col("node").alias("component"), F.col("component").alias("_whole"))
    final = components.join(merged, "component", "left").select("node", F.coalesce("_whole", "component").alias("_component"))
    alone = merged.join(components, "component", "left_anti").select(F.col("component").alias("node"), F.col("_whole"))
    final = final.union(alone)

    named = sets.select(*same, F.col("id").alias("node")).join(final, "node", "left")
    named = named.select(*same, F.coalesce("_component", "node").alias("_component"))
    named = stage(named, "components")
    placed = all_rows.select("doc_id", *same).join(named, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
