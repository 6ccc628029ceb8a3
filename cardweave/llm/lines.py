"""Line dedup with two Bloom filters.

A line's key is the line without white space at both ends and with A-Z lower-cased. Keys of
at least ten code points that occur in two or more documents keep only the lines of the
smallest doc_id; the rest of each text stays as it is.

Every task sets the bits of its keys in a filter of keys seen once, and again in a filter of
keys seen twice when their bits were there before. Filters of tasks merge bit by bit: what
is set in both of two once-filters is seen twice. Only lines whose bits are all in the
merged twice-filter, a superset of the repeated ones, go through a shuffle, as digests, where
they are confirmed exactly and the first document is chosen.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.llm.kernel import SPACE_BYTES
from cardweave.storage import stage

MIN_CODE_POINTS = 10
#: Filter size: bits for each line, and the bounds of the whole. Beyond the largest size more
#: lines are suspected and shuffled; the result does not depend on it.
BITS_PER_LINE, LEAST_BITS, MOST_BITS = 12, 1 << 20, 1 << 28
_SLICE_BITS = 1 << 20
_BLANKS = bytes(SPACE_BYTES)


def line_digest(line: bytes, min_code_points: int = MIN_CODE_POINTS) -> bytes | None:
    """SHA-256 of a line's key, or None when the key is too short to be compared."""
    key = line.strip(_BLANKS).lower()
    # A code point has at most four bytes.
    if len(key) < 4 * min_code_points and len(key.decode("utf-8", "replace")) < min_code_points:
        return None
    return hashlib.sha256(key).digest()


def _digests(text: str | None, min_code_points: int) -> list[bytes | None]:
    return [line_digest(line, min_code_points) for line in (text or "").encode().split(b"\n")]


def _positions(digests: list[bytes], bits: int) -> np.ndarray:
    """Two bit positions for each digest, a row each."""
    words = np.frombuffer(b"".join(d[:16] for d in digests), "<u8").reshape(-1, 2)
    return (words & np.uint64(bits - 1)).astype(np.int64)


def _has(filter_bytes: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (filter_bytes[positions >> 3] >> (positions & 7).astype(np.uint8) & 1).all(axis=1)


def _set(filter_bytes: np.ndarray, positions: np.ndarray) -> None:
    flat = positions.ravel()
    np.bitwise_or.at(filter_bytes, flat >> 3, np.left_shift(1, flat & 7).astype(np.uint8))


def _collect_filters(bits: int, min_code_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                keys: list[bytes] = []
                for text in batch.column(0).slice(first, 256).to_pylist():
                    keys.extend({d for d in _digests(text, min_code_points) if d is not None})
                if not keys:
                    continue
                keys.sort()
                # A key of two rows stands twice in a row here.
                again = [b for a, b in zip(keys, keys[1:]) if a == b]
                if again:
                    _set(twice, _positions(again, bits))
                places = _positions(keys, bits)
                seen = places[_has(once, places)]
                _set(twice, seen)
                _set(once, places)
        step = _SLICE_BITS >> 3
        for k in range(bits // _SLICE_BITS):
            part = slice(k * step, (k + 1) * step)
            if once[part].any():
                packed = [zlib.compress(once[part].tobytes(), 1)], [zlib.compress(twice[part].tobytes(), 1)]
                yield pa.record_batch([pa.array([k], pa.int32()), *packed], ["slice", "once", "twice"])

    return run


def _merge_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the rows of a slice; a task holds one pair of filters for each of its slices."""
    merged: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            once, twice = (np.frombuffer(zlib.decompress(row[n]), np.uint8) for n in ("once", "twice"))
            if row["slice"] in merged:
                a, b = merged[row["slice"]]
                once, twice = a | once, b | twice | (a & once)
            merged[row["slice"]] = once, twice
    for k, (once, twice) in merged.items():
        packed = [zlib.compress(once.tobytes(), 1)], [zlib.compress(twice.tobytes(), 1)]
        yield pa.record_batch([pa.array([k], pa.int32()), *packed], ["slice", "once", "twice"])


def twice_seen_filter(df: DataFrame, bits: int, min_code_points: int = MIN_CODE_POINTS) -> np.ndarray:
    """The bytes of the Bloom filter of line keys seen in two rows or more, at most 32 MB."""
    schema = "slice int, once binary, twice binary"
    filters = df.select("text").mapInArrow(_collect_filters(bits, min_code_points), schema)
    tasks = 16
    salted = filters.withColumn("salt", F.pmod(F.xxhash64("once"), F.lit(tasks)))
    halfway = salted.repartition(tasks * 4, "slice", "salt").drop("salt").mapInArrow(_merge_filters, schema)
    whole = halfway.repartition(tasks, "slice").mapInArrow(_merge_filters, schema)
    out = np.zeros(bits >> 3, np.uint8)
    step = _SLICE_BITS >> 3
    for row in whole.select("slice", "twice").collect():  # at most MOST_BITS in all
        out[row["slice"] * step : (row["slice"] + 1) * step] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return out


def _suspects(broadcast, bits: int, min_code_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = broadcast.value
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                keys: list[bytes] = []
                rows: list[int] = []
                for i, text in enumerate(part.column(1).to_pylist()):
                    own = {d for d in _digests(text, min_code_points) if d is not None}
                    keys.extend(own)
                    rows.extend([i] * len(own))
                if not keys:
                    continue
                hit = np.flatnonzero(_has(twice, _positions(keys, bits)))
                ids = part.column(0).take(pa.array(np.asarray(rows, np.int64)[hit]))
                yield pa.record_batch([pa.array([keys[i] for i in hit], pa.binary()), ids], ["key", "doc_id"])

    return run


def _rebuild(min_code_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                names = part.schema.names[:-1]
                texts, n_lines, n_dropped = [], [], []
                for text, drop in zip(part.column("text").to_pylist(), part.column(part.num_columns - 1).to_pylist()):
                    lines = (text or "").split("\n")
                    n_lines.append(len(lines))
                    if drop:
                        gone = set(drop)
                        lines = [x for x in lines if line_digest(x.encode(), min_code_points) not in gone]
                        text = "\n".join(lines)
                    texts.append(text)
                    n_dropped.append(n_lines[-1] - len(lines))
                columns = [pa.array(texts, part.schema.field("text").type) if n == "text" else part.column(n) for n in names]
                counts = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                yield pa.record_batch([*columns, *counts], [*names, "n_lines", "n_dropped"])

    return run


def count_lines(df: DataFrame) -> int:
    text = F.col("text")
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return df.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1).alias("n")).first()["n"] or 0


def dedup_lines(df: DataFrame, min_code_points: int = MIN_CODE_POINTS) -> DataFrame:
    """``df`` (doc_id, text and any other columns) with repeated lines gone.

    Adds n_lines, the lines before, and n_dropped; input columns of these names are
    replaced. A null or empty text is one empty line and stays null or empty. Rows with a
    null doc_id are no document: they keep all lines and count for no other row. Rows with
    the same doc_id are one document, so they do not repeat each other. No rows give no rows.
    """
    spark = df.sparkSession
    df = df.drop("n_lines", "n_dropped")
    bits = 1 << max(0, BITS_PER_LINE * count_lines(df) - 1).bit_length()
    bits = min(max(bits, LEAST_BITS), MOST_BITS)
    twice = spark.sparkContext.broadcast(twice_seen_filter(df.where("doc_id IS NOT NULL"), bits, min_code_points))
    id_type = df.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("doc_id", id_type)])
    found = df.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(_suspects(twice, bits, min_code_points), schema)
    suspects = stage(found, "line-suspects")
    firsts = suspects.groupBy("key").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).where("_first < _last")
    # Written down, so that both sides of the join are plain exchanges and a common line's rows can be split.
    firsts = stage(firsts.drop("_last"), "line-firsts")
    drops = (
        suspects.join(firsts, "key")
        .where("doc_id > _first")
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("_dropped_keys"))
    )
    joined = df.join(drops, "doc_id", "left").select(*[df[c] for c in df.columns], "_dropped_keys")
    counts = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    return joined.mapInArrow(_rebuild(min_code_points), T.StructType([*df.schema.fields, *counts]))


def lines_digest(df: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of what is left of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return dedup_lines(df.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))
