"""Which offsets are settled, as sets of intervals: exact where offsets are missing or records come late.

Offsets are cut into slices of fixed length. Intervals are merged slice by slice, and only those that
touch an edge of their slice, at most two for each, are merged along a topic partition. So no
partition, however long or busy, is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardweave.schemas import Result

_PARTITION = ["topic", "partition"]
RANGE = [*_PARTITION, "first", "last"]
#: Offsets in one slice.
SLICE = 1 << 20


def _islands(rows: DataFrame, within: list[str]) -> DataFrame:
    """Intervals that overlap or follow each other without a gap become one, among rows alike in ``within``."""
    order = Window.partitionBy(*within).orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("_new", (reached.isNull() | (F.col("first") > reached + 1)).cast("int"))
    numbered = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*within, "_island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_island")


def merge_ranges(ranges: DataFrame, slice_offsets: int = SLICE) -> DataFrame:
    """The union of intervals (topic, partition, first, last; both ends belong to it), as few as can be.

    Intervals may overlap, repeat and come in any order. A null in any column is no interval.
    """
    size = F.lit(slice_offsets)
    known = ranges.select(*RANGE).where("topic IS NOT NULL AND partition IS NOT NULL AND first <= last")
    slices = F.sequence(F.expr(f"first div {slice_offsets}"), F.expr(f"last div {slice_offsets}"))
    pieces = known.withColumn("_slice", F.explode(slices)).withColumns(
        {
            "first": F.greatest("first", F.col("_slice") * size),
            "last": F.least("last", (F.col("_slice") + 1) * size - 1),
        }
    )
    merged = _islands(pieces, [*_PARTITION, "_slice"])
    at_edge = (F.col("first") == F.col("_slice") * size) | (F.col("last") == (F.col("_slice") + 1) * size - 1)
    inside = merged.where(~at_edge).select(*RANGE)
    return inside.unionByName(_islands(merged.where(at_edge).select(*RANGE), _PARTITION))


def acked_ranges(outcomes: DataFrame, slice_offsets: int = SLICE) -> DataFrame:
    """The intervals of offsets that are settled: everything but what is to be retried.

    A record that is to be retried and was settled at another time, as in several batches taken
    together, counts as settled.
    """
    acked = outcomes.where(F.col("result") != Result.RETRY).select(*_PARTITION, F.col("offset").alias("first"))
    return merge_ranges(acked.withColumn("last", F.col("first")), slice_offsets)


def holes(ranges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """topic, partition, number, first, last: what lies between the intervals, which must be merged.

    ``starts`` (topic, partition, start) says where partitions begin; what is missing before the first
    interval is a hole too. Without it a partition begins with its first interval. Holes
    are numbered from 0 in each partition.
    """
    order = Window.partitionBy(*_PARTITION).orderBy("first")
    rows = ranges.select(*RANGE)
    if starts is not None:
        before = starts.select(*_PARTITION, (F.col("start") - 1).alias("first"), (F.col("start") - 1).alias("last"))
        rows = rows.unionByName(before)
    next_first = F.lead("first").over(order)
    found = rows.select(*_PARTITION, (F.col("last") + 1).alias("first"), (next_first - 1).alias("last"))
    found = found.where("first <= last")
    return found.select(*_PARTITION, (F.row_number().over(order) - 1).alias("number"), "first", "last")


def positions(ranges: DataFrame) -> DataFrame:
    """topic, partition, safe_position, committed, gaps: one row for each topic partition, from merged intervals.

    All that lies before ``safe_position`` is settled, from the first settled offset on. ``committed`` is
    behind the last settled offset, where a plain commit would be, and ``gaps`` the offsets between that are not settled.
    """
    return ranges.groupBy(*_PARTITION).agg(
        (F.min_by("last", "first") + 1).alias("safe_position"),
        (F.max("last") + 1).alias("committed"),
        (F.max("last") + 1 - F.min("first") - F.sum(F.col("last") - F.col("first") + 1)).alias("gaps"),
    )
