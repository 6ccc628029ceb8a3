"""Reading a topic from what the ledger says: where to go on, and what to read again."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardweave.operators.intervals import RANGE, SLICE, holes, positions
from cardweave.sources.topic import read_feed

# The source's word, and its numbers, for the ends of a partition.
EARLIEST, EARLIEST_OFFSET = "earliest", -2
#: Reads in which a topic's holes are read again.
READS = 8


def offsets_json(rows: DataFrame, position: Column, others: Mapping[str, int] | None = None) -> str | None:
    """``{"topic": {"0": 17, ...}}`` of rows with topic and partition; None without rows.

    The source wants every partition of a topic named: with ``others``, the number of partitions by topic, those
    without a row are read from their earliest record. One number for each topic partition reaches
    the driver, as in the source itself.
    """
    named = rows.select("topic", F.col("partition").cast("int").alias("partition"), position.cast("bigint").alias("position"))
    spark = rows.sparkSession
    if others:
        every = spark.createDataFrame(sorted(others.items()), "topic STRING, n INT")
        every = every.select("topic", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("partition"))
        named = every.join(named, ["topic", "partition"], "full").fillna(EARLIEST_OFFSET, ["position"])
    entry = F.struct(F.col("partition"), F.col("position"))
    text = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["partition"].cast("string"), e["position"]))
    topics = named.groupBy("topic").agg(F.map_from_entries(text).alias("offsets"))
    entries = F.sort_array(F.collect_list(F.struct("topic", F.to_json("offsets"))))
    lines = F.transform(entries, lambda e: F.concat(F.lit('"'), e["topic"], F.lit('":'), e["col2"]))
    found = topics.agg(F.concat(F.lit("{"), F.array_join(lines, ","), F.lit("}")).alias("json"), F.count("*").alias("n")).first()
    return found["json"] if found["n"] else None


def resume_from(ranges: DataFrame, partitions: Mapping[str, int] | None = None) -> str:
    """Starting offsets behind all that is settled, of merged intervals; ``earliest`` where nothing is stored."""
    return offsets_json(positions(ranges), F.col("committed"), partitions) or EARLIEST


def replay_windows(ranges: DataFrame, starts: DataFrame | None = None, reads: int = READS) -> DataFrame:
    """read, topic, partition, first, last: bounded reads that cover every hole of merged intervals.

    A partition with more than ``reads`` holes has neighbouring ones in one read, together with what lies
    between; :func:`unsettled` drops that again.
    """
    found = holes(ranges, starts)
    count = F.count("*").over(Window.partitionBy("topic", "partition"))
    dealt = found.withColumn("read", F.floor(F.col("number") * F.least(count, F.lit(reads)) / count).cast("int"))
    return dealt.groupBy("read", "topic", "partition").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def unsettled(feed: DataFrame, ranges: DataFrame, slice_offsets: int = SLICE) -> DataFrame:
    """The records of ``feed`` whose offset is in none of the intervals.

    Records and intervals meet slice by slice, in the order of their offsets: a record is settled when the
    furthest end of an interval that began before it is not before it.
    """
    slices = F.sequence(F.expr(f"first div {slice_offsets}"), F.expr(f"last div {slice_offsets}"))
    reach = ranges.select(*RANGE).withColumn("_slice", F.explode(slices))
    reach = reach.select("topic", "partition", "_slice", F.col("first").alias("offset"), F.col("last").alias("_last"))
    rows = feed.withColumns({"_slice": F.expr(f"offset div {slice_offsets}"), "_record": F.lit(True)})
    both = rows.unionByName(reach, allowMissingColumns=True)
    order = Window.partitionBy("topic", "partition", "_slice").orderBy("offset", F.col("_record").asc_nulls_first())
    reached = F.max("_last").over(order.rowsBetween(Window.unboundedPreceding, 0))
    judged = both.withColumn("_reached", reached).where("_record")
    return judged.where(F.col("_reached").isNull() | (F.col("_reached") < F.col("offset"))).select(*feed.columns)


def read_unsettled(
    spark: SparkSession, topic: str, ranges: DataFrame, starts: DataFrame | None = None, reads: int = READS, **options
) -> DataFrame:
    """The records of one topic that lie in holes, by bounded batch reads. Needs the Kafka connector."""
    own = ranges.where(F.col("topic") == topic)
    windows = replay_windows(own, starts, reads)
    parts = []
    for read in sorted(r["read"] for r in windows.select("read").distinct().collect()):  # at most ``reads``
        one = windows.where(F.col("read") == read)
        begin, end = offsets_json(one, F.col("first")), offsets_json(one, F.col("last") + 1)
        numbers = [r["partition"] for r in one.select("partition").collect()]
        limits = {"assign": f'{{"{topic}":{sorted(numbers)}}}', "endingOffsets": end}
        parts.append(read_feed(spark, topic, streaming=False, starting=begin, extra=limits, **options))
    if not parts:
        return read_feed(spark, topic, streaming=False, **options).limit(0)
    return unsettled(reduce(DataFrame.unionByName, parts), own)
