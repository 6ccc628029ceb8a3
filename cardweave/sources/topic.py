"""Reading the feed from a topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardweave.operators.codec import text_feed

# The feed's default addresses.
DEFAULT_SERVERS = "localhost:9092"


def topic_options(
    servers: str = DEFAULT_SERVERS,
    topic: str | None = None,
    starting: str = "earliest",
    max_per_batch: int | None = None,
    min_tasks: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for the Kafka source. The streaming checkpoint takes the group's place.

    ``extra`` may name partitions of the topic with ``assign``. One task reads one topic partition, unless ``min_tasks`` asks for more: then the
    partitions that hold most of the records are read in several ranges.
    """
    if not topic:
        raise ValueError("a topic is required")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if min_tasks:
        options["minPartitions"] = str(min_tasks)
    if extra and "assign" in extra:  # the source takes topics or partitions, not both
        del options["subscribe"]
    return {**options, **(extra or {})}


def from_records(records: DataFrame) -> DataFrame:
    """Frame with Kafka's columns to feed columns, with text keys and values."""
    return text_feed(records).select("key", "value", "topic", "partition", F.col("offset").cast("bigint").alias("offset"))


def read_feed(spark: SparkSession, topic: str, streaming: bool = True, **options) -> DataFrame:
    """Feed of one topic, from the earliest record where no position is stored.

    ``streaming=False`` reads what the topic holds now. Needs the Kafka connector.
    """
    reader = spark.readStream if streaming else spark.read
    return from_records(reader.format("kafka").options(**topic_options(topic=topic, **options)).load())
