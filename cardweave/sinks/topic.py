"""Publishing (key, value) records to a topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave.functions.topic_hash import topic_partition
from cardweave.operators.codec import encrypt_feed
from cardweave.sources.topic import DEFAULT_SERVERS

# Fixed values of the publisher.
ACKS = "all"
CLIENT_ID = "folder-publisher"


def publish_options(
    topic: str, servers: str = DEFAULT_SERVERS, client_id: str = CLIENT_ID, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    if not topic:
        raise ValueError("a topic is required")
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": ACKS,
        "kafka.client.id": client_id,
        **(extra or {}),
    }


def publish_records(records: DataFrame, key: bytes | None = None) -> DataFrame:
    """What is sent: key and value, the value in an envelope when a ``key`` is given."""
    sealed = encrypt_feed(records, key) if key else records
    return sealed.select("key", "value")


def ordered_records(records: DataFrame, partitions: int, order: str = "path", key: bytes | None = None) -> DataFrame:
    """What is sent, with the partition of each record, so that records of one key arrive in ``order``.

    ``partitions`` is the topic's number of partitions. A partition's records are in one task, in order, so
    the task that writes a key is the only one that does; records without a key have no order and no partition.
    A partition of the topic is written by one producer, in turn, as it will be read.
    """
    dealt = records.withColumn("partition", topic_partition(F.col("key"), partitions))
    spread = F.coalesce("partition", F.pmod(F.xxhash64(order), F.lit(partitions)).cast("int"))
    placed = dealt.repartition(partitions, spread).sortWithinPartitions("partition", order)
    sealed = encrypt_feed(placed, key) if key else placed
    return sealed.select("key", "value", "partition")


def publish_feed(
    records: DataFrame, topic: str, key: bytes | None = None, checkpoint: str | None = None, partitions: int | None = None, **options
):
    """Write to the topic: a batch write, or a started query when ``records`` is a stream.

    With ``partitions``, the topic's number of them, a batch of files is published in path order for each key. The
    producer then sends one request at a time, so that a repeated one does not overtake.
    """
    settings = publish_options(topic, **options)
    if not records.isStreaming:
        out = ordered_records(records, partitions, key=key) if partitions else publish_records(records, key)
        if partitions:
            settings = {"kafka.max.in.flight.requests.per.connection": "1", **settings}
        out.write.format("kafka").options(**settings).save()
        return None
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint location")
    if partitions:
        raise ValueError("a stream is published in order batch by batch: publish from foreachBatch")
    out = publish_records(records, key)
    return out.writeStream.format("kafka").options(**settings).option("checkpointLocation", checkpoint).start()
