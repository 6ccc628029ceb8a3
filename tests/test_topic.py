import json

import pytest
from pyspark.sql import functions as F

from cardweave import schemas as S
from cardweave.functions.topic_hash import murmur2, topic_partition
from cardweave.operators.codec import decrypt_feed
from cardweave.sinks.topic import ordered_records, publish_feed, publish_options
from cardweave.sources import resume
from cardweave.sources.topic import from_records, topic_options


def test_source_options():
    assert topic_options(topic="rtf") == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "rtf",
        "startingOffsets": "earliest",
    }
    options = topic_options("a:1,b:2", "rtf", "latest", 500, 64, {"kafka.security.protocol": "SSL"})
    assert options["kafka.bootstrap.servers"] == "a:1,b:2"
    assert options["startingOffsets"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "500"
    assert options["minPartitions"] == "64"
    assert options["kafka.security.protocol"] == "SSL"


def test_sink_options():
    assert publish_options("rtf") == {
        "kafka.bootstrap.servers": "localhost:9092",
        "topic": "rtf",
        "kafka.acks": "all",
        "kafka.client.id": "folder-publisher",
    }


def test_a_topic_is_required():
    with pytest.raises(ValueError):
        topic_options()
    with pytest.raises(ValueError):
        publish_options("")


def test_records_become_feed_columns(spark):
    schema = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT"
    rows = [(bytearray(b"k"), bytearray("é".encode()), "rtf", 2, 7, None, 0), (None, None, "rtf", 2, 8, None, 0)]
    feed = from_records(spark.createDataFrame(rows, schema))
    assert feed.dtypes == [(f.name, f.dataType.simpleString()) for f in S.FEED]
    assert [tuple(r) for r in feed.collect()] == [("k", "é", "rtf", 2, 7), (None, None, "rtf", 2, 8)]


def test_a_published_stream_needs_a_checkpoint(spark):
    stream = spark.readStream.format("rate").load().selectExpr("'k' AS key", "'v' AS value")
    with pytest.raises(ValueError):
        publish_feed(stream, "rtf")


def plain_murmur2(data):
    """The hash, step by step on 32-bit numbers."""
    mask, m = 0xFFFFFFFF, 0x5BD1E995
    h, n = 0x9747B28C ^ len(data), len(data) // 4 * 4
    for i in range(0, n, 4):
        k = int.from_bytes(data[i : i + 4], "little") * m & mask
        h = (h * m & mask) ^ ((k ^ k >> 24) * m & mask)
    if len(data) > n:
        h = (h ^ int.from_bytes(data[n:], "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


# Published values of the hash, as signed numbers.
VECTORS = {
    b"21": -973932308,
    b"foobar": -790332482,
    b"a-little-bit-long-string": -985981536,
    b"a-little-bit-longer-string": -1486304829,
    b"lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971,
    b"abc": 479470107,
}


def test_hash_of_keys(spark):
    keys = [*VECTORS, b"", b"\x00", bytes(range(256)), b"\xff" * 7, "é-17".encode()] + [b"k" * n for n in range(12)]
    rows = spark.createDataFrame([(bytearray(k),) for k in keys], "key BINARY").select("key", murmur2(F.col("key")).alias("h"))
    got = {bytes(r["key"]): r["h"] for r in rows.collect()}
    assert got == {k: plain_murmur2(k) for k in keys}
    assert {k: (got[k] ^ 0x80000000) - 0x80000000 for k in VECTORS} == VECTORS


def test_partitions_of_text_and_absent_keys(spark):
    rows = spark.createDataFrame([("order-1",), (None,)], "key STRING")
    got = [r["p"] for r in rows.select(topic_partition(F.col("key"), 7).alias("p")).collect()]
    assert got == [(plain_murmur2(b"order-1") & 0x7FFFFFFF) % 7, None]


@pytest.mark.parametrize("secret", [None, b"0123456789abcdef"])
def test_records_of_a_key_are_in_path_order(spark, secret):
    rows = [(f"k{i % 5}" if i % 7 else None, f"v{i}", f"/in/{(i * 37) % 100:03}.xml") for i in range(100)]
    records = spark.createDataFrame(rows, "key STRING, value STRING, path STRING").repartition(6)
    sent = ordered_records(records, 3, key=secret)
    sent = sent.withColumns({"task": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    if secret:
        sent = decrypt_feed(sent, secret)
    found = sent.collect()
    where, path = {v: (k, p) for k, v, p in rows}, {}
    for row in sorted(found, key=lambda r: r["place"]):
        key, own = where[row["value"]]
        assert row["key"] == key
        if key is not None:
            assert path.get(key, "") < own  # in order
            path[key] = own
    tasks = {(r["partition"], r["task"]) for r in found if r["key"] is not None}
    assert len(tasks) == len({p for p, _ in tasks}) and len(found) == 100


def test_what_an_ordered_write_asks_of_the_topic(spark, monkeypatch):
    asked = {}

    class Writer:
        def format(self, name):
            asked["format"] = name
            return self

        def options(self, **options):
            asked.update(options)
            return self

        def save(self):
            asked["saved"] = True

    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda self: Writer()))
    records = spark.createDataFrame([("k", "v", "/a")], "key STRING, value STRING, path STRING")
    publish_feed(records, "rtf", partitions=4)
    assert asked["format"] == "kafka" and asked["saved"] and asked["topic"] == "rtf" and asked["kafka.acks"] == "all"
    assert asked["kafka.max.in.flight.requests.per.connection"] == "1"


def test_partitions_named_instead_of_topics():
    options = topic_options(topic="rtf", extra={"assign": '{"rtf":[0,2]}', "endingOffsets": "{}"})
    assert "subscribe" not in options and options["assign"] == '{"rtf":[0,2]}'


def test_reads_of_holes(spark, monkeypatch):
    """What the source is asked for, and that only unsettled records of its answer are kept."""
    asked = []

    def read(session, topic, streaming, starting, extra):
        asked.append((json.loads(starting), json.loads(extra["endingOffsets"]), json.loads(extra["assign"])))
        rows = [
            ("k", "v", "rtf", int(p), o)
            for p, first in json.loads(starting)["rtf"].items()
            for o in range(first, json.loads(extra["endingOffsets"])["rtf"][p])
        ]
        return session.createDataFrame(rows, S.FEED)

    monkeypatch.setattr(resume, "read_feed", read)
    rows = [("rtf", 0, 0, 2), ("rtf", 0, 5, 6), ("rtf", 0, 8, 9), ("rtf", 1, 0, 3), ("rtf", 1, 5, 9), ("other", 0, 0, 0), ("other", 0, 9, 9)]
    ranges = spark.createDataFrame(rows, S.RANGES)
    got = resume.read_unsettled(spark, "rtf", ranges, reads=1)
    assert asked == [({"rtf": {"0": 3, "1": 4}}, {"rtf": {"0": 8, "1": 5}}, {"rtf": [0, 1]})]
    assert sorted((r["partition"], r["offset"]) for r in got.collect()) == [(0, 3), (0, 4), (0, 7), (1, 4)]
