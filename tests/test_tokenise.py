import json
import random

import pytest
from conftest import fragment
from pyspark.sql import functions as F

from cardweave import schemas as S
from cardweave.functions.plan import fits_broadcast, hot_keys
from cardweave.operators.parse import messages, parse_feed
from cardweave.operators.service import RetryPolicy
from cardweave.operators.tokenise import tokenise_local, tokenise_service, tokenise_vault


@pytest.fixture
def pans_of(feed_of):
    def build(pans):
        return messages(parse_feed(feed_of([fragment(DigitalPan=p) for p in pans])))

    return build


def tokens(df):
    return [r["tokenised_pan"] for r in df.orderBy("offset").collect()]


def test_local(pans_of):
    df = tokenise_local()(pans_of(["4111111111111111", "12", None, "1234"]), F.lit(True))
    assert tokens(df) == ["TOK-STUB-1111", "TOK-STUB-0000", "TOK-STUB-0000", "TOK-STUB-1234"]


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_vault(spark, pans_of, broadcast_bytes):
    vault = spark.createDataFrame(
        [("1", "A"), ("1", "A"), ("1", "B"), ("2", ""), ("3", None), (None, "N")], "digital_pan STRING, tokenised_pan STRING"
    )
    df = tokenise_vault(vault, broadcast_bytes)(pans_of(["1", "2", "3", "4", None, "1"]), F.lit(True))
    assert tokens(df) == ["A", "", None, None, None, "A"]


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_vault_leaves_inactive_rows_alone(spark, pans_of, broadcast_bytes):
    vault = spark.createDataFrame([("1", "A")], "digital_pan STRING, tokenised_pan STRING")
    df = tokenise_vault(vault, broadcast_bytes)(pans_of(["1", "1"]), F.col("offset") == 0)
    assert tokens(df) == ["A", None]


def skewed(spark, rows=30_000):
    """A third of the records on one PAN, a third without a PAN."""
    k = F.col("id")
    return spark.range(rows).select(
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        k.alias("offset"),
        F.when(k % 3 == 0, "hot").when(k % 3 == 1, None).otherwise(F.concat(F.lit("p"), k % 1000)).alias("digital_pan"),
    )


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_hot_keys_give_whole_results(spark, broadcast_bytes):
    feed = skewed(spark)
    pans = ["hot", *[f"p{i}" for i in range(1000) if i % 7]]
    vault = spark.createDataFrame([(p, "T" + p) for p in pans], "digital_pan STRING, tokenised_pan STRING")
    df = tokenise_vault(vault, broadcast_bytes)(feed, F.lit(True))
    got = {r["offset"]: r["tokenised_pan"] for r in df.collect()}
    known = set(pans)
    expected = {r["offset"]: "T" + r["digital_pan"] if r["digital_pan"] in known else None for r in feed.collect()}
    assert got == expected


@pytest.mark.parametrize("broadcast_bytes, merged", [(64 << 20, False), (20_000, False), (-1, True)])
def test_a_large_vault_is_narrowed_to_a_small_batch(spark, broadcast_bytes, merged):
    """20,000 bytes hold the cards of the batch and their tokens, but not the vault."""
    rows = [("t", 0, i, None if i % 9 == 0 else f"p{i % 100}") for i in range(500)]
    feed = spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, digital_pan STRING")
    copies = [(f"p{i}", t) for i in range(0, 2000, 2) for t in (f"T{i}", f"U{i}")]
    vault = spark.createDataFrame(copies, "digital_pan STRING, tokenised_pan STRING")
    df = tokenise_vault(vault, broadcast_bytes, small_batches=True)(feed, F.col("offset") != 2)
    assert ("SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()) == merged
    got = {r["offset"]: r["tokenised_pan"] for r in df.collect()}
    assert got == {
        i: f"T{i % 100}" if pan is not None and i % 2 == 0 and i != 2 else None for _, _, i, pan in rows
    }


def test_salted_lookup_spreads_hot_and_absent_keys(spark):
    """With AQE off, no task of the join gets more than a fair part of the hot third."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        vault = spark.createDataFrame([("hot", "T")], "digital_pan STRING, tokenised_pan STRING")
        df = tokenise_vault(vault, broadcast_bytes=-1)(skewed(spark), F.lit(True))
        plan = df._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert sum(sizes) == 30_000
    assert max(sizes) < 30_000 / 4


def test_only_hot_cards_are_salted(spark):
    feed = skewed(spark)
    assert hot_keys(feed, "digital_pan") == ["hot"]
    assert hot_keys(feed.limit(0), "digital_pan") == []
    vault = spark.createDataFrame([("hot", "T")] + [(f"p{i}", "T") for i in range(400)], "digital_pan STRING, tokenised_pan STRING")
    df = tokenise_vault(vault, broadcast_bytes=-1, salts=16)(feed, F.lit(True))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan
    copies = feed.select("digital_pan").distinct().count()
    assert copies > 400  # the vault side holds 16 rows of the hot card and one of each other


def test_fits_broadcast_measures_bytes(spark):
    df = spark.range(1000).select(F.repeat(F.lit("x"), 100).alias("s"))
    assert fits_broadcast(df, 1000 * 200)
    assert not fits_broadcast(df, 1000 * 100)
    assert fits_broadcast(df.limit(0), 0)


def counting_service(folder):
    """Writes each call to a file of its own, so that the test can count calls over all tasks."""

    def factory():
        import uuid

        def answer(body):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                out.write(body)
            pan = json.loads(body)["digitalPan"]
            if pan == "down":
                raise ConnectionError("503")
            if pan == "empty":
                return "{}"
            return json.dumps({"tokenisedPan": f"TOK-{pan}"})

        return answer

    return factory


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_service(pans_of, tmp_path, broadcast_bytes):
    waits = RetryPolicy(wait_seconds=0.0)
    pans = ["1111", "down", "empty", None, "1111", "1111", "off"]
    active = F.coalesce(F.col("digital_pan") != "off", F.lit(True))
    tokeniser = tokenise_service(counting_service(str(tmp_path)), waits, parallelism=3, broadcast_bytes=broadcast_bytes)
    rows = tokeniser(pans_of(pans), active).orderBy("offset").collect()
    rows = [(r["tokenised_pan"], r["token_attempts"], r["token_error"]) for r in rows]
    assert rows[0] == rows[4] == rows[5] == ("TOK-1111", 1, None)
    assert rows[1] == (None, 3, "ConnectionError: 503")
    assert rows[2][:2] == (None, 3) and "no token" in rows[2][2]
    assert rows[3] == ("TOK-None", 1, None)
    assert rows[6] == (None, None, None)
    calls = sorted(p.read_text() for p in tmp_path.iterdir())
    expected = [{"digitalPan": p} for p in ["1111", None, *["down"] * 3, *["empty"] * 3]]
    assert calls == sorted(json.dumps(e, separators=(",", ":")) for e in expected)


def test_random_vault_agrees_with_a_dict(spark):
    rng = random.Random(3)
    vault_rows = [(f"p{rng.randrange(300)}", f"T{rng.randrange(50)}") for _ in range(600)]
    smallest = {}
    for pan, token in vault_rows:
        smallest[pan] = min(token, smallest.get(pan, token))
    rows = [("t", 0, i, f"p{rng.randrange(400)}") for i in range(3000)]
    feed = spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, digital_pan STRING")
    vault = spark.createDataFrame(vault_rows, "digital_pan STRING, tokenised_pan STRING")
    df = tokenise_vault(vault, broadcast_bytes=-1, salts=5)(feed, F.lit(True))
    got = {r["offset"]: r["tokenised_pan"] for r in df.select(*S.RECORD_ID, "tokenised_pan").collect()}
    assert got == {i: smallest.get(pan) for _, _, i, pan in rows}


def test_only_records_with_a_card_to_look_up_are_dealt_out(spark):
    vault = spark.createDataFrame([("1", "T1")], "digital_pan STRING, tokenised_pan STRING")
    rows = [("t", 0, o, str(o % 2) if o % 5 else None) for o in range(100)]
    messages = spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, digital_pan STRING")
    joined = tokenise_vault(vault, broadcast_bytes=-1)(messages, F.col("offset") < 10)
    got = {r["offset"]: r["tokenised_pan"] for r in joined.collect()}
    assert got == {o: "T1" if pan == "1" and o < 10 else None for _, _, o, pan in rows}
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "isnotnull(_pan" in plan and "isnull(_pan" in plan
