import random

import pytest
from pyspark.sql import functions as F

from cardweave.operators.vault import open_vault, prepare_vault, tokenise_prepared
from cardweave.storage import fresh_path

MESSAGES = "topic STRING, partition INT, offset BIGINT, digital_pan STRING"


@pytest.fixture(scope="module")
def vault(spark):
    rows = [(f"4{i:05}", f"T{i}") for i in range(3000)] * 2 + [("400001", "S0"), (None, "x"), ("9", None)]
    frame = spark.createDataFrame(rows, "digital_pan STRING, tokenised_pan STRING")
    return prepare_vault(frame, fresh_path(spark, "vault"), buckets=4)


def messages_of(spark, pans):
    return spark.createDataFrame([("t", 0, i, p) for i, p in enumerate(pans)], MESSAGES).repartition(3)


def tokens(df):
    return {r["offset"]: r["tokenised_pan"] for r in df.collect()}


@pytest.mark.parametrize("named", [0, 1000])
def test_tokens_by_name_and_bucket_by_bucket(spark, vault, named):
    rng = random.Random(2)
    # A third of the records have one card, some have none.
    pans = [rng.choice(["400007", rng.choice([None, "", "9", "12"]), f"4{rng.randrange(3200):05}"]) for _ in range(600)] + ["400001"]
    expected = {i: f"T{int(p[1:])}" if p and len(p) == 6 and int(p[1:]) < 3000 else None for i, p in enumerate(pans)}
    expected[600] = "S0"
    expected |= {i: "S0" for i, p in enumerate(pans) if p == "400001"}
    got = tokens(tokenise_prepared(vault, named)(messages_of(spark, pans), F.lit(True)))
    assert got == expected


def test_inactive_records_and_an_empty_batch(spark, vault):
    messages = messages_of(spark, ["400001", "400002"])
    got = tokens(tokenise_prepared(vault, 0)(messages, F.col("offset") == 1))
    assert got == {0: None, 1: "T2"}
    assert tokens(tokenise_prepared(vault)(messages.limit(0), F.lit(True))) == {}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_vault_is_not_shuffled(spark, vault):
    many = messages_of(spark, [f"4{i:05}" for i in range(2000)])
    text = plan(tokenise_prepared(vault, 10)(many, F.lit(True)))
    join = text[text.index("SortMergeJoin") :]
    # One side of the join is dealt, the other is read by buckets.
    assert join.count("Exchange") == 1 and join.count("Bucketed: true") == 1


def test_few_cards_are_asked_for_by_name(spark, vault):
    text = plan(tokenise_prepared(vault)(messages_of(spark, ["400001", None, "400001"]), F.lit(True)))
    # The filter reaches the scan, which leaves out the other buckets and row groups.
    assert "EqualTo(digital_pan,400001)" in text and "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text


def test_another_session_opens_it(spark, vault):
    again = open_vault(spark, vault.folder, vault.buckets)
    assert again.read().count() == 3000 and again.table != vault.table
    assert tokens(tokenise_prepared(again, 0)(messages_of(spark, ["400005"]), F.lit(True))) == {0: "T5"}
    with pytest.raises(ValueError):
        open_vault(spark, "x' OR '", 4)
