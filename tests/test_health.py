import random

import pytest
from pyspark.sql import functions as F

from cardweave.operators.health import call_health, continued_health
from cardweave.sinks.store import Store
from cardweave.streaming.health import health_batch


def brute_force(calls, window, threshold):
    expected = {}
    by_service = {}
    for service, ts, seq, failed in sorted(calls, key=lambda c: (c[0], c[1], c[2])):
        last = by_service.setdefault(service, [])
        last.append(failed)
        recent = last[-window:]
        rate = sum(recent) / len(recent)
        expected[(service, seq)] = (len(recent), sum(recent), rate, len(recent) == window and rate >= threshold)
    return expected


def run(spark, calls, slices, window=10, threshold=0.5):
    df = spark.createDataFrame(calls, "s STRING, ts BIGINT, seq BIGINT, failed BOOLEAN")
    health = call_health(df, F.col("s"), ["ts", "seq"], F.col("failed"), window, threshold, slices)
    return {
        (r["service"], r["seq"]): (r["window_size"], r["failures"], r["failure_rate"], r["flagged"])
        for r in health.collect()
    }


@pytest.mark.parametrize("slices", [1, 3, 16])
@pytest.mark.parametrize("size", [0, 1, 7, 60, 700])
def test_agrees_with_brute_force(spark, slices, size):
    rng = random.Random(size * 31 + slices)
    calls = [(rng.choice("aaaaaab"), rng.randrange(20), i, rng.random() < 0.5) for i in range(size)]
    assert run(spark, calls, slices) == brute_force(calls, 10, 0.5)


def test_window_wider_than_the_slices(spark):
    """About two calls per slice: the window reaches back over several slices."""
    rng = random.Random(5)
    calls = [("a", i, i, rng.random() < 0.5) for i in range(64)]
    assert run(spark, calls, slices=32) == brute_force(calls, 10, 0.5)


def test_other_windows(spark):
    calls = [("a", i, i, i % 3 == 0) for i in range(40)]
    assert run(spark, calls, 4, window=1, threshold=1.0) == brute_force(calls, 1, 1.0)
    assert run(spark, calls, 4, window=25, threshold=0.3) == brute_force(calls, 25, 0.3)


def test_a_full_window_at_the_threshold_is_flagged(spark):
    calls = [("a", i, i, i % 2 == 0) for i in range(10)]
    flags = run(spark, calls, 1)
    assert [flags[("a", i)][3] for i in range(10)] == [False] * 9 + [True]


def test_one_service_is_windowed_by_many_tasks(spark):
    """Neither the slices nor the second window over their ends puts a service into one task."""
    df = spark.range(20_000).select(F.lit("only").alias("s"), "id", (F.col("id") % 2 == 0).alias("failed"))
    health = call_health(df, F.col("s"), ["id"], F.col("failed"), slices=64)
    [source] = {f.rsplit("/", 1)[0] for f in health.inputFiles()}
    staged = spark.read.parquet(source)
    slices = [r["count"] for r in staged.groupBy("_slice").count().collect()]
    assert sum(slices) == 20_000 and max(slices) < 20_000 / 16
    assert staged.filter("_first OR _last").count() == 64 * 18


def slice_sizes(spark, df, order, slices):
    health = call_health(df, F.col("s"), order, F.col("failed"), slices=slices)
    [source] = {f.rsplit("/", 1)[0] for f in health.inputFiles()}
    return sorted(r["count"] for r in spark.read.parquet(source).groupBy("_slice").count().collect()), health


@pytest.mark.parametrize("value", ["TIMESTAMP_NTZ '2024-05-01 10:00:00'", "CAST(NULL AS TIMESTAMP_NTZ)"])
def test_calls_at_one_time_are_cut_by_the_next_column(spark, value):
    df = spark.range(30_000).selectExpr(
        "'only' AS s",
        f"IF(id % 3 = 0, {value}, TIMESTAMP_NTZ '2024-05-01 00:00:00' + make_dt_interval(0, 0, 0, id)) AS ts",
        "id", "id % 2 = 0 AS failed",
    )
    sizes, health = slice_sizes(spark, df, ["ts", "id"], 30)
    assert sum(sizes) == 30_000 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert health.count() == 30_000


@pytest.mark.parametrize("slices", [2, 5, 40])
def test_ties_in_several_columns_against_brute_force(spark, slices):
    rng = random.Random(slices)
    calls = [(rng.choice("aab"), rng.choice([None, 3, 3, 3, rng.randrange(9)]), rng.choice([1, 1, 1, rng.randrange(5)]), i, rng.random() < 0.5) for i in range(600)]
    df = spark.createDataFrame(calls, "s STRING, ts BIGINT, host BIGINT, seq BIGINT, failed BOOLEAN")
    health = call_health(df, F.col("s"), ["ts", "host", "seq"], F.col("failed"), slices=slices)
    got = {(r["service"], r["seq"]): (r["window_size"], r["failures"]) for r in health.collect()}
    order = sorted(calls, key=lambda c: (c[1] is not None, c[1] or 0, c[2], c[3]))
    expected = brute_force([(c[0], 0, k, c[4]) for k, c in enumerate(order)], 10, 0.5)
    assert got == {(c[0], c[3]): expected[c[0], k][:2] for k, c in enumerate(order)}


def test_names_as_the_first_column(spark):
    df = spark.createDataFrame([("a", f"{i:03}", i % 2 == 0) for i in range(50)], "s STRING, id STRING, failed BOOLEAN")
    got = call_health(df, F.col("s"), ["id"], F.col("failed"), slices=4).collect()
    assert sorted((r["id"], r["window_size"]) for r in got)[-1] == ("049", 10)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_parts_one_after_the_other_equal_the_whole(spark, tmp_path, parts):
    rng = random.Random(parts)
    calls = [(rng.choice("aaaab"), i // 7, i, rng.random() < 0.5) for i in range(200)]
    expected = brute_force(calls, 10, 0.5)
    store = Store(spark, str(tmp_path / "store"))
    size = -(-len(calls) // parts)
    for batch_id in range(min(parts, 6)):
        last = len(calls) if batch_id == min(parts, 6) - 1 else (batch_id + 1) * size
        part = spark.createDataFrame(calls[batch_id * size : last], "s STRING, ts BIGINT, seq BIGINT, failed BOOLEAN")
        for _ in range(2 if batch_id == 1 else 1):  # one of them is replayed
            health_batch(store, part, batch_id, F.col("s"), ["ts", "seq"], F.col("failed"))
    rows = spark.read.parquet(f"{store.root}/health").collect()
    got = {(r["service"], r["seq"]): (r["window_size"], r["failures"], r["failure_rate"], r["flagged"]) for r in rows}
    assert len(rows) == 200 and got == expected


def test_a_tail_alone_gives_no_calls(spark):
    calls = spark.createDataFrame([("a", i, True) for i in range(12)], "s STRING, seq BIGINT, failed BOOLEAN")
    rows = calls.selectExpr("s AS service", "seq", "CAST(failed AS INT) AS _failed")
    judged, tail = continued_health(rows.limit(0), calls, F.col("s"), ["seq"], F.col("failed"))
    assert judged.count() == 12 and sorted(r["seq"] for r in tail.collect()) == list(range(3, 12))
    judged, after = continued_health(tail, calls.limit(0), F.col("s"), ["seq"], F.col("failed"))
    assert judged.count() == 0 and sorted(after.collect()) == sorted(tail.collect())
