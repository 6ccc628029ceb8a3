import json
import random

import pytest
from pyspark.sql import functions as F

from cardweave import schemas as S
from cardweave.operators.intervals import acked_ranges, holes, merge_ranges, positions
from cardweave.sources.resume import offsets_json, replay_windows, resume_from, unsettled


def ranges_of(spark, rows):
    return spark.createDataFrame(rows, S.RANGES).repartition(3)


def covered(rows):
    """The offsets in intervals, by topic partition."""
    found = {}
    for topic, partition, first, last in rows:
        found.setdefault((topic, partition), set()).update(range(first, last + 1))
    return found


def islands(offsets):
    out = []
    for key, own in offsets.items():
        for o in sorted(own):
            if out and out[-1][:2] == list(key) and out[-1][3] == o - 1:
                out[-1][3] = o
            else:
                out.append([*key, o, o])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_merging_against_sets(spark, size):
    rng = random.Random(size)
    rows = []
    for _ in range(300):
        first = rng.choice([rng.randint(0, 1500), rng.randint(0, 40) * size % 1500])
        rows.append((rng.choice("ab"), rng.randint(0, 2), first, first + rng.choice([0, 0, 1, 5, rng.randint(0, 60)])))
    rows += rows[:20]
    got = sorted(tuple(r) for r in merge_ranges(ranges_of(spark, rows), size).collect())
    assert got == islands(covered(rows))


def test_edges_of_slices_join_in_long_chains(spark):
    rows = [("t", 0, 10 * i, 10 * i + 9) for i in range(200)] + [("t", 0, 2001, 2001), ("t", 1, 9, 10)]
    got = sorted(tuple(r) for r in merge_ranges(ranges_of(spark, rows), 10).collect())
    assert got == [("t", 0, 0, 1999), ("t", 0, 2001, 2001), ("t", 1, 9, 10)]


def test_nothing_and_nulls(spark):
    assert merge_ranges(ranges_of(spark, [])).collect() == []
    rows = [(None, 0, 1, 2), ("t", None, 1, 2), ("t", 0, None, 2), ("t", 0, 3, None), ("t", 0, 5, 4), ("t", 0, 6, 6)]
    assert [tuple(r) for r in merge_ranges(ranges_of(spark, rows)).collect()] == [("t", 0, 6, 6)]


def outcomes_of(spark, rows):
    return spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, result STRING").repartition(3)


def test_missing_and_late_offsets(spark):
    first = [("t", 0, o, "SUCCESS") for o in (0, 1, 2, 7, 8)] + [("t", 0, 3, "RETRY"), ("t", 1, 5, "RETRY")]
    late = [("t", 0, 3, "SKIPPED"), ("t", 0, 5, "SUCCESS"), ("t", 0, 8, "SUCCESS")]
    stored = acked_ranges(outcomes_of(spark, first), 4)
    assert sorted(tuple(r) for r in stored.collect()) == [("t", 0, 0, 2), ("t", 0, 7, 8)]
    merged = merge_ranges(stored.unionByName(acked_ranges(outcomes_of(spark, late), 4)), 4)
    assert sorted(tuple(r) for r in merged.collect()) == [("t", 0, 0, 3), ("t", 0, 5, 5), ("t", 0, 7, 8)]
    assert [tuple(r) for r in positions(merged).collect()] == [("t", 0, 4, 9, 2)]
    starts = spark.createDataFrame([("t", 0, 0), ("t", 1, 2)], "topic STRING, partition INT, start BIGINT")
    assert sorted(tuple(r)[2:] for r in holes(merged, starts).collect()) == [(0, 4, 4), (1, 6, 6)]


def test_no_partition_in_one_task(spark):
    """The order along a partition sees at most two intervals for each slice."""
    outcomes = spark.range(200_000).selectExpr("'t' AS topic", "0 AS partition", "id AS offset", "IF(id % 2 = 0, 'SUCCESS', 'RETRY') AS result")
    plan = acked_ranges(outcomes, 1000)
    assert plan.count() == 100_000
    edges = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in edges
    # Every other offset: of the 500 intervals in a slice one touches its edge.
    assert merge_ranges(plan, 1000).count() == 100_000


def test_offsets_as_the_source_wants_them(spark):
    ranges = ranges_of(spark, [("t", 0, 3, 9), ("t", 10, 0, 4), ("t", 2, 0, 0), ('q"x', 0, 1, 1)])
    where = json.loads(resume_from(ranges.where("topic = 't'")))
    assert where == {"t": {"0": 10, "2": 1, "10": 5}}
    assert json.loads(resume_from(ranges.where("topic = 't'"), {"t": 4, "new": 2})) == {
        "t": {"0": 10, "1": -2, "2": 1, "3": -2, "10": 5}, "new": {"0": -2, "1": -2},
    }
    assert resume_from(ranges.where("topic = 'none'")) == "earliest"
    assert json.loads(resume_from(ranges.where("topic = 'none'"), {"t": 1})) == {"t": {"0": -2}}
    assert offsets_json(ranges.limit(0), F.col("first")) is None


@pytest.mark.parametrize("reads", [1, 3, 50])
def test_a_replay_reads_exactly_what_is_not_settled(spark, reads):
    rng = random.Random(reads)
    rows = [("t", p, o, rng.choice(["SUCCESS", "SKIPPED", "RETRY"])) for p in range(3) for o in range(400)]
    outcomes = outcomes_of(spark, rows)
    ranges = spark.createDataFrame(acked_ranges(outcomes, 64).collect(), S.RANGES)
    starts = spark.createDataFrame([("t", p, 0) for p in range(3)], "topic STRING, partition INT, start BIGINT")
    windows = replay_windows(ranges, starts, reads).collect()
    assert {w["read"] for w in windows} == set(range(reads)) and len(windows) == 3 * reads
    # What the source returns between the offsets of each read.
    read = [r for w in windows for r in rows if (r[0], r[1]) == (w["topic"], w["partition"]) and w["first"] <= r[2] <= w["last"]]
    assert len(read) == len(set(read))
    got = unsettled(outcomes_of(spark, read), ranges, 64).collect()
    end = {p: max(o for _, q, o, result in rows if q == p and result != "RETRY") for p in range(3)}
    assert sorted(tuple(r) for r in got) == sorted(r for r in rows if r[3] == "RETRY" and r[2] < end[r[1]])


def test_records_met_twice_and_other_columns(spark):
    ranges = ranges_of(spark, [("t", 0, 2, 3)])
    feed = spark.createDataFrame(
        [("t", 0, o, f"v{o}", 1) for o in (1, 2, 3, 4, 4)], "topic STRING, partition INT, offset BIGINT, value STRING, first INT"
    )
    assert sorted(r["value"] for r in unsettled(feed, ranges).collect()) == ["v1", "v4", "v4"]
