import pytest

from cardweave.operators.ledger import at_risk, offset_ledger
from cardweave.streaming.run import merge_ledger

SCHEMA = "topic STRING, partition INT, offset BIGINT, transaction_id STRING, result STRING, reason STRING, attempts INT"


@pytest.fixture
def outcomes_of(spark):
    def build(results, partition=0, start=0):
        rows = [("t", partition, start + i, f"x{i}", r, r.lower(), 1) for i, r in enumerate(results)]
        return spark.createDataFrame(rows, SCHEMA)

    return build


def positions(df):
    return [(r["committed"], r["first_unacked"], r["safe_position"]) for r in df.orderBy("partition").collect()]


@pytest.mark.parametrize(
    "results, expected",
    [
        (["SUCCESS"], (1, None, 1)),
        (["SKIPPED"], (1, None, 1)),
        (["RETRY"], (0, 0, 0)),
        (["SUCCESS", "RETRY", "SKIPPED", "SUCCESS", "RETRY"], (4, 1, 1)),
        (["SUCCESS", "RETRY"], (1, 1, 1)),
    ],
)
def test_positions(outcomes_of, results, expected):
    assert positions(offset_ledger(outcomes_of(results))) == [expected]


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_at_risk(outcomes_of, broadcast_bytes):
    outcomes = outcomes_of(["RETRY", "SUCCESS", "RETRY", "RETRY", "SKIPPED", "RETRY"]).unionByName(
        outcomes_of(["RETRY", "RETRY"], partition=1)
    )
    risk = at_risk(outcomes, broadcast_bytes=broadcast_bytes)
    assert sorted((r["partition"], r["offset"]) for r in risk.collect()) == [(0, 0), (0, 2), (0, 3)]


def test_merged_ledger_equals_the_ledger_of_the_final_outcomes(outcomes_of):
    first = outcomes_of(["RETRY", "SUCCESS", "RETRY"])
    # The next batch settles both open records again: one succeeds.
    second = outcomes_of(["SUCCESS"]).unionByName(outcomes_of(["RETRY", "SKIPPED"], start=2)).unionByName(
        outcomes_of(["SUCCESS"], partition=1)
    )
    ledger = merge_ledger(merge_ledger(None, first), second)
    assert positions(ledger) == [(4, 2, 2), (1, None, 1)]
    # A batch that brings nothing for a partition keeps its position.
    assert positions(merge_ledger(ledger, outcomes_of(["SUCCESS"], partition=1, start=1))) == [(4, None, 4), (2, None, 2)]
