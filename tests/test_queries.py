"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from cardweave.plans.oracles import ORACLES
from cardweave.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == expected
    assert expected


def test_entry(spark):
    assert entry.entry(spark).count() == 1500


SF_COUNTS = "/root/testdata/sf0.01"


def test_counts_known_beforehand(spark):
    """Totals that were worked out before any of this was written."""
    queries = entry.queries()
    local = {r["reason"]: r for r in queries["process_local"](spark, SF_COUNTS).collect()}
    assert {reason: r["records"] for reason, r in local.items()} == {
        "MALFORMED": 1697, "NOT_PTLFX": 2658, "NOT_ACTIONABLE": 4565, "OK": 6080,
    }
    assert (local["OK"]["amount"], local["OK"]["timestamps"], local["OK"]["tokens"]) == (1365753298.73, 5816, 1452)
    results = queries["process_outcomes"](spark, SF_COUNTS).groupBy("result").count().collect()
    assert {r["result"]: r["count"] for r in results} == {"SKIPPED": 8920, "RETRY": 1569, "SUCCESS": 4511}
    ledger = sorted(queries["offset_ledger"](spark, SF_COUNTS).collect(), key=lambda r: r["partition"])
    assert [(r["committed"], r["first_unacked"]) for r in ledger] == [(3750, 11), (3750, 19), (3750, 0), (3750, 2)]
    assert queries["at_risk"](spark, SF_COUNTS).count() == 1569
    assert queries["call_health"](spark, SF_COUNTS).filter("flagged").count() == 334
