import pytest
from pyspark.sql import functions as F

from cardweave.operators.filters import all_of, filter_publishable, is_actionable, is_ptlfx


@pytest.fixture
def kinds(spark):
    rows = [(r, m) for r in ("PTLFX", "OTHER", None) for m in ("TVN", "TCN", "ACN", "TAR", "UNKNOWN", None)]
    return spark.createDataFrame(rows, "record_type STRING, message_type STRING")


def kept(df):
    return sorted(tuple(r) for r in df.collect())


def test_publishable(kinds):
    assert kept(filter_publishable(kinds)) == [("PTLFX", "ACN"), ("PTLFX", "TCN"), ("PTLFX", "TVN")]


def test_further_predicates(kinds):
    only_tvn = F.col("message_type") == "TVN"
    assert kept(filter_publishable(kinds, [only_tvn])) == [("PTLFX", "TVN")]
    assert kept(filter_publishable(kinds, None)) == []


def test_predicates_are_never_null(kinds):
    rows = kinds.select("record_type", "message_type", is_ptlfx().alias("p"), is_actionable().alias("a")).collect()
    for r in rows:
        assert r["p"] is (r["record_type"] == "PTLFX")
        assert r["a"] is (r["message_type"] in ("TVN", "TCN", "ACN"))


@pytest.mark.parametrize(
    "tests, expected",
    [
        (None, False),
        ([], True),
        (["missing"], False),
        ([True, "missing"], False),
        ([None], False),
        ([True, True], True),
        ([True, False], False),
        ([False, True], False),
    ],
)
def test_all_of(spark, tests, expected):
    predicates = tests and [None if t == "missing" else F.lit(t).cast("boolean") for t in tests]
    assert spark.range(1).select(all_of(predicates)).first()[0] is expected
