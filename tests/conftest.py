import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cardweave import schemas as S  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def feed_of(spark):
    """Feed with one record per value, offsets from 0, partition 0."""

    def build(values, partition=0):
        rows = [(None, value, "t", partition, i) for i, value in enumerate(values)]
        return spark.createDataFrame(rows, S.FEED)

    return build


SAMPLE = """<Data>
  <Timestamp>2031-07-04T18:05:09.25</Timestamp>
  <CurrencyCode>EUR</CurrencyCode>
  <Amount>7480.06</Amount>
  <TransactionId>case-7/0042</TransactionId>
  <DigitalPan>5555555555554444</DigitalPan>
  <ResponseCode>91</ResponseCode>
  <RecordType>PTLFX</RecordType>
  <MessageType>TCN</MessageType>
</Data>
"""


def fragment(**fields):
    """The sample with fields replaced, or left out where the value is None."""
    values = {
        "MessageType": "TVN",
        "RecordType": "PTLFX",
        "TransactionId": "TXN-1",
        "DigitalPan": "5500000000000004",
        "Amount": "86.20",
        "CurrencyCode": "CHF",
        "ResponseCode": "01",
        "Timestamp": "2029-11-30T07:41:00",
        **fields,
    }
    return "<Data>" + "".join(f"<{n}>{v}</{n}>" for n, v in values.items() if v is not None) + "</Data>"


@pytest.fixture
def column_of(spark):
    """Apply a column function to a list of texts; results in the same order."""

    def apply(function, values):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), "i INT, v STRING").coalesce(1)
        rows = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
        return [row["r"] for row in rows]

    return apply
