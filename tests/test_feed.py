import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cardweave.plans import feed


@pytest.fixture
def orders(tmp_path):
    """A table of one row group, which no split can divide."""
    n = 4000
    day = np.datetime64("1998-01-01T00:00:00", "us")
    columns = {
        "o_orderkey": pa.array(np.arange(n)),
        "o_custkey": pa.array(np.arange(n) % 50),
        "o_totalprice": pa.array(np.arange(n) / 7),
        "o_orderstatus": pa.array(["F", "O"] * (n // 2)),
        "o_orderdate": pa.array(np.full(n, day)),
    }
    pq.write_table(pa.table(columns), tmp_path / "orders.parquet", row_group_size=n)
    return str(tmp_path)


def test_no_task_has_many_more_rows_than_its_share(spark, orders, monkeypatch):
    monkeypatch.setattr(feed, "ROWS_PER_TASK", 100)
    whole = feed.order_feed(spark, orders)
    sizes = [r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 40 and max(sizes) <= 150


def test_damaged_messages(spark, orders):
    """The rules in the order they are tried: no end, an end with more behind, nothing, blanks."""
    def expected(value, k):
        if k % 29 == 0:
            return value.startswith("<Data>") and value.endswith("</Timestamp>")
        if k % 31 == 0:
            return value.endswith("</Data>junk")
        if k % 37 == 0:
            return value is None
        return value == "   " if k % 41 == 0 else value.endswith("</Timestamp></Data>")

    rows = feed.order_feed(spark, orders).select("key", "value").collect()
    assert all(expected(r["value"], int(r["key"].removeprefix("order-"))) for r in rows)
