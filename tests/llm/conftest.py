"""Fixtures of the tests of the training-data operators."""

import pytest

TABLES = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """documents from texts, or from (doc_id, text) pairs, with the other columns of the table."""

    def build(rows, more=""):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT" + more
        extra = (None,) * (schema.count(",") - 1)
        return spark.createDataFrame([(*r, *extra) for r in rows], schema).repartition(3)

    return build
