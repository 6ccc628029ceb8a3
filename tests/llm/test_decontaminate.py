import os

import pytest

import cardweave.llm.decontaminate as module
from cardweave.llm.decontaminate import contaminated, decontaminate

APPLES = "Tom Smith has 12 apples and gives 5 apples to Anna. How many apples does Tom Smith have left after 3 days?"
TRAIN = "A train travels 60 km in 2 hours and then stops for 2 hours before it goes on to Berlin."
PLAIN = "the quick brown fox jumps over the lazy dog while seven sleepy cats watch from a warm wall"


@pytest.fixture
def found(spark, docs_of):
    def run(docs, items, more=""):
        benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
        rows = contaminated(docs_of(docs, more), benchmark).collect()
        assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
        return {(r.doc_id, r.item_id): r.slots_changed for r in rows}

    return run


ITEMS = [(1, APPLES), (2, TRAIN), (3, PLAIN), (4, None), (5, ""), (6, "too short"), (None, PLAIN), (7, "1 2 3 4 5 6 7 8 9 10")]


def test_exact_and_changed(found):
    docs = [
        (1, f"before it. {APPLES} and after"),
        (2, "we say that Peter Jones has 30 apples and gives 7 apples to Mary. How many apples does Peter Jones have left after 9 days?"),
        # 2 hours became 5 hours and 6 days: no one-to-one change.
        (3, "then a train travels 100 km in 5 hours and then stops for 6 days before it goes on to Paris."),
        (4, "then a train travels 1,000.5 miles in 5 hours and then stops for 5 hours before it goes on to New York."),
        (5, PLAIN.upper()),
        (6, "so " + PLAIN.replace("fox", "cat").replace("seven", "eight")),
        (7, " ".join(PLAIN.split()[:9])),
        (8, PLAIN.replace(" ", ",\n")),
        (9, None), (10, ""), (11, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (12, "word " * 40_000 + PLAIN + " word" * 40_000),
        (None, PLAIN), (13, "nothing of the kind at all, just a text about trains that travel for many hours"),
        (8, "another text of the same document"),
    ]
    got = found(docs, ITEMS)
    # 7 holds too little of the item.
    assert set(got) == {(1, 1), (2, 1), (4, 2), (5, 3), (8, 3), (12, 3)}
    assert got[1, 1] == 0 and got[8, 3] == 0 and got[12, 3] == 0
    assert got[2, 1] >= 5 and got[4, 2] >= 3


def test_repeated_rows_and_ids(found):
    assert found([(1, PLAIN), (1, PLAIN), (2, f"{PLAIN}. {PLAIN}")], [(3, PLAIN), (3, PLAIN)]) == {(1, 3): 0, (2, 3): 0}


def test_empty_tables_and_clashing_columns(found, spark):
    assert found([], ITEMS) == {}
    assert found([(1, PLAIN)], []) == {}
    assert found([(1, PLAIN)], ITEMS, ", item_id STRING, key STRING, hash STRING, slots STRING, size STRING") == {(1, 3): 0}


def test_a_full_filter_changes_nothing(found, monkeypatch):
    monkeypatch.setattr(module, "LEAST_BITS", 8)
    monkeypatch.setattr(module, "MOST_BITS", 8)
    assert found([(1, PLAIN), (2, "entirely different words in this one, none of which the benchmark knows")], ITEMS) == {(1, 3): 0}


def test_rows_without_an_id_stay(spark, docs_of):
    benchmark = spark.createDataFrame([(3, PLAIN)], "item_id BIGINT, text STRING")
    docs = docs_of([(1, PLAIN), (None, PLAIN), (2, "clean")])
    left = decontaminate(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted((r.doc_id is None, r.text) for r in left.collect()) == [(False, "clean"), (True, PLAIN)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the driver's tables are not here")
def test_planted_passages_against_plain_search(spark):
    import re

    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    texts = [(r.doc_id, words(r.text)) for r in docs.collect()]
    expected = {(i, r.item_id) for r in items.collect() for i, t in texts if words(r.text) in t}
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()} == expected
    assert expected
