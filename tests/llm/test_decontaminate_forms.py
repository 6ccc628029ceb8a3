"""Copies of benchmark items that the first form alone would miss, and texts that are none."""

import pytest

from cardweave.llm.decontaminate import contaminated
from llm.test_decontaminate import APPLES, PLAIN, TRAIN


@pytest.fixture
def held(spark, docs_of):
    def run(docs, items):
        benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
        rows = contaminated(docs_of(docs), benchmark).collect()
        assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
        return {(r.doc_id, r.item_id): r for r in rows}

    return run


RUSSIAN = "Сколько яблок осталось у мальчика после того как он отдал соседке половину своих яблок"


def test_other_capitals(held):
    items = [(1, APPLES), (2, TRAIN), (3, PLAIN), (4, RUSSIAN)]
    texts = [w(t) for _, t in items for w in (str.upper, str.title, str.lower)]
    got = held([(i, f"some words before {t} and some behind") for i, t in enumerate(texts)], items)
    assert set(got) == {(i, 1 + i // 3) for i in range(12)}
    assert all(r.slots_changed == 0 for r in got.values())


def test_each_window_is_judged_by_the_majority(held):
    items = [
        (1, "Anna Lee has 12 red apples in the cellar and 5 green ones in the attic. On the next day Anna Lee goes home"),
        (2, "A baker takes 3 loaves from the oven in the morning and then 5 loaves from the shelf in the evening"),
        (3, "the pump fills a small basin in 2 hours and a large basin in 4 hours when both valves are open"),
        (4, "every box in the store holds 12 pens and every bag on the table holds 12 coins for the next buyer"),
    ]
    docs = [
        (1, f"We wrote to Professor {items[0][1]} Today and so on"),
        (2, items[1][1].replace("3", "7").replace("5", "7")),
        (3, items[2][1].replace("2 hours", "1 hour").replace("4", "6")),
        (4, items[3][1].replace("12 coins", "13 coins")),
        # The same shape, but what stands for one value is another each time.
        (5, "A train travels 100 km in 5 hours and then stops for 6 days before it goes on to Paris."),
    ]
    got = held(docs, [*items, (5, TRAIN)])
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4)}
    assert [got[i, i].slots_changed for i in (1, 2, 4)] == [0, 2, 0]
    assert got[1, 1].windows_found == got[1, 1].item_windows


def test_exchanged_names_that_open_sentences(held):
    items = [
        (1, "Tom has 3 apples. Tom buys 5 more apples. How many apples does Tom have?"),
        (2, "Janet sells 16 eggs per day. Janet eats 3 eggs. Janet bakes 4 cakes with what is left. How many eggs does Janet use?"),
        (3, "Вчера утром Иван купил в магазине 3 яблока а потом Иван отдал соседке 2 яблока и пошёл домой"),
        (4, "το πρωί ο Νίκος πήρε 3 μήλα και το βράδυ ο Νίκος έφαγε 2 μήλα πριν από τον ύπνο"),
    ]
    changed = [
        items[0][1].replace("Tom", "Anna").replace("3", "8").replace("5", "6"),
        items[1][1].replace("Janet", "Maria").replace("16", "40"),
        items[2][1].replace("Иван", "Пётр").replace("3", "7"),
        items[3][1].replace("Νίκος", "Γιώργος").replace("3", "7"),
    ]
    got = held([(i, f"some words before. {t} And some behind") for i, t in enumerate(changed, 1)], items)
    assert {k: r.slots_changed for k, r in got.items()} == {(1, 1): 3, (2, 2): 2, (3, 3): 2, (4, 4): 2}


def test_a_verbatim_run_is_enough(held):
    words = (
        "a farmer keeps brown hens in a wooden house behind the old mill and every morning before sunrise the youngest "
        "daughter walks down the narrow path with 2 baskets to gather what was laid overnight by them all"
    ).split()
    item = " ".join(words)
    docs = [
        (1, f"it says {' '.join(words[5:18])} and so on"),
        (2, f"it says {' '.join(words[5:17])} and so on"),
        (3, f"it says {' '.join(words[15:28])} and so on"),
        # The number differs, so no 13 tokens are unchanged.
        (4, f"it says {' '.join(words[17:31])} and so on".replace("2 baskets", "3 baskets")),
        (5, f"it says {' '.join(words[12:22])} and {' '.join(words[:10])} and so on"),
    ]
    assert set(held(docs, [(1, item)])) == {(1, 1), (3, 1)}


def test_number_heavy_short_and_unspaced_items(held):
    items = [
        (1, "What is 12 * 34 + 5?"),
        (2, "2 + 2 * 7 = 16 or 28?"),
        (3, "What is the capital of France?"),
        (4, "Who wrote Faust?"),
        (5, "法国的首都是哪一座城市，请回答。"),
        (6, "日本で一番高い山は何ですか"),
        # One window of nine is mostly words.
        (7, "Add up the numbers in this list for me: 3 9 27 81 4 16 64 5"),
    ]
    docs = [(i, f"they asked me {t} and went on") for i, t in items]
    docs += [
        (11, "they asked me What is 12 * 34 + 6? and went on"),
        (12, "他说法国的首都是巴黎"),
        (13, f"有人问{items[4][1]}然后走了"),
        (14, "please add up the numbers in this list for me"),
        (15, "who wrote that faust was old"),
    ]
    assert set(held(docs, items)) == {(i, i) for i, _ in items} | {(13, 5)}


def test_left_out_windows_count(held):
    item = "the sum of all the numbers shown here 1 2 3 4 5 6 7 8 9 10 11 12 13"
    clean = "the sum of all the numbers shown here 5 9 is a clean text"
    got = held([(1, f"so {item} they say"), (2, clean)], [(1, item)])
    assert set(got) == {(1, 1)}
    assert got[1, 1].item_windows == got[1, 1].windows_found == 14
