import random
import re

import pytest

import cardweave.llm.minhash as minhash
from cardweave.llm.components import connected
from cardweave.llm.minhash import near_duplicates


def shingles(text, words):
    own = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    size = min(words, len(own))
    return frozenset(tuple(own[k : k + size]) for k in range(len(own) - size + 1)) if own else frozenset()


def brute(rows, words, percent=80):
    """Component of every doc_id by comparing all pairs; rows with the same doc_id are one document."""
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t, words)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.randint(0, 10**6)}" for w in words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(800)]
    rows = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(30, 200))
        rows += [edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06, 0.1, 0.2])) for _ in range(rng.randint(1, 25))]
    rows += [None, "", " \n\t", "one", "ONE", "two words", "Two\tWORDS", "two words x", "long " * 30_000, "long " * 29_999]
    rng.shuffle(rows)
    rows = [(k * 3 + 1, t) for k, t in enumerate(rows)]
    return [*rows, (rows[5][0], rows[5][1]), (None, rows[0][1]), (None, None)]


@pytest.mark.parametrize("words", [2, 5])
def test_against_all_pairs(docs_of, corpus, words):
    expected = brute(corpus, words)
    got = near_duplicates(docs_of(corpus), words=words).collect()
    assert len(got) == len(corpus)
    by_row = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got)
    assert by_row == sorted((i is None, i or 0, len(shingles(t, words))) for i, t in corpus)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else expected[r.doc_id])
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_small_blocks_lose_no_link(docs_of, corpus, monkeypatch):
    """Copies at the edge of the similarity need the comparison in blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, edited(rng, base, 0.055)) for i in range(60)]
    expected = brute(rows, 2)
    assert 1 < len(set(expected.values())) < 60
    got = {r.doc_id: r.component_id for r in near_duplicates(docs_of(rows), words=2).collect()}
    assert got == expected


def test_empty_and_clashing(docs_of):
    assert near_duplicates(docs_of([]).limit(0)).collect() == []
    assert [r.kept for r in near_duplicates(docs_of([(1, None)])).collect()] == [True]
    clash = docs_of([(1, "a b c d e f"), (2, "a b c d e f")], ", id STRING, pivot STRING, n_shingles STRING, kept STRING")
    assert sorted((r.doc_id, r.component_id) for r in near_duplicates(clash).collect()) == [(1, 1), (2, 1)]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200), (201, 202)]
    edges = [tuple(rng.sample(e, 2)) if e[0] != e[1] else e for e in edges]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert {n for n, c in got.items() if c == 0} == set(range(41))
    assert {n for n, c in got.items() if c == 100} == set(range(100, 130))
    assert {n for n, c in got.items() if c == 200} == {200, 201, 202}
    assert connected(spark.createDataFrame([], "a BIGINT, b BIGINT")).collect() == []
