import hashlib
import random

import numpy as np
import pytest

import cardweave.llm.repeats as repeats
from cardweave.llm.repeats import interval_tree, maximal_repeats, repeat_groups, repeats_digest, suffix_order


def brute(rows, width=50):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        if i is not None:
            for k in range(len(data) - width + 1):
                w = data[k : k + width]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        if i is not None:
            for k in range(len(data) - width + 1):
                if first[data[k : k + width]] < i:
                    gone[k : k + width] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((i is None, i or 0, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def digests(df):
    rows = repeats_digest(df).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randint(2, 8)))
    passages = [" ".join(word() for _ in range(rng.randint(8, 60))) for _ in range(10)]
    texts = []
    for _ in range(80):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(20)) for _ in range(4)]
        text = " ".join(parts)
        texts.append(text[rng.randint(0, 60) : len(text) - rng.randint(0, 60)])
    texts += [None, "", "x" * 49, "x" * 49, "y" * 50, "y" * 50, "y" * 300, "ab" * 100, "ab" * 120, "é" * 40, "日本" * 30, "日本" * 31]
    texts += ["n" + "u" * 30 + "\0" * 40, "m" + "u" * 30 + "\0" * 40, "u" * 30 + "\0" * 20]
    rng.shuffle(texts)
    rows = [(k * 2, t) for k, t in enumerate(texts)]
    return [*rows, (rows[3][0], rows[3][1]), (None, passages[0]), (None, passages[0])]


def test_against_brute_force(docs_of, corpus):
    assert digests(docs_of(corpus)) == brute(corpus)


def test_small_chunks_pieces_and_hot_anchors(docs_of, corpus, monkeypatch):
    """Documents in many chunks, texts cut into pieces, and every anchor split into windows."""
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 300)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 128)
    monkeypatch.setattr(repeats, "HOT_CHUNKS", 1)
    monkeypatch.setattr(repeats, "GROUP_BYTES", 1000)
    assert digests(docs_of(corpus)) == brute(corpus)


def test_a_long_text(docs_of):
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefgh \n", k=2_300_000))
    rows = [(1, text), (2, "z" * 70 + text[1_048_500:1_049_000] + "z" * 70), (3, text[-400:])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats_digest(docs_of(rows)).collect()}
    assert got[1] == (0, 0) and got[3] == (400, 1) and got[2][0] in range(500, 505)


def test_empty_and_clashing(docs_of):
    assert repeats_digest(docs_of([]).limit(0)).collect() == []
    clash = docs_of([(1, "q" * 60), (2, "q" * 60)], ", chunk STRING, ids STRING, spans STRING, kept STRING, n_bytes STRING")
    assert sorted((r.doc_id, r.n_removed) for r in repeats_digest(clash).collect()) == [(1, 0), (2, 60)]


def test_suffix_order():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 3, 400).astype(np.uint8)
    start = np.arange(400)
    end = np.minimum((start // 100 + 1) * 100, 400)
    order, common = suffix_order(data, start, end)
    suffixes = [data[a:b].tobytes() for a, b in zip(start[order], end[order])]
    assert suffixes == sorted(suffixes)
    for k in range(1, 400):
        a, b = suffixes[k - 1], suffixes[k]
        assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_interval_tree():
    assert sorted(zip(*interval_tree([0, 3, 5, 5, 3, 1, 4], 2))) == [(0, 4, 3), (1, 3, 5), (5, 6, 4)]
    assert interval_tree([0], 1) == ([], [], [])


def test_maximal_repeats_are_groups_with_all_occurrences():
    texts = [b"xABCDEFy", b"zABCDEFw", b"ABCDqABCD", b"EFEF"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    length = np.array([len(t) for t in texts])
    group, at, size = maximal_repeats(data, np.cumsum(length) - length, length, 3)
    whole = data.tobytes()
    found = {}
    for g, a, n in zip(group, at, size):
        found.setdefault(g, set()).add((whole[a : a + n], int(a)))
    strings = {next(iter(v))[0]: len(v) for v in found.values()}
    # ABCD stands four times, ABCDEF twice; BCD is always inside ABCD and is no group.
    assert strings == {b"ABCD": 4, b"ABCDEF": 2}


def test_groups_list_all_occurrences(docs_of, corpus):
    rows = [(i, t) for i, t in dict((i, t) for i, t in corpus if i is not None).items()]
    texts = {i: (t or "").encode() for i, t in rows}
    groups = {}
    for r in repeat_groups(docs_of(rows)).collect():
        groups.setdefault((r.group, r.length), set()).add((r.doc_id, r.start))
    assert len(groups) > 50
    windows = {}
    for i, data in texts.items():
        for k in range(len(data) - 49):
            windows.setdefault(data[k : k + 50], set()).add((i, k))
    covered = set()
    for (_, length), places in groups.items():
        strings = {texts[i][a : a + length] for i, a in places}
        assert len(strings) == 1 and length >= 50 and len(next(iter(strings))) == length and len(places) > 1
        string = next(iter(strings))
        everywhere = {(i, k) for i, k in windows[string[:50]] if texts[i][k : k + length] == string}
        assert places == everywhere
        covered |= {(i, b) for i, a in places for b in range(a, a + length)}
    shared = {(i, b) for p in windows.values() if len({i for i, _ in p}) > 1 for i, k in p for b in range(k, k + 50)}
    assert shared <= covered
