import random
import re
from collections import Counter

import numpy as np
import pytest

from cardweave.llm.divergence import divergence, shares, source_divergence
from cardweave.llm.transducer import Transducer, build

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=10, top=10):
    docs = [((lang or ""), (source or ""), TERM.findall((text or "").translate(FOLD))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, words in own for t in set(words))
        kept = sorted((t for t in seen if seen[t] >= least), key=str.encode)
        sources = sorted({d[1] for d in own}, key=str.encode)
        count = {s: Counter(t for _, o, words in own if o == s for t in words if seen[t] >= least) for s in sources}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        q = share(sum(count.values(), Counter()))
        p = {s: share(count[s]) for s in sources}
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if count[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o.decode(), -v, r) for r, (v, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t.decode(), -v, r) for r, (v, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang STRING, source STRING, text STRING").repartition(3)


def result(df, **options):
    return sorted(tuple(r) for r in source_divergence(df, **options).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["alpha", "Beta", "BETA", "été", "ÉTÉ", "日本語", "a", "ab", "abc", "x" * 300, "abcdefgh", "abcdefghi", "abcdefghij", "zz"]
    words += ["".join(rng.choices("abcde", k=rng.randint(1, 4))) for _ in range(60)]
    out = []
    for _ in range(260):
        # A third of all rows are of one source.
        lang, source = rng.choice([("en", "big"), ("en", rng.choice(["s1", "s2", "s3", "é"])), (rng.choice(["fr", None, ""]), rng.choice(["s1", None, "b"]))])
        text = rng.choice([" ", "\n", "-", "3", "_", "\x7f"]).join(rng.choices(words, k=rng.randint(0, 25)))
        out.append((lang, source, text))
    out += [("en", "none", None), ("en", "digits", "1 2 3"), ("xx", "only", "a b"), ("yy", "s", ""), ("yy", "t", None), ("yy", "u", "w")]
    out += [("en", "long", "alpha beta " * 60_000 + "y" * 100_000)] + [out[0]] * 15
    return out


@pytest.mark.parametrize(
    "bounds",
    [{}, {"part_bytes": 40, "held_bytes": 900, "cells": 30, "pairs": 12}, {"part_bytes": 1, "held_bytes": 1, "cells": 1, "pairs": 1}],
)
def test_against_brute_force(spark, rows, bounds):
    if bounds.get("part_bytes") == 1:  # a transducer, a pass and a block for every term
        rows = [(lang, s, " ".join(t for t in (text or "").split() if len(t) < 3)) for lang, s, text in rows[:120]]
    assert result(frame(spark, rows), **bounds) == brute(rows)


def test_small_batches_pass_counts_on(spark, rows, monkeypatch):
    import cardweave.llm.divergence as module

    monkeypatch.setattr(module, "_ENTRIES", 5)
    assert result(frame(spark, rows)) == brute(rows)


def test_ties_go_by_term(spark):
    rows = [("en", "a", "b1a1c1é1d")] * 10 + [("en", "z", "q")] * 10
    got = [r for r in result(frame(spark, rows)) if r[1:3] == ("a", "term")]
    assert [r[3] for r in sorted(got, key=lambda r: r[5])] == ["a", "b", "c", "d", "é"]


def test_no_rows_and_clashing_columns(spark):
    assert result(frame(spark, [])) == []
    rows = [("en", "a", "x y")] * 10 + [("en", "b", "x")] * 3
    clash = frame(spark, rows).selectExpr("*", "1 AS term", "2 AS n", "3 AS ordinal", "4 AS total", "5 AS item", "6 AS rank")
    assert result(clash) == brute(rows)


def test_shares_are_exact_for_large_counts():
    counts = np.array([[10**13, 0, 7]])
    total = 10**13 + 7
    assert shares(counts, np.array([total]), 3).tolist() == [[1 + (int(c) + 2) * 10**9 // (total + 6) for c in counts[0]]]
    p, q = np.array([10**9 + 1]), np.array([1])
    assert divergence(p, q).tolist() == [(10**9) ** 2 // (10**9 + 2)]


def test_transducer_numbers_terms_and_finds_them_again():
    rng = random.Random(9)
    for n, alphabet in [(1, b"a"), (40, b"ab"), (3000, b"abcdefxyz\x80\xff\xc3"), (500, bytes(range(256)))]:
        terms = sorted({bytes(rng.choices(alphabet, k=rng.randint(1, 12))) for _ in range(n)})
        transducer = Transducer(build(terms))
        others = [t + b"a" for t in terms] + [t[:-1] for t in terms] + [b"", b"zz"]
        words = terms + others
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        starts = ends - [len(w) for w in words]
        number = {t: i for i, t in enumerate(terms)}
        assert transducer.ordinals(data, starts, ends).tolist() == [number.get(w, -1) for w in words]
        assert [transducer.term(i) for i in range(len(terms))] == terms


def test_transducer_is_minimal():
    # Common beginnings and endings are shared: 26 letters twice, one middle state, one end, one start.
    terms = sorted(bytes([a, 109, b]) for a in range(97, 123) for b in range(97, 123))
    states, arcs = np.frombuffer(build(terms), "<u8", 2).tolist()
    assert (states, arcs) == (4, 26 + 1 + 26)


def test_transducer_wants_ascending_terms():
    for terms in ([b"b", b"a"], [b"a", b"a"]):
        with pytest.raises(ValueError):
            build(terms)
