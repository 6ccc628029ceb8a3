import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cardweave.llm.kernel import slices, text_buffers
from cardweave.llm.packing import _best_fit, default_ranks, pack_documents, plan_sequences
from cardweave.llm.tokens import ADDED, WIDE_SPACES, WordTokens

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def ids_of(words, texts):
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    out = []
    for a, b in slices(offsets, 4096):
        ids, counts = words.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    return out


def test_ids_equal_those_of_the_tokenizer(reference):
    rng = random.Random(4)
    alphabet = [*"abC19 \t\n\r\x0b\x0c\x1c!.'é日本", *WIDE_SPACES, " ", " ", *ADDED, "<|", "don't"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(3000)]
    texts += ["", " ", "\n\n", "  a", "a  ", "x" * 5000, "ab " * 3000]
    assert ids_of(WordTokens(default_ranks()), texts) == [reference(t) for t in texts]


def test_evicted_words_are_tokenised_again(reference, monkeypatch):
    import cardweave.llm.tokens as tokens

    monkeypatch.setattr(tokens, "_SLOT_BITS", 2)
    monkeypatch.setattr(tokens, "_POOL_IDS", 50)
    texts = [f"word{i % 37} other{i % 11}" for i in range(3000)]
    assert ids_of(tokens.WordTokens(default_ranks()), texts) == [reference(t) for t in texts]


def checked(rows, documents, reference):
    """Every piece of every document is there, with its ids, and lies in a sequence without gap or overlap."""
    expected = []
    for doc_id, text in documents:
        ids = [*reference(text or ""), 2]
        first = len(ids) % 1024 or 1024
        for k, (a, b) in enumerate(itertools.pairwise([0, *range(first, len(ids) + 1, 1024)])):
            expected.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda r: tuple((x is None, x) for x in r)
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=key) == sorted(expected, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return len(sequences)


def test_pack_documents(docs_of, reference):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randint(0, 900))) for _ in range(120)]
    texts += [None, "", "same text", "same text", "long " * 9000]
    rows = [*enumerate(texts), (None, "no id"), (3, texts[3])]
    packed = pack_documents(docs_of(rows)).collect()
    n = checked(packed, rows, reference)
    histogram = np.bincount([r.length for r in packed], minlength=1025)
    assert n <= sum(times for _, times in _best_fit(histogram, 1024)) + 1


def test_only_the_first_piece_is_short(docs_of, reference):
    lengths = (1022, 1023, 1024, 1499, 2047, 2048, 3000)
    rows = [(i, "a" + " a" * (n - 1)) for i, n in enumerate(lengths)]
    packed = pack_documents(docs_of(rows)).collect()
    checked(packed, rows, reference)
    cuts = {}
    for r in sorted(packed, key=lambda r: (r.doc_id, r.piece)):
        cuts.setdefault(r.doc_id, []).append((r.start, r.length))
    assert list(cuts.values()) == [
        [(0, 1023)],
        [(0, 1024)],
        [(0, 1), (1, 1024)],
        [(0, 476), (476, 1024)],
        [(0, 1024), (1024, 1024)],
        [(0, 1), (1, 1024), (1025, 1024)],
        [(0, 953), (953, 1024), (1977, 1024)],
    ]


def test_no_rows_give_no_rows(docs_of):
    assert pack_documents(docs_of([]).limit(0)).collect() == []


def test_other_columns_may_have_any_name(docs_of, reference):
    rows = [(1, "one two"), (2, None)]
    packed = pack_documents(docs_of(rows, ", piece STRING, length STRING, rank STRING, _unit STRING, sequence_id STRING"))
    assert checked(packed.collect(), rows, reference) == 1


@pytest.mark.parametrize("times", [1, 1000])
def test_plan_holds_every_piece_once(times):
    rng = np.random.default_rng(3)
    histogram = np.bincount(rng.integers(1, 1025, 3000), minlength=1025) * times
    plan = plan_sequences(histogram, rounds=150)
    total = int((histogram * np.arange(1025)).sum())
    assert plan.sequences >= -(-total // 1024)
    # The number of rows depends on the lengths, not on the pieces.
    assert len(plan.length) < 12_000
    for length in np.flatnonzero(histogram)[::97]:
        own = plan.length == length
        assert plan.low[own].min() == 0


def test_plan_is_close_to_the_lower_bound():
    # Halves and thirds that fit exactly; best fit alone would also find these.
    histogram = np.zeros(1025, np.int64)
    histogram[[512, 341, 342, 700, 324, 1024]] = [100, 200, 100, 50, 50, 7]
    plan = plan_sequences(histogram, rounds=200)
    assert plan.sequences == 50 + 100 + 50 + 7


def test_empty_histogram():
    assert plan_sequences(np.zeros(1025, np.int64), rounds=5).sequences == 0
