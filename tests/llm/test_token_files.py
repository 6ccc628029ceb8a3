import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cardweave.llm import token_files, wavelet
from cardweave.llm.kernel import slices, text_buffers
from cardweave.llm.token_files import (
    FileTokens,
    default_vocabulary,
    read_documents,
    token_counts,
    token_places,
    tokens_digest,
    write_tokens,
)
from cardweave.llm.tokens import ADDED, WIDE_SPACES
from cardweave.llm.wavelet import WaveletFile, pack_file
from cardweave.storage import fresh_path, stage

pytest.importorskip("public_tokenizers")


def directory(*sizes):
    return pa.record_batch([pa.array(range(len(sizes)), pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"])


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_vocabulary())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("block_bits", [64, 1 << 16])
def test_file_answers_like_the_plain_sequence(monkeypatch, block_bits):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", block_bits)
    monkeypatch.setattr(wavelet, "_BLOCK_BYTES", block_bits // 8)
    rng = np.random.default_rng(1)
    for bits, n in [(1, 1), (3, 5), (16, 1000), (16, 64), (16, 65), (17, 700), (4, 0)]:
        ids = rng.integers(0, min(1 << bits, 50), n).astype(np.uint16 if bits <= 16 else np.uint32)
        ids[n // 2 :: 3] = (1 << bits) - 1
        file = WaveletFile.of(pack_file(ids, bits, directory(n)))
        assert file.ids().tolist() == ids.tolist()
        assert [file.token(i) for i in range(0, n, 7)] == ids[::7].tolist()
        for token in {*ids[:9].tolist(), (1 << bits) - 1, 0, 1 << bits, -1}:
            places = np.flatnonzero(ids == token).tolist()
            assert file.count(token) == len(places) and file.occurrences(token).tolist() == places
            assert file.occurrences(token, 1, 3).tolist() == places[1:3]
            for a, b in [(0, n // 2), (n // 3, n), (n // 3, n // 2)]:
                assert file.count(token, a, b) == sum(a <= p < b for p in places)
        with pytest.raises(IndexError):
            file.token(n)
        assert file.documents().to_pydict() == {"doc_id": [0], "n_tokens": [n]}


def test_a_question_reads_a_part_of_the_file():
    ids = np.random.default_rng(2).integers(0, 50257, 1 << 20).astype(np.uint16)
    content, read = pack_file(ids, 16, directory(1 << 20)), []

    def piece(at, size):
        read.append(size)
        return content[at : at + size]

    file = WaveletFile(piece)
    assert file.token(777_777) == ids[777_777] and file.count(int(ids[5])) == (ids == ids[5]).sum()
    assert sum(read) < len(content) / 4


def test_runs_are_compressed():
    ids = np.repeat(np.arange(64, dtype=np.uint16), 20_000)
    assert len(pack_file(ids, 16, directory(len(ids)))) < len(ids) * 2 / 50


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        WaveletFile.of(b"x" * 100)


def test_ids_are_those_of_the_library(library):
    rng = random.Random(4)
    alphabet = [*"abC19 \t\n\r\x0b\x0c\x1c!.'é日本", *WIDE_SPACES, " ", " ", *ADDED, "<|", "don't", "\U0001f600"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(3000)]
    texts += ["", " ", "\n\n", "  a", "a  ", "x" * 5000, "ab " * 3000]
    words, got = FileTokens(default_vocabulary()), []
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    for a, b in slices(offsets, 4096):
        ids, counts = words.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        got += [[*x.tolist(), 2] for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [library(t) for t in texts]


def encoded(words, texts):
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    ids, counts = words.encode(data, offsets)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("call_bytes", [1, 16, 1 << 20])
def test_cuts_between_kinds_leave_the_ids(monkeypatch, library, call_bytes):
    """Words of mixed kinds, contractions, bars and white space of all sorts, in calls of all sizes."""
    monkeypatch.setattr(token_files, "_CALL_BYTES", call_bytes)
    rng = random.Random(6)
    alphabet = [*"abstmdLR09 .,'’|<>_-\n\t\x00\x1f\x7fé٣½", "'re", "'ll", "'s", " '", "e\u0301", "—", *WIDE_SPACES, *ADDED]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 25))) for _ in range(1500)]
    words = FileTokens(default_vocabulary())
    assert [[*x, 2] for x in encoded(words, texts)] == [library(t) for t in texts]
    assert [[*x, 2] for x in encoded(words, texts[::-1])] == [library(t) for t in texts[::-1]]


def test_the_tokenizer_meets_a_run_once(monkeypatch, library):
    """However often a run comes back in new words: beside other marks and numbers, or when the words were forgotten."""
    words, asked = FileTokens(default_vocabulary()), []
    part = getattr(words, "runs", words)
    plain = part._ids
    monkeypatch.setattr(part, "_ids", lambda raw: asked.append(raw) or plain(raw))
    texts = [f"see {a}alphabet{b}{n} there" for a in ["", "(", "-"] for b in ["", ",", ".", ";", ")."] for n in ["", "1", "77"]]
    assert [[*x, 2] for x in encoded(words, texts)] == [library(t) for t in texts]
    # With and without a space before it.
    assert b"".join(asked).count(b"alphabet") == 2
    words._reset()
    asked.clear()
    assert [[*x, 2] for x in encoded(words, texts)] == [library(t) for t in texts] and not asked


@pytest.mark.parametrize("step", [8, 64, 1 << 16])
def test_planes_in_steps(monkeypatch, step):
    """Planes of a plain stable parting, and the way back, in steps of any size; the ids given stay as they are."""
    monkeypatch.setattr(wavelet, "_STEP", step)
    rng = np.random.default_rng(3)
    for n, bits in [(0, 3), (1, 1), (7, 4), (64, 16), (65, 17), (1001, 16)]:
        ids = rng.integers(0, 1 << bits, n).astype(np.uint16 if bits <= 16 else np.uint32)
        ids.flags.writeable = False
        level = ids.tolist()
        for bit, plane in zip(range(bits - 1, -1, -1), wavelet.planes_of(ids, bits), strict=True):
            assert np.unpackbits(plane, count=n).tolist() == [x >> bit & 1 for x in level]
            level = sorted(level, key=lambda x: x >> bit & 1)  # noqa: B023
        assert WaveletFile.of(pack_file(ids, bits, directory(n))).ids().tolist() == ids.tolist()


def test_older_files_are_read(monkeypatch):
    """Their blocks are compressed by zlib, and their header names no codec."""

    class Zlib:
        def __init__(self, name):
            pass

        def compress(self, block, asbytes):
            return zlib.compress(block, 1)

    ids = np.repeat(np.arange(64, dtype=np.uint16), 3000)
    with monkeypatch.context() as patch:
        patch.setattr(wavelet.pa, "Codec", Zlib)
        content = pack_file(ids, 16, directory(len(ids)))
    length = int.from_bytes(content[8:16], "little")
    head = content[16 : 16 + length].replace(b'"codec": "zstd", ', b"")
    old = content[:8] + len(head).to_bytes(8, "little") + head + content[16 + length :]
    file = WaveletFile.of(old)
    assert file.ids().tolist() == ids.tolist() and file.token(5000) == ids[5000]


def brute(rows, library):
    at, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library(text)
        out.append((str(i), at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["alpha", "beta", "Gamma", "日本", "x1"], k=rng.randint(0, 30))) for _ in range(150)]
    return [*zip(rng.sample(range(-50, 500), 150), texts), (1000, None), (1001, ""), (None, "no id"), (1002, "long text, " * 30_000)]


@pytest.mark.parametrize("shard", [50, 1 << 22])
def test_round_trip(docs_of, library, rows, shard):
    table = stage(write_tokens(docs_of(rows), shard_tokens=shard), "t")
    got = sorted(read_documents(table).collect(), key=lambda r: r.start)
    assert [(str(r.doc_id), *r[1:]) for r in got] == brute(rows, library)
    files = sorted(table.collect(), key=lambda r: r.start)
    assert (len(files) > 50) == (shard == 50)
    assert sum(r.n_documents for r in files) == len(rows)
    assert [r.start for r in files[1:]] == [r.start + r.n_tokens for r in files[:-1]]


def test_one_range_of_several_files(monkeypatch, docs_of, library, rows):
    import cardweave.llm.token_files as token_files

    monkeypatch.setattr(token_files, "MOST_RANGES", 2)
    table = stage(write_tokens(docs_of(rows), shard_tokens=100), "t")
    assert table.count() > 5
    got = sorted(read_documents(table).collect(), key=lambda r: r.start)
    assert [(str(r.doc_id), *r[1:]) for r in got] == brute(rows, library)


def test_questions_over_all_files(docs_of, library, rows):
    table = stage(write_tokens(docs_of(rows), shard_tokens=200), "t")
    plain = {i: library(t) for i, t in rows}
    tokens = [2, plain[1002][0], plain[1002][1], 50255]
    counts = {r.token: r.n for r in token_counts(table, tokens).collect()}
    assert counts == {t: sum(ids.count(t) for ids in plain.values()) for t in tokens}
    got = sorted((str(r.doc_id), r.place) for r in token_places(table, tokens[2]).collect())
    assert got == sorted((str(i), p) for i, ids in plain.items() for p, t in enumerate(ids) if t == tokens[2])


def test_repeated_rows_and_leftovers(spark, docs_of, library):
    rows = [(7, "the same text")] * 300 + [(7, "another"), (3, "x")]
    folder = fresh_path(spark, "own")
    write_tokens(docs_of([(1, "of another run")]), folder).collect()
    table = stage(write_tokens(docs_of(rows), folder, shard_tokens=64), "t")
    got = sorted(read_documents(table).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [3] + [7] * 301 and got[0].start == 0
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    same = zlib.crc32(np.array(library("the same text"), "<u4").tobytes())
    assert sum(r.ids_crc32 == same for r in got) == 300


def test_empty_table_other_ids_and_clashing_columns(spark, docs_of, library):
    assert tokens_digest(docs_of([])).collect() == []
    clash = docs_of([(1, "a b")]).selectExpr("*", "1 AS ids", "2 AS n_tokens", "3 AS tie", "4 AS row", "5 AS path", "6 AS start")
    assert [tuple(r) for r in tokens_digest(clash).collect()] == [(1, *brute([(1, "a b")], library)[0][1:])]
    named = spark.createDataFrame([("b", "x"), ("a", "y y")], "doc_id STRING, text STRING")
    assert sorted((r.start, r.doc_id) for r in tokens_digest(named).collect()) == [(0, "a"), (3, "b")]
