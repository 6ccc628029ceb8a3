"""Token ids of all documents in files, in the order of doc_id, and what can be asked of them.

Documents are encoded where they are read, and the ids, two bytes each, are dealt by ranges of doc_id and sorted.
A task writes its range as one file after the other, closed at ``SHARD_TOKENS`` ids: it holds the ids of one
file at a time, however large the range. Files have names of their own in every attempt of a
task; the table of files, which Spark commits, says which count, so a task that is lost or run
twice leaves nothing but files nobody reads.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.llm.kernel import SpanHasher, expand, slices, text_buffers
from cardweave.llm.tokens import WordTokens
from cardweave.llm.wavelet import WaveletFile, pack_file
from cardweave.storage import folder_in_task, fresh_path, stage

END_ID = 2
#: A file is closed with the document that brings it to so many ids.
SHARD_TOKENS = 1 << 22
#: Ranges of doc_id at most; beyond it a range is several files.
MOST_RANGES = 20_000
#: The tokenizer is given about so many bytes in a call.
_CALL_BYTES = 1 << 10
#: Texts of about so many bytes are encoded at once; their hashes stay in the processor's cache.
_SLICE_BYTES = 1 << 18
_FILES = "path string, range int, number int, before bigint, n_documents bigint, n_tokens bigint"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Letters 1, digits 2, and 3 for the rest of printable ASCII but the bar, which is part of the added token.
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = 3
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KINDS[0x30:0x3A] = 2
_KINDS[ord("|")] = 0


class _RunTokens(WordTokens):
    """Ids by the ``tokenizers`` library, which meets each run of letters, digits or other characters about once.

    The pre-tokenisation of the vocabulary ends a token wherever two neighbours are ASCII of different
    kinds, but behind an apostrophe, which may belong to the letters after it. So texts can be cut there too.
    """

    pools = 2

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # In a byte-level vocabulary each character stands for a byte.
        sizes = {i: len(token) for token, i in self.tokenizer.get_vocab().items()} | added
        self.sizes = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)])
        self.hashers = SpanHasher(21), SpanHasher(22)
        self._reset()

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        kinds, cut = _KINDS[data], np.zeros(len(data) + 1, bool)
        if len(data):
            left, right = kinds[:-1], kinds[1:]
            cut[1:-1] = (left != right) & (left > 0) & (right > 0) & (data[:-1] != ord("'"))
        cut[super()._cuts(data, bounds)] = True
        return np.flatnonzero(cut)

    def _ids_of_pieces(self, raw: bytes, stops: np.ndarray) -> np.ndarray:
        # The library is a good deal faster on short strings.
        last = np.flatnonzero(np.diff(stops // _CALL_BYTES, append=-1))
        cuts = [0, *stops[last].tolist()]
        return np.concatenate([self._ids(raw[a:b]) for a, b in zip(cuts, cuts[1:])])

    def _ids(self, raw: bytes) -> np.ndarray:
        (encoding,) = self.tokenizer.encode_batch_fast([raw.decode("utf-8")], add_special_tokens=False)
        return np.array(encoding.ids, np.uint32)


class FileTokens(WordTokens):
    """Ids by the ``tokenizers`` library and its file of a byte-level vocabulary.

    Words that the table does not hold are put together from their runs, of which far fewer are new.
    """

    def __init__(self, vocabulary: str):
        self.runs = _RunTokens(vocabulary)
        self.hashers = self.runs.hashers
        self._reset()

    def _tokenise(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = ends - starts
        ids, counts = self.runs.encode(data[expand(starts, sizes)], np.concatenate(([0], np.cumsum(sizes))))
        return self._store(ids) + np.cumsum(counts) - counts, counts


def _shared_tokens(vocabulary: str) -> FileTokens:
    """The tokenizer of a Python worker, with the words it knows, for all tasks the worker runs one after the other.

    A task brings globals of its own, so what outlives it hangs on a module that belongs to the process.
    """
    state = sys.modules.setdefault("worker_state_of_token_files", ModuleType("worker_state_of_token_files"))
    if getattr(state, "vocabulary", None) != vocabulary:
        state.tokens, state.vocabulary = FileTokens(vocabulary), vocabulary
    return state.tokens


def _vocabulary_bits(vocabulary: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return max(max(Tokenizer.from_file(vocabulary).get_vocab().values()), end_id, 1).bit_length()


def _id_kind(bits: int) -> np.dtype:
    return np.dtype("<u2" if bits <= 16 else "<u4")


def _encoded(vocabulary: str, end_id: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kind = _shared_tokens(vocabulary), _id_kind(bits)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for first, last in slices(offsets, _SLICE_BYTES):
                base = offsets[first]
                ids, counts = words.encode(data[base : offsets[last]], offsets[first : last + 1] - base)
                ends = np.cumsum(counts)
                ids, counts = np.insert(ids, ends, end_id).astype(kind), counts + 1
                raw, places = ids.tobytes(), (np.cumsum(counts) * kind.itemsize).tolist()
                blobs = [raw[a:b] for a, b in zip([0, *places], places)]
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(b) for b in blobs], pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "tie", "ids"],
                )

    return run


def _written(folder: str, bits: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = folder_in_task(folder)
        files.create_dir(root, recursive=True)
        number, before = TaskContext.get().partitionId(), 0
        keys, parts, sizes, shard = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal shard, before
            ids = np.frombuffer(b"".join(parts), _id_kind(bits))
            doc_ids = pa.chunked_array(keys).combine_chunks()
            documents = pa.record_batch([doc_ids, pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"])
            name = f"{number:06d}-{shard:06d}-{uuid.uuid4().hex}.wm"
            with files.open_output_stream(f"{root}/{name}") as out:
                out.write(pack_file(ids, bits, documents))
            row = [name, number, shard, before, len(sizes), len(ids)]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            before, shard = before + len(ids), shard + 1
            for held in (keys, parts, sizes):
                held.clear()
            names = ["path", "range", "number", "before", "n_documents", "n_tokens"]
            return pa.record_batch([pa.array([x], kind) for x, kind in zip(row, kinds)], names)

        held = 0
        for batch in batches:
            counts, first = batch.column("n_tokens").to_pylist(), 0
            for i, blob in enumerate(batch.column("ids")):
                parts.append(blob.as_py())
                sizes.append(counts[i])
                held += counts[i]
                if held >= shard_tokens:
                    keys.append(batch.column("doc_id").slice(first, i + 1 - first))
                    yield close()
                    held, first = 0, i + 1
            if first < batch.num_rows:
                keys.append(batch.column("doc_id").slice(first))
        if sizes:
            yield close()

    return run


def write_tokens(
    df: DataFrame, folder: str | None = None, vocabulary: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Encode ``df`` (doc_id, text) and write the files; the table of files: path, start, n_documents, n_tokens.

    Files are in ascending order of doc_id, and start is the number of ids before a file. A
    null or empty text is ``end_id`` alone. Rows without doc_id come first; rows with the same
    doc_id follow each other, and repeated rows are written as often as they come. Other columns are not
    read. An empty table has no files. ``folder`` is one that all executors reach, by
    default in the shared folder.
    """
    vocabulary = vocabulary or default_vocabulary()
    bits = _vocabulary_bits(vocabulary, end_id)
    folder = folder or fresh_path(df.sparkSession, "token-files")
    id_type = df.schema["doc_id"].dataType.simpleString()
    encoded = df.select("doc_id", "text").mapInArrow(
        _encoded(vocabulary, end_id, bits), f"doc_id {id_type}, n_tokens bigint, tie bigint, ids binary"
    )
    # The number tells rows of one doc_id and text apart, so that no number of them must stay together.
    encoded = stage(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded")
    total = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    order, ranges = ["doc_id", "tie", "row"], min(max(1, -(-total // shard_tokens)), MOST_RANGES)
    dealt = encoded.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    files = stage(dealt.select("doc_id", "n_tokens", "ids").mapInArrow(_written(folder, bits, shard_tokens), _FILES), "file-table")
    # One number for each range, of which there are at most MOST_RANGES.
    sizes = {r["range"]: r["n"] for r in files.groupBy("range").agg(F.sum("n_tokens").alias("n")).collect()}
    starts, passed = [], 0
    for number in range(max(sizes, default=-1) + 1):
        starts.append(passed)
        passed += sizes.get(number, 0)
    base = df.sparkSession.createDataFrame(list(enumerate(starts)), "range int, base bigint")
    return files.join(F.broadcast(base), "range").select(
        F.concat(F.lit(f"{folder.rstrip('/')}/"), "path").alias("path"),
        (F.col("base") + F.col("before")).alias("start"),
        "n_documents",
        "n_tokens",
    )


def _opened(path: str):
    folder, name = path.rsplit("/", 1)
    files, root = folder_in_task(folder)
    return files.open_input_file(f"{root}/{name}")


def _over_files(table: DataFrame, answer, schema: str | T.StructType) -> DataFrame:
    """``answer(file, start)`` gives the record batches of one file; files are dealt out evenly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _opened(row["path"]) as source:
                    yield from answer(WaveletFile(lambda at, size: source.read_at(size, at)), row["start"])  # noqa: B023

    tasks = min(max(1, table.count()), MOST_RANGES)
    return table.select("path", "start").repartition(tasks).mapInArrow(run, schema)


def read_documents(table: DataFrame, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files of ``table``.

    start is the number of ids before the document, and ids_crc32 the unsigned CRC-32 of its ids as
    little-endian unsigned 32-bit integers.
    """

    def answer(file: WaveletFile, start: int) -> Iterator[pa.RecordBatch]:
        documents = file.documents().combine_chunks()
        counts = documents.column("n_tokens").to_numpy()
        ends = np.cumsum(counts)
        raw, places = memoryview(file.ids().astype("<u4")).cast("B"), (4 * ends).tolist()
        crc = [zlib.crc32(raw[a:b]) for a, b in zip([0, *places], places)]
        yield from pa.table(
            {
                "doc_id": documents.column("doc_id"),
                "start": pa.array(start + ends - counts, pa.int64()),
                "n_tokens": documents.column("n_tokens"),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
        ).to_batches()

    return _over_files(table, answer, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_counts(table: DataFrame, tokens: list[int]) -> DataFrame:
    """token and n, how often each of ``tokens`` occurs in all files; no file is decoded."""
    asked = sorted(set(tokens))

    def answer(file: WaveletFile, start: int) -> Iterator[pa.RecordBatch]:
        counts = [file.count(t) for t in asked]
        yield pa.record_batch([pa.array(asked, pa.int64()), pa.array(counts, pa.int64())], ["token", "n"])

    return _over_files(table, answer, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def token_places(table: DataFrame, token: int, id_type: str = "bigint") -> DataFrame:
    """doc_id and place (the number of the id in its document) of every occurrence of ``token``; no file is decoded."""

    def answer(file: WaveletFile, start: int) -> Iterator[pa.RecordBatch]:
        found = file.occurrences(token)
        if len(found):
            documents = file.documents().combine_chunks()
            ends = np.cumsum(documents.column("n_tokens").to_numpy())
            rows = np.searchsorted(ends, found, side="right")
            places = found - np.concatenate(([0], ends))[rows]
            doc_ids = documents.column("doc_id").combine_chunks().take(pa.array(rows))
            yield pa.record_batch([doc_ids, pa.array(places, pa.int64())], ["doc_id", "place"])

    return _over_files(table, answer, f"doc_id {id_type}, place bigint")


def tokens_digest(df: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of ``df``, read back from the files written of it."""
    return read_documents(stage(write_tokens(df), "files"), df.schema["doc_id"].dataType.simpleString())
