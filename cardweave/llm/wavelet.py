"""Token sequences as wavelet matrices, one compressed file for each shard.

A wavelet matrix holds the ids bit by bit, the highest first. Each plane has one bit for every
token, and behind a plane the tokens are stably parted into those with a 0 and those with a
1. How many ones lie before a place (rank) says where a token went, and where the j-th one is
(select) where it came from. So one file answers which token stands at a place, how
often a token occurs in a range, and where its k-th occurrence is, by a step for each plane,
and gives back the whole sequence.

A file is a frame, a header, the planes, and a directory of the documents with their sizes. A plane
is stored in blocks of 8 KiB, compressed by zstd where that helps, with the number of ones and of bytes
before each block; a question reads and opens one block for each plane. Files whose header names no
codec are older ones, compressed by zlib.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

MAGIC = b"wmtokens"
BLOCK_BITS = 1 << 16
_BLOCK_BYTES = BLOCK_BITS // 8
_FRAME = "<8sQ"
_FRAME_BYTES = struct.calcsize(_FRAME)
_OPEN_BLOCKS = 64
_CODEC = "zstd"
#: Tokens parted at once, a multiple of 8; they stay in the processor's cache.
_STEP = 1 << 16


def planes_of(ids: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The planes of ``ids`` as packed bits, the highest bit first."""
    level = np.array(ids)
    # Behind a plane: tokens with a 0 are put where the level was, those with a 1 are kept until its end.
    upper = np.empty_like(level)
    for bit in range(bits - 1, -1, -1):
        plane, low, high = np.empty(-(-len(level) // 8), np.uint8), 0, 0
        for first in range(0, len(level), _STEP):
            tokens = level[first : first + _STEP]
            ones = (tokens >> level.dtype.type(bit) & level.dtype.type(1)).astype(bool)
            plane[first // 8 : (first + _STEP) // 8] = np.packbits(ones)
            # Much faster than a mask as an index, which has a branch for every bit.
            with_0, with_1 = tokens.compress(~ones), tokens.compress(ones)
            level[low : low + len(with_0)], upper[high : high + len(with_1)] = with_0, with_1
            low, high = low + len(with_0), high + len(with_1)
        level[low:] = upper[:high]
        yield plane


def pack_file(ids: np.ndarray, bits: int, documents: pa.RecordBatch, **more) -> bytes:
    """One file: ``ids`` in planes, ``documents`` (doc_id, n_tokens) in the order of their ids, and header fields."""
    body, planes, at, codec = [], [], 0, pa.Codec(_CODEC)
    for plane in planes_of(ids, bits):
        raw, sizes = plane.tobytes(), []
        for first in range(0, len(raw), _BLOCK_BYTES):
            block = raw[first : first + _BLOCK_BYTES]
            small = codec.compress(block, asbytes=True)
            body.append(small if len(small) < len(block) else block)
            sizes.append(len(body[-1]))
        starts = np.arange(0, len(plane), _BLOCK_BYTES)
        ones = np.add.reduceat(np.bitwise_count(plane), starts, dtype=np.int64) if len(starts) else starts
        index = np.stack((np.cumsum(ones), np.cumsum(sizes, dtype=np.int64))).astype("<u8").tobytes()
        body.append(index)
        planes.append({"at": at, "index": at + sum(sizes), "ones": int(ones.sum())})
        at += sum(sizes) + len(index)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(documents)
    directory = sink.getvalue().to_pybytes()
    header = {"tokens": len(ids), "bits": bits, "codec": _CODEC, "planes": planes, "directory": [at, len(directory)], **more}
    head = json.dumps(header).encode()
    return b"".join([struct.pack(_FRAME, MAGIC, len(head)), head, *body, directory])


class WaveletFile:
    """Questions to one file. ``read(at, size)`` gives bytes of it; only what a question needs is read."""

    def __init__(self, read: Callable[[int, int], bytes]):
        magic, length = struct.unpack(_FRAME, read(0, _FRAME_BYTES))
        if magic != MAGIC:
            raise ValueError("not a file of tokens")
        self.header = json.loads(read(_FRAME_BYTES, length))
        self.read, self.base = read, _FRAME_BYTES + length
        self.codec = pa.Codec(self.header["codec"]) if "codec" in self.header else None
        self.tokens, self.bits = self.header["tokens"], self.header["bits"]
        self.zeros = [self.tokens - plane["ones"] for plane in self.header["planes"]]
        self._indexes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._open: OrderedDict[tuple[int, int], np.ndarray] = OrderedDict()

    @classmethod
    def of(cls, content: bytes) -> WaveletFile:
        return cls(lambda at, size: content[at : at + size])

    def documents(self) -> pa.Table:
        """doc_id and n_tokens of the documents, in the order of their tokens."""
        at, size = self.header["directory"]
        return pa.ipc.open_stream(self.read(self.base + at, size)).read_all()

    def _index(self, plane: int) -> tuple[np.ndarray, np.ndarray]:
        """Ones before each block, and where each block starts in the file; both with their ends."""
        if plane not in self._indexes:
            place = self.header["planes"][plane]
            blocks = -(-self.tokens // BLOCK_BITS)
            both = np.frombuffer(self.read(self.base + place["index"], 16 * blocks), "<u8").reshape(2, blocks)
            ones, sizes = np.concatenate((np.zeros((2, 1), np.int64), both.astype(np.int64)), axis=1)
            self._indexes[plane] = ones, self.base + place["at"] + sizes
        return self._indexes[plane]

    def _unpacked(self, raw: bytes, size: int) -> bytes:
        """The ``size`` bytes of a block; it is stored as it is where compressing did not make it smaller."""
        if len(raw) == size:
            return raw
        return self.codec.decompress(raw, size, asbytes=True) if self.codec else zlib.decompress(raw)

    def _block(self, plane: int, block: int) -> np.ndarray:
        """One block as a number for each bit, 0 or 1."""
        key = plane, block
        if key in self._open:
            self._open.move_to_end(key)
            return self._open[key]
        starts = self._index(plane)[1]
        raw = self.read(int(starts[block]), int(starts[block + 1] - starts[block]))
        n = min(BLOCK_BITS, self.tokens - block * BLOCK_BITS)
        self._open[key] = np.unpackbits(np.frombuffer(self._unpacked(raw, -(-n // 8)), np.uint8), count=n)
        if len(self._open) > _OPEN_BLOCKS:
            self._open.popitem(last=False)
        return self._open[key]

    def _rank(self, plane: int, place: int) -> int:
        """Ones of a plane before ``place``."""
        block, within = divmod(place, BLOCK_BITS)
        ones = int(self._index(plane)[0][block])
        return ones + int(self._block(plane, block)[:within].sum()) if within else ones

    def _select(self, plane: int, bit: int, ks: np.ndarray) -> np.ndarray:
        """Places of the bits of a plane that are ``bit``, by their numbers among those (from 0, ascending)."""
        ones = self._index(plane)[0]
        before = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK_BITS, self.tokens) - ones
        blocks = np.searchsorted(before, ks, side="right") - 1
        out = np.empty(len(ks), np.int64)
        for block in np.unique(blocks).tolist():
            own = blocks == block
            out[own] = block * BLOCK_BITS + np.flatnonzero(self._block(plane, block) == bit)[ks[own] - before[block]]
        return out

    def _descend(self, token: int, first: int, last: int) -> tuple[int, int]:
        """Where behind the last plane the tokens of [first, last) that are ``token`` lie."""
        for plane in range(self.bits):
            a, b = self._rank(plane, first), self._rank(plane, last)
            if token >> (self.bits - 1 - plane) & 1:
                first, last = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                first, last = first - a, last - b
        return first, last

    def token(self, place: int) -> int:
        """The token at ``place``."""
        if not 0 <= place < self.tokens:
            raise IndexError(place)
        token = 0
        for plane in range(self.bits):
            bit = int(self._block(plane, place // BLOCK_BITS)[place % BLOCK_BITS])
            ones = self._rank(plane, place)
            place = self.zeros[plane] + ones if bit else place - ones
            token = token << 1 | bit
        return token

    def count(self, token: int, first: int = 0, last: int | None = None) -> int:
        """How often ``token`` occurs at places from ``first`` up to ``last``, which is the end by default."""
        if not 0 <= token < 1 << self.bits:
            return 0
        a, b = self._descend(token, first, self.tokens if last is None else last)
        return b - a

    def occurrences(self, token: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Places of the occurrences of ``token`` numbered ``first`` up to ``last``, by default all."""
        low, high = self._descend(token, 0, self.tokens) if 0 <= token < 1 << self.bits else (0, 0)
        places = np.arange(low, high, dtype=np.int64)[first:last]
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            places = self._select(plane, bit, places - self.zeros[plane] if bit else places)
        return places

    def _plane(self, plane: int) -> np.ndarray:
        """A whole plane as a number for each bit."""
        starts = self._index(plane)[1].tolist()
        raw = self.read(starts[0], starts[-1] - starts[0])
        blocks = []
        for k, (a, b) in enumerate(zip(starts, starts[1:])):
            block = raw[a - starts[0] : b - starts[0]]
            whole = -(-min(BLOCK_BITS, self.tokens - k * BLOCK_BITS) // 8)
            blocks.append(self._unpacked(block, whole))
        return np.unpackbits(np.frombuffer(b"".join(blocks), np.uint8), count=self.tokens)

    def ids(self) -> np.ndarray:
        """The whole sequence. Every plane is read once, the last one first: each says where what is behind it came from."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        level, before = np.zeros(self.tokens, kind), np.empty(self.tokens, kind)
        for plane in range(self.bits - 1, -1, -1):
            ones = self._plane(plane).view(bool)
            zeros = self.zeros[plane]
            level[zeros:] |= kind(1 << (self.bits - 1 - plane))
            low, high = 0, zeros
            for first in range(0, self.tokens, _STEP):
                tokens, part = before[first : first + _STEP], ones[first : first + _STEP]
                with_0, with_1 = np.flatnonzero(~part), np.flatnonzero(part)
                tokens[with_0], tokens[with_1] = level[low : low + len(with_0)], level[high : high + len(with_1)]
                low, high = low + len(with_0), high + len(with_1)
            level, before = before, level
        return level
