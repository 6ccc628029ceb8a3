"""Suffix-array dedup: maximal repeats across documents, from interval trees over suffix arrays.

Every window of ``width`` bytes has an anchor, the position of the smallest hash among its
short substrings. Equal windows have equal anchors, so consecutive windows of one anchor make
a segment, and segments whose anchor occurs in one document only hold no repeat. The others
meet by the hash of their anchor. There the distinct segments form a suffix array; a stack scan
over its common prefixes yields the interval tree, and each interval whose occurrences are
preceded by different bytes is a maximal repeat group, with all its occurrences. A group
knows its smallest document, and goes back to the documents it covers.

Texts travel in chunks of a few megabytes, compressed, a row each. What a chunk sends is
combined there first: an anchor or a segment that stands a thousand times in a chunk goes out once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave.llm.kernel import SLICE_BYTES, SpanHasher, expand, mix
from cardweave.storage import stage

WIDTH = 50
_GRAM = 16
#: Bytes of text in a chunk, and of text for each group of anchors. Both only shape the work.
CHUNK_BYTES, GROUP_BYTES = 4 << 20, 8 << 20
#: Segments of an anchor found in more chunks than this are split into their windows, which
#: meet by their own hash.
HOT_CHUNKS = 2048
_PLACE_BITS = 21
#: Anchors are 48-bit hashes. Two that clash only bring texts together that share nothing.
_ANCHOR_SHIFT = np.uint64(16)


def pack(*arrays: np.ndarray) -> bytes:
    """Compressed columns of equal length; bytes of one significance lie together."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays if len(a))
    return zstandard.ZstdCompressor(level=1).compress(raw)


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of a rising column, which pack smaller; ``np.cumsum`` undoes it."""
    return np.diff(x, prepend=x.dtype.type(0))


def unpack(packed: bytes, *kinds: type) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def _chunks(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids, lengths = [i for i, _ in held], [len(t) for _, t in held]
            text = b"".join(t for _, t in held)
            name = hashlib.sha256(text + repr(ids).encode()).digest()[:8]
            columns = [
                pa.array([int.from_bytes(name, "little", signed=True)], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([zstandard.ZstdCompressor(level=3).compress(text)], pa.binary()),
            ]
            return pa.record_batch(columns, ["chunk", "ids", "lengths", "packed"])

        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    held.append((i, (text or "").encode()))
                    size += len(held[-1][1])
                    if size >= CHUNK_BYTES or len(held) >= 100_000:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return run


class _Chunk:
    """Texts of a chunk one after the other, and its segments."""

    def __init__(self, ids: list, lengths: list, packed: bytes):
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
        self.bounds = np.concatenate(([0], np.cumsum(np.array(lengths, np.int64))))
        # A document without an id is compared with none.
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)

    def segments(self, width: int, gram: SpanHasher, content: SpanHasher) -> tuple[np.ndarray, ...]:
        """Anchor hash, content hash, start, length and text number of every segment."""
        found: list[tuple[np.ndarray, ...]] = []
        # Pieces of about a mebibyte; a longer text is cut into pieces that share width - 1 bytes.
        at, last_bound = 0, int(self.bounds[-1])
        while at < last_bound:
            stop = min(at + SLICE_BYTES, last_bound)
            found.append(self._piece(at, stop, width, gram, content))
            at = stop if stop == last_bound else stop - width + 1
        return tuple(np.concatenate(x) for x in zip(*found)) if found else tuple(np.zeros(0, np.int64) for _ in range(5))

    def _piece(self, at: int, stop: int, width: int, gram: SpanHasher, content: SpanHasher) -> tuple[np.ndarray, ...]:
        data = self.data[at:stop]
        none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
        if len(data) < width:
            return none
        starts = np.arange(len(data) - _GRAM + 1)
        hashes = gram.spans(gram.prefix(data), starts, starts + _GRAM)
        mask = np.uint64((1 << _PLACE_BITS) - 1)
        least = (hashes & ~mask) | starts.astype(np.uint64)
        span, reach = width - _GRAM + 1, 1
        while 2 * reach <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < span:
            least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
        anchor = (least & mask).astype(np.int64)
        # Windows that lie within one text.
        ends = self.bounds[1:] - at
        whole = np.ones(len(anchor) + 1, np.int64)
        crossing = np.zeros(len(anchor) + 1, np.int64)
        inner = ends[(ends > 0) & (ends < len(data))]
        np.add.at(crossing, np.clip(inner - width + 1, 0, len(anchor)), 1)
        np.add.at(crossing, np.clip(inner, 0, len(anchor)), -1)
        whole = np.cumsum(crossing)[:-1] == 0
        window = np.flatnonzero(whole)
        if not len(window):
            return none
        own = anchor[window]
        new = np.append(True, (own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1))
        first = np.flatnonzero(new)
        start = window[first]
        end = window[np.append(first[1:], len(window)) - 1] + width
        text = np.searchsorted(self.bounds, start + at, side="right") - 1
        keep = self.known[text]
        start, end, text, first = start[keep], end[keep], text[keep], first[keep]
        return mix(hashes[own[first]]) >> _ANCHOR_SHIFT, content.spans(content.prefix(data), start, end), start + at, end - start, text


def _hashers() -> tuple[SpanHasher, SpanHasher]:
    return SpanHasher(41), SpanHasher(42)


def _group_of(anchor: np.ndarray, groups: int) -> np.ndarray:
    """Equal ranges of anchors, so that those of a group lie close together."""
    return ((anchor >> np.uint64(16)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _by_group(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1])) if len(group) else np.zeros(0, np.int64)
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
        yield int(group[order[a]]), order[a:b]


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "chunk", "blob"])


def _anchors(width: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = _hashers()
        for batch in batches:
            for row in range(batch.num_rows):
                chunk_id, ids, lengths, packed = (c[row].as_py() for c in batch.columns)
                chunk = _Chunk(ids, lengths, packed)
                anchor, _, _, _, text = chunk.segments(width, *hashers)
                if not len(anchor):
                    continue
                order = np.argsort(anchor, kind="stable")
                anchor, doc = anchor[order], chunk.ids[text[order]]
                first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
                least, most = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)
                anchor = anchor[first]
                rows = [
                    (g, chunk_id, pack(steps(anchor[k]), least[k], most[k] - least[k])) for g, k in _by_group(_group_of(anchor, groups))
                ]
                yield _blobs(rows)

    return run


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """For each chunk the anchors of this group that occur in two documents or more, and which are hot."""
    chunks = table.column("chunk").to_pylist()
    parts = [unpack(b, np.uint64, np.int64, np.int64) for b in table.column("blob").to_pylist()]
    source = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    anchor = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    least, most = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
    most = most + least
    order = np.argsort(anchor, kind="stable")
    anchor, least, most, source = anchor[order], least[order], most[order], source[order]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    counts = np.diff(np.append(first, len(anchor)))
    repeated = np.minimum.reduceat(least, first) < np.maximum.reduceat(most, first)
    keep = np.repeat(repeated, counts)
    hot = np.repeat(counts > HOT_CHUNKS, counts)[keep]
    anchor, source = anchor[keep], source[keep]
    rows = [(chunks[s], pack(steps(anchor[k]), hot[k].astype(np.uint8))) for s, k in _by_group(source)]
    return pa.table(
        {"chunk": pa.array([r[0] for r in rows], pa.int64()), "blob": pa.array([r[1] for r in rows], pa.binary())}
    )


class _Distinct:
    """Distinct segments of a chunk with a repeated anchor; hot ones as their single windows.

    The order depends on nothing but the chunk and its repeated anchors, so that what is found
    for a segment can name it by its number.
    """

    def __init__(self, chunk: _Chunk, blobs: list[bytes], width: int, hashers: tuple[SpanHasher, SpanHasher]):
        anchor, content, start, length, text = chunk.segments(width, *hashers)
        parts = [unpack(b, np.uint64, np.uint8) for b in blobs]
        repeated = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        hot = np.concatenate([p[1] for p in parts]).astype(bool)
        order = np.argsort(repeated, kind="stable")
        repeated, hot = repeated[order], hot[order]
        place = np.minimum(np.searchsorted(repeated, anchor), len(repeated) - 1)
        found = repeated[place] == anchor
        split = found & hot[place]
        whole = found & ~split
        key, content_key = anchor[whole], content[whole]
        start_, length_, text_ = start[whole], length[whole], text[whole]
        if split.any():
            windows = length[split] - width + 1
            starts = expand(start[split], windows)
            texts = np.repeat(text[split], windows)
            own = np.empty(len(starts), np.uint64)
            for k in range(0, len(starts), SLICE_BYTES):  # starts rise, so every part spans little text
                part = starts[k : k + SLICE_BYTES]
                own[k : k + len(part)] = hashers[1].words(chunk.data, part, part + width)
            key, content_key = np.append(key, own >> _ANCHOR_SHIFT), np.append(content_key, own)
            start_, text_ = np.append(start_, starts), np.append(text_, texts)
            length_ = np.append(length_, np.full(len(starts), width))
        self.start, self.length, self.text = start_, length_, text_
        # Equal segments get one number.
        order = np.lexsort((content_key, key))
        key, content_key = key[order], content_key[order]
        new = np.append(True, (key[1:] != key[:-1]) | (content_key[1:] != content_key[:-1]))[: len(key)]
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.key, self.sample = key[first], order[first]
        if len(first):
            doc = chunk.ids[text_][order]
            self.least, self.most = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)


def _segments(width: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = _hashers()
        for batch in batches:
            for row in range(batch.num_rows):
                chunk_id, ids, lengths, packed, blobs = (c[row].as_py() for c in batch.columns)
                chunk = _Chunk(ids, lengths, packed)
                distinct = _Distinct(chunk, blobs, width, hashers)
                if not len(distinct.key):
                    continue
                start, length = distinct.start[distinct.sample], distinct.length[distinct.sample]
                rows = []
                for group, k in _by_group(_group_of(distinct.key, groups)):
                    least, most = distinct.least[k], distinct.most[k]
                    columns = pack(
                        steps(distinct.key[k]), steps(k.astype(np.int32)), length[k].astype(np.int32), least, most - least
                    )
                    text = zstandard.ZstdCompressor(level=1).compress(chunk.data[expand(start[k], length[k])].tobytes())
                    rows.append((group, chunk_id, len(columns).to_bytes(4, "little") + columns + text))
                yield _blobs(rows)

    return run


def _words_at(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Eight bytes from ``start`` on as a number in their order; bytes from ``end`` on count as zero."""
    value = np.zeros(len(start), np.uint64)
    for k in range(8):
        at = start + k
        byte = np.where(at < end, data[np.minimum(at, len(data) - 1)], 0)
        value = value << np.uint64(8) | byte.astype(np.uint64)
    return value


def suffix_order(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes [start, end) and, for each, the common prefix with the one before it.

    Suffixes are sorted by their first eight bytes; those that agree are sorted on by the next
    eight, until no two agree or both have ended. A suffix that is a prefix of another comes first.
    """
    n = len(start)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # suffixes that agree so far, by their place in the order
    common = np.zeros(n, np.int64)
    active, depth = np.arange(n), 0  # places in the order that are not settled
    while len(active):
        rows = order[active]
        word = _words_at(data, start[rows] + depth, end[rows])
        # A zero byte of the text sorts like the end; the length left tells them apart.
        left = np.clip(end[rows] - start[rows] - depth, 0, 8)
        by = np.lexsort((left, word, group[active]))
        rows, word, left = rows[by], word[by], left[by]
        order[active] = rows
        same_group = np.append(False, group[active][1:] == group[active][:-1])
        differ = word[1:] ^ word[:-1]
        equal = np.zeros(len(active), np.int64)
        high = np.full(len(differ), 8, np.int64)
        for k in range(8):
            byte = (differ >> np.uint64(56 - 8 * k)) & np.uint64(255)
            high = np.where((high == 8) & (byte != 0), k, high)
        equal[1:] = np.minimum(high, np.minimum(left[1:], left[:-1]))
        common[active[same_group]] += equal[same_group]
        goes_on = same_group & (equal == 8)
        # Suffixes in a run of agreeing ones stay active.
        run = np.cumsum(~goes_on)
        group[active] = active[np.flatnonzero(~goes_on)][run - 1]
        stays = goes_on | np.append(goes_on[1:], False)
        active, depth = active[stays], depth + 8
    return order, common


def interval_tree(common: list[int], least: int) -> tuple[list[int], list[int], list[int]]:
    """(first, last, length) of every interval of a suffix array with a common prefix of ``least`` or more.

    ``common[i]`` is the common prefix of suffixes i - 1 and i. One pass with a stack.
    """
    firsts, lasts, lengths = [], [], []
    stack: list[tuple[int, int]] = []  # (first suffix, common prefix) of the open intervals
    for i in range(1, len(common) + 1):
        here = common[i] if i < len(common) else 0
        first = i - 1
        while stack and stack[-1][1] > here:
            first, length = stack.pop()
            firsts.append(first)
            lasts.append(i - 1)
            lengths.append(length)
        if here >= least and (not stack or stack[-1][1] < here):
            stack.append((first, here))
    return firsts, lasts, lengths


def maximal_repeats(
    data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal substrings of the given segments of ``data``.

    Returns, for every occurrence of every group, the group's number, the position and the
    length. Substrings of ``width`` bytes or more count that cannot be extended to the left without
    losing an occurrence; the start of a segment ends any extension.
    """
    windows = np.maximum(length - width + 1, 0)
    at = expand(start, windows)
    end = np.repeat(start + length, windows)
    opening = np.repeat(start, windows) == at
    order, common = suffix_order(data, at, end)
    # Only places next to a common prefix of ``width`` can be part of an interval.
    near = common >= width
    near = near | np.append(near[1:], False)
    places = np.flatnonzero(near)
    none = np.zeros(0, np.int64)
    if not len(places):
        return none, none, none
    firsts, lasts, lengths = (np.array(x, np.int64) for x in interval_tree(common[places].tolist(), width))
    if not len(firsts):
        return none, none, none
    suffix = order[places]
    before = np.where(opening[suffix], -1 - suffix, data[np.maximum(at[suffix] - 1, 0)].astype(np.int64))
    # Different bytes before two neighbours somewhere inside the interval.
    change = np.append(0, np.cumsum(before[1:] != before[:-1]))
    diverse = change[lasts] > change[firsts]
    firsts, lasts, lengths = firsts[diverse], lasts[diverse], lengths[diverse]
    sizes = lasts - firsts + 1
    return np.repeat(np.arange(len(firsts)), sizes), at[suffix[expand(firsts, sizes)]], np.repeat(lengths, sizes)


def _repeats(width: int, groups: bool = False):
    """Per chunk: number of the segment, start in it, length and smallest document of each group there.

    With ``groups``, a hash of the group's string takes the place of the document, and all occurrences
    are there; else only those that a larger doc_id loses.
    """

    def run(table: pa.Table) -> pa.Table:
        chunks, columns, texts = table.column("chunk").to_pylist(), [], []
        for blob in table.column("blob").to_pylist():
            size = int.from_bytes(blob[:4], "little")
            columns.append(unpack(blob[4 : 4 + size], np.uint64, np.int32, np.int32, np.int64, np.int64))
            texts.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[4 + size :]), np.uint8))
        source = np.repeat(np.arange(len(columns)), [len(c[0]) for c in columns])
        key, number = (np.concatenate([np.cumsum(c[k], dtype=c[k].dtype) for c in columns]) for k in (0, 1))
        length, least, most = (np.concatenate([c[k] for c in columns]) for k in (2, 3, 4))
        most = most + least
        data, length = np.concatenate(texts), length.astype(np.int64)
        start = np.cumsum(length) - length
        out: list[tuple[np.ndarray, ...]] = []
        # Anchors of this group in several passes, so that the arrays of a pass stay small.
        passes = max(1, -(-len(data) // (2 << 20)))
        chosen = ((key >> np.uint64(20)) % np.uint64(passes)).astype(np.int64)
        for k in range(passes):
            rows = np.flatnonzero(chosen == k)
            if len(rows):
                out.append(_cover(data, key[rows], start[rows], length[rows], least[rows], most[rows], rows, width, groups))
        segment, at, size, first = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(segment, kind="stable")
        segment, at, size, first = segment[order], at[order], size[order], first[order]
        rows = [
            (chunks[s], pack(steps(number[segment[k]]), at[k].astype(np.int32), size[k].astype(np.int32), first[k]))
            for s, k in _by_group(source[segment])
        ]
        return pa.table(
            {"chunk": pa.array([r[0] for r in rows], pa.int64()), "blob": pa.array([r[1] for r in rows], pa.binary())}
        )

    return run


def _cover(
    data: np.ndarray, key: np.ndarray, start: np.ndarray, length: np.ndarray,
    least: np.ndarray, most: np.ndarray, rows: np.ndarray, width: int, groups: bool,
) -> tuple[np.ndarray, ...]:
    # Equal segments of several chunks become one, with the smallest of their documents.
    own = data[expand(start, length)]
    hasher, bounds = SpanHasher(43), np.concatenate(([0], np.cumsum(length)))
    prefix = hasher.prefix(own)
    content = hasher.spans(prefix, bounds[:-1], bounds[1:])
    order = np.lexsort((content, key))
    new = np.append(True, (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1]))
    first = np.flatnonzero(new)
    same = np.empty(len(order), np.int64)
    same[order] = np.cumsum(new) - 1
    smallest = np.minimum.reduceat(least[order], first)
    several = smallest < np.maximum.reduceat(most[order], first)
    sample = order[first]
    # Segments alone under their anchor are no part of another repeat.
    lone = np.append(True, key[sample][1:] != key[sample][:-1])
    lone &= np.append(lone[1:], True)
    shared = np.flatnonzero(~lone)
    group, at, size = maximal_repeats(own, bounds[:-1][sample[shared]], length[sample[shared]], width)
    # The segment each occurrence lies in.
    begins = bounds[:-1][sample]
    by_place = np.argsort(begins, kind="stable")
    holder = by_place[np.searchsorted(begins[by_place], at, side="right") - 1]
    earliest = np.full(int(group.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(earliest, group, smallest[holder])
    whole = np.flatnonzero(several)
    segment = np.concatenate([holder, whole])
    offset = np.concatenate([at - begins[holder], np.zeros(len(whole), np.int64)])
    size = np.concatenate([size, length[sample[whole]]])
    earliest = np.concatenate([earliest[group], smallest[whole]])
    if groups:
        at = begins[segment] + offset
        earliest = hasher.spans(prefix, at, at + size).view(np.int64)
    # Back to the segments as they came in.
    order = np.argsort(segment, kind="stable")
    segment, offset, size, earliest = segment[order], offset[order], size[order], earliest[order]
    low, high = np.searchsorted(segment, same), np.searchsorted(segment, same, side="right")
    pick, back = expand(low, high - low), np.repeat(np.arange(len(same)), high - low)
    if not groups:
        useful = earliest[pick] < most[back]
        pick, back = pick[useful], back[useful]
    return rows[back], offset[pick], size[pick], earliest[pick]


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = _hashers()
        for batch in batches:
            for row in range(batch.num_rows):
                _, ids, lengths, packed, blobs, covers = (c[row].as_py() for c in batch.columns)
                chunk = _Chunk(ids, lengths, packed)
                gone = np.zeros(len(chunk.data), bool)
                if blobs and covers:
                    distinct = _Distinct(chunk, blobs, width, hashers)
                    parts = [unpack(c, np.int32, np.int32, np.int32, np.int64) for c in covers]
                    number = np.concatenate([np.cumsum(p[0], dtype=np.int32) for p in parts])
                    at, size, first = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
                    order = np.argsort(number, kind="stable")
                    number, at, size, first = number[order], at[order], size[order], first[order]
                    low = np.searchsorted(number, distinct.number)
                    count = np.searchsorted(number, distinct.number, side="right") - low
                    pick, segment = expand(low, count), np.repeat(np.arange(len(low)), count)
                    smaller = first[pick] < chunk.ids[distinct.text[segment]]
                    pick, segment = pick[smaller], segment[smaller]
                    begin = distinct.start[segment] + at[pick]
                    change = np.bincount(begin, minlength=len(gone) + 1)
                    change -= np.bincount(begin + size[pick], minlength=len(gone) + 1)
                    gone = np.cumsum(change[:-1]) > 0
                spans, kept = [], []
                for a, b in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist()):
                    own = gone[a:b]
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0]))))
                    spans.append([{"start": s, "end": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())])
                    kept.append(chunk.data[a:b][~own].tobytes())
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                columns = [
                    pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())
                ]
                yield pa.record_batch(columns, ["doc_id", "n_bytes", "spans", "kept"])

    return run


def _occurrences(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = _hashers()
        for batch in batches:
            for row in range(batch.num_rows):
                _, ids, lengths, packed, blobs, found = (c[row].as_py() for c in batch.columns)
                chunk = _Chunk(ids, lengths, packed)
                distinct = _Distinct(chunk, blobs, width, hashers)
                parts = [unpack(c, np.int32, np.int32, np.int32, np.int64) for c in found]
                number = np.concatenate([np.cumsum(p[0], dtype=np.int32) for p in parts])
                at, size, group = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
                order = np.argsort(number, kind="stable")
                number, at, size, group = number[order], at[order], size[order], group[order]
                low = np.searchsorted(number, distinct.number)
                count = np.searchsorted(number, distinct.number, side="right") - low
                pick, segment = expand(low, count), np.repeat(np.arange(len(low)), count)
                text = distinct.text[segment]
                start = distinct.start[segment] + at[pick] - chunk.bounds[text]
                columns = (group[pick], size[pick].astype(np.int64), chunk.ids[text], start)
                yield pa.record_batch([pa.array(c) for c in columns], ["group", "length", "doc_id", "start"])

    return run


def _found(df: DataFrame, width: int, listed: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chunks of texts, the repeated anchors of each, and what was found for its segments."""
    documents = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "chunk bigint, ids array<bigint>, lengths array<bigint>, packed binary"
    chunks = stage(documents.mapInArrow(_chunks(width), schema), "text-chunks")
    total = chunks.agg(F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")).alias("n")).first()["n"] or 0
    groups = max(16, -(-total // GROUP_BYTES))
    blobs = "part bigint, chunk bigint, blob binary"
    # The same rows for all joins, so that they share one exchange of the texts.
    chunks = chunks.where("chunk IS NOT NULL")
    anchors = chunks.mapInArrow(_anchors(width, groups), blobs)
    repeated = anchors.groupBy("part").applyInArrow(_repeated_anchors, "chunk bigint, blob binary")
    repeated = repeated.groupBy("chunk").agg(F.sort_array(F.collect_list("blob")).alias("anchors"))
    repeated = stage(repeated, "repeated-anchors")
    segments = chunks.join(repeated, "chunk").mapInArrow(_segments(width, groups), blobs)
    found = segments.groupBy("part").applyInArrow(_repeats(width, listed), "chunk bigint, blob binary")
    return chunks, repeated, found.groupBy("chunk").agg(F.collect_list("blob").alias("covers"))


def repeat_groups(df: DataFrame, width: int = WIDTH) -> DataFrame:
    """group, length, doc_id and start (in bytes) of every occurrence of every maximal repeat.

    ``group`` is a hash of the string. Groups are maximal within their segments. Rows are taken
    as in :func:`remove_repeats`.
    """
    chunks, repeated, found = _found(df, width, listed=True)
    held = chunks.join(repeated, "chunk").join(found, "chunk")
    return held.mapInArrow(_occurrences(width), "group bigint, length bigint, doc_id bigint, start bigint")


def remove_repeats(df: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, spans (start, end of the bytes removed) and kept (the other bytes) of every row.

    A byte goes when a string of ``width`` bytes around it also starts in a document with a
    smaller doc_id. doc_id must be an integer. Rows with the same doc_id are one document and
    do not repeat each other; a row without one is compared with none and keeps all bytes. A null
    text is empty. Other columns are not read. No rows give no rows.
    """
    chunks, repeated, found = _found(df, width, listed=False)
    judged = chunks.join(repeated, "chunk", "left").join(found, "chunk", "left")
    spans = "array<struct<start: bigint, end: bigint>>"
    return judged.mapInArrow(_cut(width), f"doc_id bigint, n_bytes bigint, spans {spans}, kept binary")


def repeats_digest(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the bytes kept."""
    return remove_repeats(df).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
