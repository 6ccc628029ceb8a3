"""Token ids of whole texts, with each distinct word tokenised about once in a task.

A byte-level BPE never merges across the start of a white-space run that follows other text,
so a text can be cut there: the ids of the pieces, one after the other, are the ids of the
text. Pieces are found and looked up by numpy; only those the table does not hold are
given to the tokenizer. The table has a fixed size; a piece that loses its place is
tokenised again.
"""

from __future__ import annotations

import base64

import numpy as np

from cardweave.llm.kernel import SpanHasher, expand, space_table, word_spans

#: Fixed value: the pre-tokenisation of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the one added token, which the vocabulary finds in ordinary text too.
ADDED = {"<|endoftext|>": 50256}
#: White space outside ASCII, next to which texts are not cut.
WIDE_SPACES = "\x85\xa0                　"

#: The bytes that white space outside ASCII starts with.
_WIDE_LEADS = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
_SLOT_BITS = 21
_POOL_IDS = 6_000_000


class WordTokens:
    """``encode`` gives the ids of many texts at once. ``ranks`` is the path of the vocabulary."""

    #: With more than so many times ``_POOL_IDS`` ids in the pool the table is emptied.
    pools = 1

    def __init__(self, ranks: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokenizer = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens=ADDED)
        sizes = {**{rank: len(token) for token, rank in merges.items()}, **{i: len(t) for t, i in ADDED.items()}}
        self.sizes = np.array([sizes[i] for i in range(len(sizes))])
        self.hashers = SpanHasher(11), SpanHasher(12)
        self._reset()

    def _reset(self) -> None:
        # Both hashes of a piece, where in the pool its ids are, and how many: side by side, since they are read together.
        self.slots = np.zeros((1 << _SLOT_BITS, 4), np.uint64)
        self.pool, self.used = np.empty(1 << 16, np.uint32), 0

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces start and end: behind every word and at the bounds of texts."""
        _, ends = word_spans(data, bounds)
        cut = np.zeros(len(data) + 1, bool)
        cut[ends] = cut[bounds] = True
        cuts = np.flatnonzero(cut)
        if _WIDE_LEADS[data].any():
            raw = data.tobytes()
            keep = np.ones(len(cuts), bool)
            for space in WIDE_SPACES:
                coded = space.encode()
                at = raw.find(coded)
                while at >= 0:
                    # No cut where such a space ends, unless the text ends too.
                    i = np.searchsorted(cuts, at + len(coded))
                    if i < len(cuts) and cuts[i] == at + len(coded):
                        keep[i] = False
                    at = raw.find(coded, at + 1)
            keep |= np.isin(cuts, bounds)
            cuts = cuts[keep]
        return cuts

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts that lie in ``data`` between ``bounds``, and how many each text has."""
        if self.used > self.pools * _POOL_IDS:
            self._reset()
        cuts = self._cuts(data, bounds)
        starts, ends = cuts[:-1], cuts[1:]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(bounds) - 1, np.int64)
        first, second = (h.words(data, starts, ends) for h in self.hashers)
        slot = (first >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        known = self.slots.take(slot, axis=0)
        places, lengths = known[:, 2].astype(np.int64), known[:, 3].astype(np.int64)
        missed = np.flatnonzero((known[:, 0] != first) | (known[:, 1] != second) | (lengths == 0))
        if len(missed):
            _, where, which = np.unique(first[missed], return_index=True, return_inverse=True)
            new = missed[where]
            own_places, own_lengths = self._tokenise(data, starts[new], ends[new])
            places[missed], lengths[missed] = own_places[which], own_lengths[which]
            self.slots[slot[new]] = np.stack((first[new], second[new], own_places, own_lengths), axis=1, dtype=np.uint64, casting="unsafe")
        ids = self.pool[expand(places, lengths)]
        total = np.concatenate(([0], np.cumsum(lengths)))
        return ids, np.diff(total[np.searchsorted(cuts, bounds)])

    def _tokenise(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokenise pieces in one call; where in the pool their ids are, and how many.

        A piece that starts with no white space gets a line feed before it, whose id is left
        out again. One that ends in white space would run into the next; it goes alone, as do
        those that may start or end with white space outside ASCII.
        """
        space = space_table()
        wide = _WIDE_LEADS[data]
        alone = space[data[ends - 1]] | wide[starts] | wide[np.maximum(ends - 2, starts)] | wide[np.maximum(ends - 3, starts)]
        bare = (~space[data[starts]]).astype(np.int64)
        sizes = np.where(alone, 0, ends - starts + bare)
        text = data[np.maximum(expand(starts - bare, sizes), 0)]
        stops = np.cumsum(sizes)
        text[(stops - sizes)[(bare == 1) & ~alone]] = 10
        ids = self._ids_of_pieces(text.tobytes(), stops)
        reached = np.searchsorted(np.cumsum(self.sizes[ids]), stops, side="right")
        counts = np.diff(reached, prepend=0)
        places = self._store(ids) + reached - counts + bare
        counts -= bare
        for i in np.flatnonzero(alone).tolist():
            ids = self._ids(data[starts[i] : ends[i]].tobytes())
            places[i], counts[i] = self._store(ids), len(ids)
        return places, counts

    def _ids_of_pieces(self, raw: bytes, stops: np.ndarray) -> np.ndarray:
        """Ids of ``raw``, which may be cut at ``stops``."""
        return self._ids(raw)

    def _ids(self, raw: bytes) -> np.ndarray:
        text = raw.decode("utf-8")
        special = b"<|" in raw
        ids = self.tokenizer.encode(text, allowed_special="all") if special else self.tokenizer.encode_ordinary(text)
        return np.array(ids, np.uint32)

    def _store(self, ids: np.ndarray) -> int:
        place, need = self.used, self.used + len(ids)
        if need > len(self.pool):
            grown = np.empty(max(need, 2 * len(self.pool)), np.uint32)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[place:need] = ids
        self.used = need
        return place
