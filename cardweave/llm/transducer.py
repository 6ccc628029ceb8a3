"""Minimal acyclic transducers: sorted terms to their ordinals, and back.

A transducer is built from terms in ascending order of their bytes. States with the same future are one
state, so common beginnings and common endings are stored once. Every arc carries how many terms
come before those that go through it, among the terms that come this far; the outputs along a
term's path add up to its number in the order, and a number finds its path back.

For use by numpy a state has 256 bits, one for each byte it has an arc for: the number of bits below a
byte says which of the state's arcs it is. All words of a text take a step at once.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_ONE = np.uint64(1)


def build(terms: Iterable[bytes]) -> bytes:
    """The transducer of ascending, distinct terms as bytes, for :class:`Transducer`."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    # What the last term went through: whether a term ends there, and the arcs so far.
    finals, arcs, last = [False], [[]], b""

    def close(depth: int) -> None:
        """States of the last term below ``depth`` have got all their arcs: each is found again or new."""
        for d in range(len(finals) - 1, depth, -1):
            key = finals.pop(), tuple(arcs.pop())
            if key not in register:
                register[key] = len(states)
                states.append(key)
            arcs[d - 1].append((last[d - 1], register[key]))

    for term in terms:
        if term <= last and (last or finals[0]):
            raise ValueError("terms must ascend")
        shared, most = 0, min(len(term), len(last))
        while shared < most and term[shared] == last[shared]:
            shared += 1
        close(shared)
        for _ in range(len(term) - shared):
            finals.append(False)
            arcs.append([])
        finals[-1], last = True, term
    close(0)
    states.append((finals[0], tuple(arcs[0])))

    counts = np.zeros(len(states), np.int64)
    bits, firsts = np.zeros((len(states), 4), np.uint64), np.zeros((len(states), 4), np.uint32)
    targets, outputs = [], []
    for state, (final, own) in enumerate(states):  # targets come before the states that lead to them
        passed = int(final)
        words = [0, 0, 0, 0]
        starts = [len(targets)] * 4
        for byte, target in own:
            words[byte >> 6] |= 1 << (byte & 63)
            for w in range((byte >> 6) + 1, 4):
                starts[w] += 1
            targets.append(target)
            outputs.append(passed)
            passed += int(counts[target])
        bits[state], firsts[state], counts[state] = words, starts, passed
    sizes = np.array([len(states), len(targets)], "<u8")
    parts = [
        sizes,
        bits.astype("<u8"),
        np.array(outputs, "<u8"),
        firsts.astype("<u4"),
        np.array(targets, "<u4"),
        np.array([final for final, _ in states], np.uint8),
    ]
    return b"".join(p.tobytes() for p in parts)


class Transducer:
    """Lookups in what :func:`build` made."""

    def __init__(self, content: bytes):
        states, arcs = np.frombuffer(content, "<u8", 2).astype(int).tolist()
        at = 16

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        self.bits, self.outputs = take("<u8", 4 * states), take("<u8", arcs).astype(np.int64)
        self.firsts, self.targets = take("<u4", 4 * states), take("<u4", arcs)
        self.final = take("u1", states).view(bool)
        self.root = states - 1

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinals of the spans of ``data``; -1 for what is no term."""
        out = np.full(len(starts), -1, np.int64)
        word = np.arange(len(starts))
        at, stop = np.asarray(starts).copy(), np.asarray(ends)
        state, total = np.full(len(starts), self.root, np.int64), np.zeros(len(starts), np.int64)
        while len(word):
            ended = at == stop
            if ended.any():
                whole = ended & self.final[state]
                out[word[whole]] = total[whole]
                on = ~ended
                word, at, stop, state, total = word[on], at[on], stop[on], state[on], total[on]
            byte = data[at]
            place = state * 4 + (byte >> 6)
            bits, shift = self.bits[place], (byte & 63).astype(np.uint64)
            on = (bits >> shift & _ONE).astype(bool)
            if not on.all():
                word, at, stop, total = word[on], at[on], stop[on], total[on]
                place, bits, shift = place[on], bits[on], shift[on]
            arc = self.firsts[place].astype(np.int64) + np.bitwise_count(bits & ((_ONE << shift) - _ONE))
            total = total + self.outputs[arc]
            state, at = self.targets[arc].astype(np.int64), at + 1
        return out

    def term(self, ordinal: int) -> bytes:
        """The term with this ordinal, which must be one."""
        state, left, out = self.root, ordinal, bytearray()
        while left or not self.final[state]:
            words = self.bits[4 * state : 4 * state + 4]
            own = [64 * w + b for w in range(4) for b in range(64) if int(words[w]) >> b & 1]
            first = int(self.firsts[4 * state])
            choice = int(np.searchsorted(self.outputs[first : first + len(own)], left, side="right")) - 1
            left -= int(self.outputs[first + choice])
            state = int(self.targets[first + choice])
            out.append(own[choice])
        return bytes(out)
