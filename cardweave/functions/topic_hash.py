"""The partition of a topic that a record goes to, by its key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardweave.functions.plan import let

# The 32-bit hash by which producers deal keys (Murmur2), its seed, multiplier and shift.
_SEED, _MULTIPLIER, _SHIFT = 0x9747B28C, 0x5BD1E995, 24
_MASK = 0xFFFFFFFF


def _times(x: Column) -> Column:
    """``x`` times the multiplier, modulo 2^32, without leaving 64 bits."""
    low, high = _MULTIPLIER & 0xFFFF, _MULTIPLIER >> 16
    return (x * low + F.shiftleft((x * high).bitwiseAND(0xFFFF), 16)).bitwiseAND(_MASK)


def _mixed(x: Column, shift: int) -> Column:
    return x.bitwiseXOR(F.shiftright(x, shift))


def _little_endian(digits: Column, at: Column, size: int) -> Column:
    """``size`` bytes of a text of hexadecimal digits, from byte ``at`` (from 0), as a number."""
    pairs = [F.substr(digits, 2 * (at + i) + 1, F.lit(2)) for i in reversed(range(size))]
    return F.conv(F.concat(*pairs), 16, 10).cast("bigint")


def murmur2(key: Column) -> Column:
    """The hash of a binary or text ``key`` as a number from 0 to 2^32 - 1; null for null."""

    def hashed(digits: Column) -> Column:
        size = F.floor(F.length(digits) / 2).cast("bigint")
        words = F.floor(size / 4).cast("bigint")
        places = F.when(words > 0, F.sequence(F.lit(0).cast("bigint"), words - 1)).otherwise(F.array().cast("array<bigint>"))

        def step(state: Column, place: Column) -> Column:
            word = _times(_mixed(_times(_little_endian(digits, place * 4, 4)), _SHIFT))
            return _times(state).bitwiseXOR(word)

        state = F.aggregate(places, size.bitwiseXOR(F.lit(_SEED)), step)
        rest, left = words * 4, size % 4

        def ended(state: Column) -> Column:
            tail = F.when(left == 3, _little_endian(digits, rest, 3)).when(left == 2, _little_endian(digits, rest, 2))
            tail = tail.when(left == 1, _little_endian(digits, rest, 1))
            return F.when(left > 0, _times(state.bitwiseXOR(tail))).otherwise(state)

        return let(let(let(state, ended), lambda s: _times(_mixed(s, 13))), lambda s: _mixed(s, 15))

    return let(F.hex(key.cast("binary")), hashed)


def topic_partition(key: Column, partitions: int) -> Column:
    """The partition, of ``partitions``, that producers choose for a key; null without a key, which leaves the choice to them."""
    return (murmur2(key).bitwiseAND(0x7FFFFFFF) % partitions).cast("int")
