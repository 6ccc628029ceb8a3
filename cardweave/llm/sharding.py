"""Sharding by rendezvous hashing: DataFrame functions only.

A record's key and each shard's name give a number in (0, 1) from a hash, and a weight w
turns it into the score -w / ln(number). The highest score wins. A shard that is added
wins some records from all others and moves none between them; one that is removed gives
its records away and moves no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardweave.llm.ranks import numbered

_HEX_DIGITS = 13
_RANGE = float(16**_HEX_DIGITS)


def _score(key: Column, shard: int, weight: float) -> Column:
    """-w / ln(u) of one shard, u from the first 52 bits of a hash of key and shard."""
    digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), F.lit(str(shard))).cast("binary"))
    number = F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double")
    return F.lit(-float(weight)) / F.log((number + 0.5) / _RANGE)


def rendezvous(key: Column, weights: dict[int, float] | list[float]) -> Column:
    """The shard of ``key``; equal scores go to the higher shard number.

    A null key counts as the empty text. A weight of 0 or less takes its shard out.
    """
    pairs = weights.items() if isinstance(weights, dict) else enumerate(weights)
    scored = [F.struct(_score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in pairs if w > 0]
    if not scored:
        raise ValueError("no shard has a weight")
    return F.array_max(F.array(*scored))["shard"]


def shard_documents(df: DataFrame, shards: int = 8, weights: list[float] | None = None) -> DataFrame:
    """Every row of ``documents`` with its shard, its place there and its shard were there one more.

    Returns doc_id, size (bytes of the text plus 1), text_crc32, law, shard, slot, grown_shard.
    A null text has size 1 and the checksum of the empty text. Rows with the same doc_id,
    repeated rows too, go to the same shard and get places of their own. Columns other than
    doc_id and text are neither read nor returned. No rows give no rows.
    """
    weights = weights or [1.0] * shards
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, 1.0]).alias("grown_shard"),
    )
    placed = numbered(rows, ["shard"], F.struct("doc_id", "text_crc32"), "slot", df.count(), ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
