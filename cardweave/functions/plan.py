"""Small helpers that shape the plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add ``column`` so that it is computed exactly once per row.

    Catalyst copies an expression into every projection and filter that uses it.
    It does not collapse through a generator, so an exploded one-element array
    holds the value in place.
    """
    return df.select("*", F.explode_outer(F.array(column)).alias(name))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once although ``body`` uses it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 64


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` (one aggregate, no shuffle of rows) against ``limit`` bytes."""
    width = F.lit(_ROW_OVERHEAD)
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    size = df.agg(F.sum(width.cast("bigint")).alias("size")).first()["size"]
    return (size or 0) <= limit


#: A key is hot with this share of the rows, so there are at most so many.
_HOT_SHARE, _HOT_KEYS = 1 / 200, 200


def hot_keys(df: DataFrame, key: str) -> list[str]:
    """Keys that hold a two-hundredth of the rows or more, by a sketch of bounded size over all rows."""
    found = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {_HOT_KEYS}, {50 * _HOT_KEYS})").alias("top"), F.count("*").alias("rows")
    )
    row = found.first()
    return [x["item"] for x in row["top"] or [] if x["count"] >= _HOT_SHARE * row["rows"]]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    row_id: list[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = 16,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Left join to ``right``, which holds one row per key and may be any size.

    ``measured`` is what is measured in its place, where something cheaper to read is
    at least as large. A right side measured below ``broadcast_bytes`` is broadcast: ``left`` is not
    shuffled. Beyond it both sides are hashed on (key, salt). A sketch of ``left`` finds the hot
    keys, at most ``_HOT_KEYS``; their right rows are repeated once per salt and each of their
    left rows picks a salt from ``row_id``, so a hot key is spread over ``salts`` tasks (and
    AQE can split those further, since both inputs are plain exchanges). All others have one salt. The merge hint keeps Spark from broadcasting the
    repeated side on an estimate. Rows with a null key match nothing and are spread
    evenly.
    """
    if fits_broadcast(right if measured is None else measured, broadcast_bytes):
        return left.join(F.broadcast(right), on, "left")
    row_hash, hot = F.xxhash64(*row_id), F.col(on[0]).isin(hot_keys(left, on[0]))
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | F.col(name).isNull()
    salt = F.when(no_key, row_hash).when(hot, F.pmod(row_hash, F.lit(salts))).otherwise(0)
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(hot, salts - 1).otherwise(0))))
    return (
        left.withColumn("_salt", salt)
        .join(salted.withColumn("_salt", F.col("_salt").cast("bigint")).hint("merge"), [*on, "_salt"], "left")
        .drop("_salt")
    )


def without(left: DataFrame, right: DataFrame, on: list[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``left`` whose unique key is not in ``right``."""
    keys = right.select(*on)
    if fits_broadcast(keys, broadcast_bytes):
        keys = F.broadcast(keys)
    return left.join(keys, on, "left_anti")
