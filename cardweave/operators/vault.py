"""A token table prepared once, so that no batch has to reduce or shuffle it again.

It is written bucketed and sorted by card: one row for each card, every card in the bucket of its hash. A batch is
dealt by the same hash and meets it bucket by bucket; a small batch asks for its cards by name, and
only their buckets, and the row groups that can hold them, are read.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardweave.functions.plan import hot_keys
from cardweave.operators.tokenise import Tokeniser, one_token_per_pan
from cardweave.storage import stage

#: Cards up to which a batch asks by name.
NAMED_CARDS = 1_000


@dataclass(frozen=True)
class PreparedVault:
    """``table`` is its name in the session's catalog; ``folder`` and ``buckets`` open it in another session."""

    spark: SparkSession
    table: str
    folder: str
    buckets: int

    def read(self) -> DataFrame:
        return self.spark.table(self.table)


def prepare_vault(vault: DataFrame, folder: str, buckets: int | None = None) -> PreparedVault:
    """Reduce ``vault`` (digital_pan, tokenised_pan) to a token for each card and write it to ``folder``, which is new.

    The shuffle by card that the reduction needs is the one that deals the buckets.
    """
    spark = vault.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"vault_{uuid.uuid4().hex}"
    single = one_token_per_pan(vault.repartition(buckets, "digital_pan"))
    writer = single.write.format("parquet").option("path", folder)
    writer.bucketBy(buckets, "digital_pan").sortBy("digital_pan").saveAsTable(table)
    return PreparedVault(spark, table, folder, buckets)


def open_vault(spark: SparkSession, folder: str, buckets: int) -> PreparedVault:
    """A vault that another session prepared."""
    if not re.fullmatch(r"[^'\\]+", folder):
        raise ValueError("a folder without quotes and backslashes is needed")
    table = f"vault_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} (digital_pan STRING, tokenised_pan STRING) USING parquet "
        f"CLUSTERED BY (digital_pan) SORTED BY (digital_pan) INTO {int(buckets)} BUCKETS LOCATION '{folder}'"
    )
    return PreparedVault(spark, table, folder, buckets)


def tokenise_prepared(vault: PreparedVault, named_cards: int = NAMED_CARDS) -> Tokeniser:
    """Look tokens up in a prepared vault; no token is a failure.

    The messages are written down first, as their cards are looked at before the join. Cards that
    hold a two-hundredth of a batch or more are asked for by name, so the rows of such a card stay where they
    are, and records without a card meet nothing.
    """

    def apply(messages: DataFrame, active: Column) -> DataFrame:
        keyed = stage(messages.withColumn("_pan", F.when(active, F.col("digital_pan"))), "to-tokenise")
        tokens = vault.read().withColumnRenamed("digital_pan", "_pan")
        some = keyed.where("_pan IS NOT NULL").select("_pan").distinct().limit(named_cards + 1).collect()
        if len(some) <= named_cards:
            return _named(keyed, tokens, [r["_pan"] for r in some]).drop("_pan")
        hot = hot_keys(keyed, "_pan")
        by_name = F.col("_pan").isNull() | F.col("_pan").isin(hot)
        rest = keyed.where(~by_name).join(tokens.hint("merge"), "_pan", "left")
        return _named(keyed.where(by_name), tokens, hot).unionByName(rest).drop("_pan")

    return apply


def _named(keyed: DataFrame, tokens: DataFrame, cards: list[str]) -> DataFrame:
    """The tokens of a bounded list of cards: at most as many rows are broadcast."""
    found = tokens.where(F.col("_pan").isin(cards)) if cards else tokens.where(F.lit(False))
    return keyed.join(F.broadcast(found), "_pan", "left")
