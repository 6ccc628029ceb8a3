"""Replacing card numbers by tokens: a local rule, a token table, or a service.

Each tokeniser takes the messages and a boolean ``active`` column, and adds
``tokenised_pan``: null on an active row means that tokenising failed.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardweave import schemas as S
from cardweave.functions.plan import BROADCAST_BYTES, fits_broadcast, lookup_join
from cardweave.functions.text import last_four
from cardweave.operators.service import Client, RetryPolicy, call_service
from cardweave.storage import stage

Tokeniser = Callable[[DataFrame, Column], DataFrame]

# Fixed values of the local rule.
LOCAL_PREFIX = "TOK-STUB-"
NO_DIGITS = "0000"


def local_token(pan: Column) -> Column:
    return F.concat(F.lit(LOCAL_PREFIX), F.when(F.length(pan) >= 4, last_four(pan)).otherwise(NO_DIGITS))


def tokenise_local() -> Tokeniser:
    def apply(messages: DataFrame, active: Column) -> DataFrame:
        return messages.withColumn("tokenised_pan", F.when(active, local_token(F.col("digital_pan"))))

    return apply


def one_token_per_pan(vault: DataFrame) -> DataFrame:
    """The smallest token of each PAN, so that a repeated vault row repeats no message."""
    return (
        vault.filter("digital_pan IS NOT NULL AND tokenised_pan IS NOT NULL")
        .groupBy("digital_pan")
        .agg(F.min("tokenised_pan").alias("tokenised_pan"))
    )


def tokenise_vault(
    vault: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, salts: int = 16, small_batches: bool = False
) -> Tokeniser:
    """Look tokens up in a table ``(digital_pan, tokenised_pan)``; no token is a failure.

    ``small_batches`` suits a stream whose batches hold few cards next to a large vault:
    the vault is first narrowed to the cards of the batch, without shuffling it.
    """
    vault = vault.select("digital_pan", "tokenised_pan")

    def apply(messages: DataFrame, active: Column) -> DataFrame:
        keyed = messages.withColumn("_pan", F.when(active, F.col("digital_pan")))
        known = vault
        large = not fits_broadcast(vault, broadcast_bytes)
        if large:  # the hot cards are looked for first, so the messages are read twice
            keyed = stage(keyed, "to-tokenise")
        if small_batches and large:
            known = _narrowed(vault, keyed.select(F.col("_pan").alias("digital_pan")).distinct(), broadcast_bytes)
        tokens = one_token_per_pan(known).withColumnRenamed("digital_pan", "_pan")
        if not large:
            return lookup_join(keyed, tokens, ["_pan"], S.RECORD_ID, broadcast_bytes, salts, measured=known).drop("_pan")
        # Records without a card to look up, most of a feed, are neither shuffled nor sorted.
        asked = lookup_join(keyed.where("_pan IS NOT NULL"), tokens, ["_pan"], S.RECORD_ID, broadcast_bytes, salts, measured=known)
        others = keyed.where("_pan IS NULL").withColumn("tokenised_pan", F.lit(None).cast("string"))
        return asked.unionByName(others).drop("_pan")

    return apply


def _narrowed(vault: DataFrame, pans: DataFrame, broadcast_bytes: int) -> DataFrame:
    """The vault rows of ``pans``, written down, if those can be broadcast; else the whole vault."""
    if not fits_broadcast(pans, broadcast_bytes):
        return vault
    return stage(vault.join(F.broadcast(pans), "digital_pan", "left_semi"), "vault-part")


def _token_client(factory: Callable[[], Client]) -> Callable[[], Client]:
    def wrapped() -> Client:
        client = factory()

        def tokenise(body: str) -> str:
            response = client(body)
            token = json.loads(response).get("tokenisedPan") if response else None
            if token is None:
                raise ValueError("the service returned no token")
            return token

        return tokenise

    return wrapped


def tokenise_service(
    factory: Callable[[], Client],
    policy: RetryPolicy | None = None,
    parallelism: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = 16,
) -> Tokeniser:
    """Ask a service for the token of each distinct PAN, then look the answers up.

    The messages are staged first, so parsing runs once, and the answers are staged, so
    each PAN is asked for once. ``parallelism`` tasks call the service at a time, by
    default as many as there are shuffle partitions: PANs are small, and AQE would
    otherwise merge them into few tasks. Also adds ``token_attempts`` and ``token_error``.
    """

    def apply(messages: DataFrame, active: Column) -> DataFrame:
        spark = messages.sparkSession
        tasks = parallelism or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # An absent PAN is asked for as well, so it gets a key of its own.
        key = F.when(active, F.coalesce(F.concat(F.lit("="), F.col("digital_pan")), F.lit("absent")))
        keyed = stage(messages.withColumn("_pan", key), "to-tokenise")
        pans = keyed.filter("_pan IS NOT NULL").select("_pan").distinct().repartition(tasks)
        pan = F.when(F.col("_pan") != "absent", F.col("_pan").substr(F.lit(2), F.length("_pan")))
        body = F.to_json(F.struct(pan.alias("digitalPan")), {"ignoreNullFields": "false"})
        answers = stage(pans.withColumn("_call", call_service(body, _token_client(factory), policy)), "tokens")
        tokens = answers.select(
            "_pan",
            F.col("_call.response").alias("tokenised_pan"),
            F.col("_call.attempts").alias("token_attempts"),
            F.col("_call.error").alias("token_error"),
        )
        return lookup_join(keyed, tokens, ["_pan"], S.RECORD_ID, broadcast_bytes, salts).drop("_pan")

    return apply
