"""Classifying every record as success, skipped or retry."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave import schemas as S
from cardweave.functions.plan import pin
from cardweave.operators.codec import text_feed
from cardweave.operators.filters import is_actionable, is_ptlfx
from cardweave.operators.parse import COLUMNS, parse_feed
from cardweave.operators.requests import Saver, save_accepted
from cardweave.operators.tokenise import Tokeniser
from cardweave.schemas import Reason, Result

Decoder = Callable[[DataFrame], DataFrame]


def prepare(feed: DataFrame, decoder: Decoder | None = None, fields: Collection[str] | None = None) -> DataFrame:
    """Decode, parse and tag each record with the reason to skip it, if there is one.

    A skipped record keeps no message fields. One that could not be decrypted keeps its
    envelope in ``value``, to be set aside; all others drop it. With ``fields`` only those message columns and
    flags are there, and only they are typed; what is saved or brought back later needs all.
    """
    decoded = decoder(feed) if decoder else text_feed(feed)
    if "decrypt_failed" not in decoded.columns:
        decoded = decoded.withColumn("decrypt_failed", F.lit(False))
    kept = {"message_type", "record_type", "transaction_id"}
    wanted = [name for name in COLUMNS if fields is None or name in fields]
    parsed = parse_feed(decoded, None if fields is None else {*fields, "message_type", "record_type"})
    tagged = parsed.withColumn(
        "reason",
        F.when(F.col("decrypt_failed"), Reason.DECRYPT_FAILED)
        .when(~F.col("parsed"), Reason.MALFORMED)
        .when(~is_ptlfx(), Reason.NOT_PTLFX)
        .when(~is_actionable(), Reason.NOT_ACTIONABLE),
    )
    publishable = F.col("reason").isNull()
    always = {*kept, *S.FLAGS.fieldNames()}
    return tagged.select(
        *S.RECORD_ID,
        F.when(F.col("decrypt_failed"), F.col("value")).alias("value"),
        *[F.col(name) if name in always else F.when(publishable, F.col(name)).alias(name) for name in wanted],
        "reason",
        F.lit(0).alias("attempts"),
    )


def settle(prepared: DataFrame, tokeniser: Tokeniser, saver: Saver | None = None) -> DataFrame:
    """Tokenise and save what is publishable, then give every record its outcome.

    A record whose tokenising failed is not sent to the saver.
    """
    saver = saver or save_accepted()
    counted = prepared.withColumn(
        "attempts", F.when(F.col("reason").isNull(), F.col("attempts") + 1).otherwise(F.col("attempts"))
    )
    publishable = F.col("reason").isNull()
    tokenised = tokeniser(counted, publishable)
    to_save = publishable & F.col("tokenised_pan").isNotNull()
    saved = saver(tokenised, to_save)
    reason = (
        F.when(~publishable, F.col("reason"))
        .when(F.col("tokenised_pan").isNull(), Reason.TOKENISE_FAILED)
        .when(F.coalesce(F.col("save_ok"), F.lit(False)), Reason.OK)
        .otherwise(Reason.SAVE_FAILED)
    )
    result = (
        F.when(F.col("reason") == Reason.OK, Result.SUCCESS)
        .when(F.col("reason").isin(Reason.TOKENISE_FAILED, Reason.SAVE_FAILED), Result.RETRY)
        .otherwise(Result.SKIPPED)
    )
    # One evaluation of the reason, whatever filters and columns use the result.
    judged = pin(saved, "_reason", reason).drop("reason").withColumnRenamed("_reason", "reason")
    ordered = [c for c in saved.columns if c not in ("save_ok", "result")]
    return judged.withColumn("result", result).select(*ordered, "result")


def process(
    feed: DataFrame,
    tokeniser: Tokeniser,
    saver: Saver | None = None,
    decoder: Decoder | None = None,
    fields: Collection[str] | None = None,
) -> DataFrame:
    """The outcome of every record. ``fields`` names the message columns needed, by the tokeniser and saver too; all by default."""
    return settle(prepare(feed, decoder, fields), tokeniser, saver)


def quarantined(outcomes: DataFrame) -> DataFrame:
    """Records that could not be decrypted, with their envelopes."""
    return outcomes.filter(F.col("reason") == Reason.DECRYPT_FAILED).select(*S.RECORD_ID, "value")
