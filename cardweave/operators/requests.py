"""Save requests: the outgoing record, its JSON body, and the ways to save it.

Each saver takes the tokenised messages and a boolean ``active`` column, and adds
``save_ok``: not true on an active row means that saving failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardweave import schemas as S
from cardweave.functions.fields import amount_json
from cardweave.functions.plan import lookup_join
from cardweave.operators.service import Client, RetryPolicy, call_service, call_service_once, journalled
from cardweave.storage import delete, stage

Saver = Callable[[DataFrame, Column], DataFrame]


def request_fields() -> dict[str, Column]:
    columns = [
        F.col("message_type"),
        F.col("transaction_id"),
        F.col("tokenised_pan"),
        F.col("amount"),
        F.col("currency_code"),
        F.col("response_code"),
        F.col("timestamp_text"),
    ]
    return dict(zip(S.REQUEST_FIELDS, columns, strict=True))


def request_json() -> Column:
    """JSON body with all seven fields, nulls included, and the amount as sent."""
    fields = request_fields()
    text = {"ignoreNullFields": "false"}
    before, after = S.REQUEST_FIELDS[:3], S.REQUEST_FIELDS[4:]
    head = F.to_json(F.struct(*[fields[n].alias(n) for n in before]), text)
    tail = F.to_json(F.struct(*[fields[n].alias(n) for n in after]), text)
    number = F.coalesce(amount_json(F.col("amount_text")), F.lit("null"))
    return F.concat(
        head.substr(F.lit(1), F.length(head) - 1),
        F.lit(',"amount":'),
        number,
        F.lit(","),
        tail.substr(F.lit(2), F.length(tail)),
    )


def to_save_request(tokenised: DataFrame, *more: str) -> DataFrame:
    """Record id, the seven request fields, and the amount as sent; the PAN and the record type stay behind.

    ``more`` names columns to keep as they are. ``amount`` is null or rounded where ``amount_inexact`` says so; ``amountText`` is always exact.
    """
    return tokenised.select(
        *S.RECORD_ID,
        *[c.alias(n) for n, c in request_fields().items()],
        amount_json(F.col("amount_text")).alias("amountText"),
        *more,
    )


def save_accepted() -> Saver:
    """For a table sink: the rows are saved when the batch that holds them is written."""

    def apply(tokenised: DataFrame, active: Column) -> DataFrame:
        return tokenised.withColumn("save_ok", active)

    return apply


def save_service(factory: Callable[[], Client], policy: RetryPolicy | None = None) -> Saver:
    """Send each active request to a service, once; staged, so later readers call nothing.

    Also adds ``save_attempts`` and ``save_error``.
    """

    def apply(tokenised: DataFrame, active: Column) -> DataFrame:
        called = tokenised.withColumn("_active", active)
        body = F.when(F.col("_active"), request_json())
        called = stage(called.withColumn("_call", call_service(body, factory, policy)), "saved")
        return called.withColumns(
            {
                "save_ok": F.col("_active") & F.col("_call.error").isNull(),
                "save_attempts": F.col("_call.attempts"),
                "save_error": F.col("_call.error"),
            }
        ).drop("_active", "_call")

    return apply


@dataclass(frozen=True)
class Outbox:
    """A saver that sends each request of a batch once, also when the batch is cut short and run again.

    Calls that went through are journalled under ``folder`` while the batch is running, a folder for each
    batch; a replay takes their answers from there. A request carries its record's id as its key. The last
    calls of a task, at most ``every``, may have been made without being journalled; a service that
    heeds the key does nothing twice.
    """

    factory: Callable[[], Client]
    folder: str
    policy: RetryPolicy | None = None
    every: int = 200
    batch_id: int = 0

    def for_batch(self, batch_id: int) -> Outbox:
        return replace(self, batch_id=batch_id)

    def _journal(self, batch_id: int) -> str:
        return f"{self.folder.rstrip('/')}/{batch_id}"

    def forget(self, spark: SparkSession, batch_id: int) -> None:
        """Delete the journal of a batch that will not run again."""
        delete(spark, self._journal(batch_id))

    def __call__(self, tokenised: DataFrame, active: Column) -> DataFrame:
        journal = self._journal(self.batch_id)
        key = F.concat_ws("/", *[F.col(c).cast("string") for c in S.RECORD_ID])
        called = tokenised.withColumns({"_active": active, "_key": F.when(active, key)})
        known = stage(journalled(tokenised.sparkSession, journal), "journal").select(
            F.col("key").alias("_key"), F.col("response").alias("_response"), F.col("attempts").alias("_attempts"), F.lit(True).alias("_sent")
        )
        joined = lookup_join(called, known, ["_key"], S.RECORD_ID)
        body = F.when(F.col("_active") & F.col("_sent").isNull(), request_json())
        call = call_service_once(body, F.col("_key"), self.factory, journal, self.policy, self.every)
        done = stage(joined.withColumn("_call", call), "saved")
        sent = F.col("_sent").isNotNull()
        return done.withColumns(
            {
                "save_ok": F.col("_active") & (sent | F.col("_call.error").isNull()),
                "save_attempts": F.when(sent, F.col("_attempts")).otherwise(F.col("_call.attempts")),
                "save_error": F.col("_call.error"),
            }
        ).drop("_active", "_key", "_sent", "_response", "_attempts", "_call")
