"""The continuous job: feed in, outcomes, saved requests, ledger and metrics out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardweave.operators.intervals import acked_ranges, merge_ranges
from cardweave.operators.ledger import at_risk, offset_ledger
from cardweave.operators.metrics import outcome_metrics
from cardweave.operators.outcome import Decoder, prepare, settle
from cardweave.operators.redelivery import retry_queue, with_pending
from cardweave.operators.requests import Saver
from cardweave.operators.tokenise import Tokeniser
from cardweave.schemas import LEDGER, OUTCOME, RANGES, RECORD_ID, Reason, Result
from cardweave.sinks.keyed import KeyedTable
from cardweave.sinks.store import LAST_TABLE, Store
from cardweave.storage import staging
from cardweave.streaming.due import RetrySchedule, settle_due_batch
from cardweave.streaming.live import write_observed
from cardweave.streaming.tables import forget_calls, saver_of, stored_form, write_transactions


def merge_ledger(previous: DataFrame | None, outcomes: DataFrame) -> DataFrame:
    """Ledger after a batch: one row per topic partition, from the last ledger and the batch.

    All open records are in the batch, since pending ones are settled in every batch.
    """
    now = offset_ledger(outcomes)
    if previous is None:
        merged = now
    else:
        older = previous.select("topic", "partition", "committed", F.lit(None).cast("bigint").alias("first_unacked"))
        merged = (
            now.select("topic", "partition", "committed", "first_unacked")
            .unionByName(older)
            .groupBy("topic", "partition")
            .agg(F.max("committed").alias("committed"), F.min("first_unacked").alias("first_unacked"))
        )
    return merged.select(
        "topic",
        "partition",
        "committed",
        "first_unacked",
        F.coalesce("first_unacked", "committed").alias("safe_position"),
    )


def merge_acked(store: Store, batch_id: int, outcomes: DataFrame) -> DataFrame:
    """All settled offsets as intervals: those after the batch before, and those of this one."""
    now = acked_ranges(outcomes)
    return merge_ranges(now.unionByName(store.batch("acked", batch_id - 1, RANGES))) if batch_id > 0 else now


def settle_batch(
    store: Store,
    feed: DataFrame,
    batch_id: int,
    tokeniser: Tokeniser,
    saver: Saver | None = None,
    decoder: Decoder | None = None,
    saved: KeyedTable | None = None,
) -> None:
    """One micro-batch. Running it again with the same id leaves the same tables.

    With ``saved`` the requests that went through are merged into that table, by record, instead
    of written for the batch: also another batch or checkpoint then adds no record twice. Outcomes are written first, in one pass over the batch; the other tables read the
    written outcomes. The records to retry are thus durable before the batch counts as
    done, and the next batch takes them from there.
    """
    with staging():
        work = prepare(feed, decoder)
        previous = None
        if batch_id > 0:
            work = with_pending(work, retry_queue(store.batch("outcomes", batch_id - 1, OUTCOME)))
            previous = store.batch("ledger", batch_id - 1, LEDGER)
        settled = settle(work, tokeniser, saver_of(saver, batch_id))
        outcomes = write_observed(store, "outcomes", batch_id, stored_form(settled))

    write_transactions(store, batch_id, outcomes, saved)
    ledger = store.write("ledger", batch_id, merge_ledger(previous, outcomes))
    store.write("acked", batch_id, merge_acked(store, batch_id, outcomes))
    risk = at_risk(outcomes, ledger).select(*RECORD_ID, "transaction_id", "reason", "attempts")
    store.write("at_risk", batch_id, risk)
    store.write(LAST_TABLE, batch_id, outcome_metrics(outcomes))
    forget_calls(store, saver, batch_id - 1)


def with_ticks(feed: DataFrame) -> DataFrame:
    """The same feed, with a micro-batch every trigger even when no record arrives."""
    ticks = feed.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    nothing = ticks.filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in feed.schema])
    return feed.unionByName(nothing)


def run_stream(
    feed: DataFrame,
    root: str,
    checkpoint: str,
    tokeniser: Tokeniser,
    saver: Saver | None = None,
    decoder: Decoder | None = None,
    trigger: dict | None = None,
    schedule: RetrySchedule | None = None,
    saved: KeyedTable | None = None,
) -> StreamingQuery:
    """Start the job on a streaming feed; ``trigger`` defaults to what is available now.

    ``checkpoint`` plays the part of the consumer group, and ``root`` belongs to it.
    Records to retry come back with the next micro-batch, or by a ``schedule`` when they are due. Where the
    feed may fall silent, pass it through :func:`with_ticks` and give a ``processingTime`` trigger.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if schedule:
            store = Store(batch.sparkSession, root)
            settle_due_batch(store, batch, batch_id, tokeniser, saver, decoder, schedule, saved)
            return
        settle_batch(Store(batch.sparkSession, root), batch, batch_id, tokeniser, saver, decoder, saved)

    return (
        feed.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def final_outcomes(store: Store) -> DataFrame:
    """The last outcome of every record over all batches.

    A record to retry is settled again in the very next batch. So whatever is not to be
    retried is final, and what is still open is in the last batch: no grouping needed.
    """
    is_open = F.col("result") == Result.RETRY
    return store.table("outcomes").filter(~is_open | (F.col("batch_id") == store.latest()))


def quarantine(store: Store) -> DataFrame:
    """Records that could not be decrypted, with their envelopes, over all batches."""
    outcomes = store.table("outcomes")
    return outcomes.filter(F.col("reason") == Reason.DECRYPT_FAILED).select(*RECORD_ID, "value", "batch_id")
