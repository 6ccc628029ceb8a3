"""Rolling failure rate of calls that keep coming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardweave.operators.health import FAILURE_THRESHOLD, WINDOW_CALLS, continued_health
from cardweave.sinks.store import Store
from cardweave.storage import staging


def health_batch(
    store: Store,
    calls: DataFrame,
    batch_id: int,
    service: Column,
    order: list[str],
    failed: Column,
    window_calls: int = WINDOW_CALLS,
    threshold: float = FAILURE_THRESHOLD,
) -> None:
    """Health at every call of a micro-batch, as table ``health``; the last calls of each service go on to the next.

    What is carried is a table of a few rows for each service. So a service that owns most of the log is still windowed in
    slices, by all tasks. Running a batch again leaves the same tables.
    """
    named = calls.select(service.alias("service"), *order, failed.cast("int").alias("_failed"))
    tail = store.batch("tails", batch_id - 1, named.schema) if batch_id > 0 else named.limit(0)
    with staging():
        judged, last = continued_health(
            tail, named, F.col("service"), order, F.col("_failed"), window_calls, threshold
        )
        store.write("tails", batch_id, last.coalesce(1))
        store.write("health", batch_id, judged)
    if batch_id > 1:
        store.drop("tails", batch_id - 2)


def watch_health(
    calls: DataFrame,
    root: str,
    checkpoint: str,
    service: Column,
    order: list[str],
    failed: Column,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start :func:`health_batch` on a streaming log of calls, whose batches must follow each other in ``order``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        health_batch(Store(batch.sparkSession, root), batch, batch_id, service, order, failed, **options)

    query = calls.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).start()
