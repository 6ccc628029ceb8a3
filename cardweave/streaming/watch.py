"""Watching a folder for new and rewritten files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cardweave.sinks.store import Store
from cardweave.sources.folder import SETTLE_SECONDS, changed_files, list_folder, read_listed, settled, watch_files

Publish = Callable[[DataFrame], None]


def poll_folder(
    store: Store, folder: str, poll: int, publish: Publish, settle_seconds: float = SETTLE_SECONDS, **options
) -> None:
    """Publish the files that are new, or were modified, since the poll before.

    A file still being written is left for the next poll. The records are written down
    before they are published, and the files count as seen after that: a poll that fails
    half-way publishes again when it is repeated, and loses nothing.
    """
    files = settled(list_folder(store.spark, folder), settle_seconds)
    seen = None
    if poll > 0:
        seen = store.batch("seen", poll - 1)
        files = changed_files(files, seen)
    # Only what is new is read.
    records = store.write("published", poll, read_listed(files, folder, **options))
    publish(records)
    now_seen = records.select("path", "modified")
    if seen is not None:
        # The time a file was last seen with, which may be older than the one before.
        now_seen = now_seen.unionByName(seen.join(now_seen.select("path"), "path", "left_anti").select("path", "modified"))
    store.write("seen", poll, now_seen)
    if poll > 1:
        for table in ("published", "seen"):
            store.drop(table, poll - 2)


def watch_changes(
    store: Store, folder: str, checkpoint: str, publish: Publish, every: str | None = "1 second", **options
) -> StreamingQuery:
    """Publish the files present, then each that is new or was written again, as a query that goes on.

    The records of a batch are written down before they are published: a batch that is replayed publishes
    the same ones. ``every=None`` stops when all there is now is published.
    """
    files = watch_files(store.spark, folder, f"{checkpoint.rstrip('/')}/watched", **options)

    def on_batch(records: DataFrame, batch_id: int) -> None:
        publish(store.write("published", batch_id, records))
        if batch_id > 0:
            store.drop("published", batch_id - 1)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return files.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
