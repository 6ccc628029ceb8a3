"""The registered queries: every job, run over whole tables."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardweave import schemas as S
from cardweave.functions.envelope import PREFIX
from cardweave.operators import codec, filters, health, intervals, ledger, metrics, outcome, parse, redelivery, requests, tokenise
from cardweave.operators import vault as vaults
from cardweave.operators.service import Client, RetryPolicy
from cardweave.plans import feed as feeds
from cardweave.sinks.keyed import KeyedTable
from cardweave.sinks.store import Store
from cardweave.sinks.topic import ordered_records, publish_records
from cardweave.sources import resume
from cardweave.sources.folder import changed_files, read_folder, watch_folder
from cardweave.sources.topic import from_records
from cardweave.storage import fresh_path, stage
from cardweave.streaming import due, live, run
from cardweave.streaming.health import watch_health
from cardweave.streaming.watch import poll_folder, watch_changes

KEY = feeds.KEY_TEXT.encode()
RECORD = ["partition", "offset"]
Query = Callable[[SparkSession, str], DataFrame]


def _money(amount: str) -> Column:
    """Amounts leave the queries as doubles, rounded to cents before."""
    return F.col(amount).cast("decimal(18,2)").cast("double")


def _no_wait(_: float) -> None:
    return None


NO_WAIT = RetryPolicy(sleep=_no_wait)


def _messages(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Parsed messages with the columns that the query reads; all when none is named."""
    return parse.messages(parse.parse_feed(feeds.order_feed(spark, sf_dir), columns or None))


def _publishable(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    named = ("record_type", "message_type", *columns) if columns else ()
    return filters.filter_publishable(_messages(spark, sf_dir, *named))


def _vault(spark: SparkSession, sf_dir: str, **options) -> tokenise.Tokeniser:
    return tokenise.tokenise_vault(feeds.customer_vault(spark, sf_dir), **options)


def _rule_saver(tokenised: DataFrame, active: Column) -> DataFrame:
    """Orders divisible by 43 fail once, and twice if divisible by 86 as well."""
    k = feeds.order_key(F.col("transaction_id"))
    fails = F.when(k % 86 == 0, 2).when(k % 43 == 0, 1).otherwise(0)
    return tokenised.withColumn("save_ok", active & (F.col("attempts") > fails))


# What tokenising and the rule of the saver read.
_TO_SETTLE = ("message_type", "transaction_id", "digital_pan")


def _outcomes(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] | None = None) -> DataFrame:
    return outcome.process(feeds.order_feed(spark, sf_dir), _vault(spark, sf_dir), _rule_saver, fields=fields)


def _token_service() -> Client:
    """By the last three PAN digits n: n%5=0 never answers, n%3=0 answers at the second call."""
    calls: Counter[str] = Counter()

    def answer(body: str) -> str:
        pan = json.loads(body)["digitalPan"]
        calls[pan] += 1
        if pan is None:
            return "{}"
        n = int(pan[-3:])
        if n % 5 == 0 or (n % 3 == 0 and calls[pan] < 2):
            raise ConnectionError("unavailable")
        return json.dumps({"tokenisedPan": "TOK-SVC-" + pan[-6:]})

    return answer


def _save_endpoint() -> Client:
    """By order number n: n%10=3 is never saved, n%4=1 at the third call."""
    calls: Counter[str] = Counter()

    def save(body: str) -> None:
        transaction = json.loads(body)["transactionId"]
        calls[transaction] += 1
        n = int(transaction[4:])
        if n % 10 == 3 or (n % 4 == 1 and calls[transaction] < 3):
            raise ConnectionError("unavailable")

    return save


def parse_messages(spark, sf_dir):
    return _messages(spark, sf_dir).select(
        *RECORD,
        *[_money(n).alias(n) if n == "amount" else F.col(n) for n in S.MESSAGE.fieldNames()],
        *S.FLAGS.fieldNames(),
    )


def exact_fields(spark, sf_dir):
    """Look-alike names in CDATA and in namespaces, and numbers and times no typed column holds whole."""
    done = outcome.process(feeds.exact_feed(spark, sf_dir), tokenise.tokenise_local())
    return requests.to_save_request(done, "amount_inexact").select(
        F.col("offset").alias("k"),
        F.col("transactionId").alias("transaction_id"),
        "amountText",
        "amount_inexact",
        F.col("amount").isNull().alias("amount_missing"),
        "timestamp",
    )


def success_requests(spark, sf_dir):
    """What a user of the library does with a batch: settle it, then take the requests that went through."""
    saved = requests.to_save_request(_outcomes(spark, sf_dir).filter("result = 'SUCCESS'"))
    return saved.drop("topic", "amountText").withColumn("amount", _money("amount"))


def parse_rejects(spark, sf_dir):
    rejected = parse.rejects(parse.parse_feed(feeds.order_feed(spark, sf_dir), ()))
    return rejected.select("key", *RECORD, "value")


def filter_publishable(spark, sf_dir):
    return _publishable(spark, sf_dir, "transaction_id").select(*RECORD, "record_type", "message_type", "transaction_id")


def tokenise_local(spark, sf_dir):
    tokenised = tokenise.tokenise_local()(_publishable(spark, sf_dir, "digital_pan"), F.lit(True))
    return tokenised.select(*RECORD, "tokenised_pan")


def tokenise_vault(spark, sf_dir):
    tokenised = _vault(spark, sf_dir)(_publishable(spark, sf_dir, "digital_pan"), F.lit(True))
    return tokenised.select(*RECORD, "tokenised_pan")


def tokenise_vault_salted(spark, sf_dir):
    """The same lookup as for a vault too large to broadcast."""
    tokeniser = _vault(spark, sf_dir, broadcast_bytes=-1)
    return tokeniser(_publishable(spark, sf_dir, "digital_pan"), F.lit(True)).select(*RECORD, "tokenised_pan")


def tokenise_prepared(spark, sf_dir):
    """The same lookup in a vault prepared once, which two batches meet bucket by bucket without shuffling it."""
    prepared = vaults.prepare_vault(feeds.customer_vault(spark, sf_dir), fresh_path(spark, "vault"))
    tokeniser = vaults.tokenise_prepared(prepared, named_cards=0)
    messages = _publishable(spark, sf_dir, "digital_pan")
    parts = [tokeniser(messages.where(F.col("offset") % 2 == k), F.lit(True)) for k in range(2)]
    return parts[0].unionByName(parts[1]).select(*RECORD, "tokenised_pan")


def tokenise_service(spark, sf_dir):
    tokeniser = tokenise.tokenise_service(_token_service, NO_WAIT)
    tokenised = tokeniser(_publishable(spark, sf_dir, "digital_pan"), F.lit(True))
    return tokenised.select(
        *RECORD, "tokenised_pan", "token_attempts", F.col("token_error").isNotNull().alias("failed")
    )


def _dead_service() -> Client:
    def answer(body: str) -> str:
        raise ConnectionError("unavailable")

    return answer


def service_outage(spark, sf_dir):
    """A service that never answers, asked once: every record it was needed for is to be retried."""
    tokeniser = tokenise.tokenise_service(_dead_service, RetryPolicy(max_attempts=1, sleep=_no_wait), parallelism=4)
    done = outcome.process(feeds.order_feed(spark, sf_dir), tokeniser, fields=("digital_pan",))
    return done.select(*RECORD, "result", "reason", (F.coalesce(F.col("token_attempts"), F.lit(0)) <= 1).alias("once"))


def masked_report(spark, sf_dir):
    return metrics.masked_report(_messages(spark, sf_dir, "transaction_id", "message_type", "digital_pan")).select(
        *RECORD, "transaction_id", "message_type", "masked_pan"
    )


def _requests(spark, sf_dir):
    tokenised = _vault(spark, sf_dir)(_publishable(spark, sf_dir), F.lit(True))
    return tokenised.filter("tokenised_pan IS NOT NULL")


def save_requests(spark, sf_dir):
    request = requests.to_save_request(_requests(spark, sf_dir))
    return request.drop("topic", "amountText").withColumn("amount", _money("amount"))


def save_payloads(spark, sf_dir):
    return _requests(spark, sf_dir).select(*RECORD, requests.request_json().alias("body"))


def save_service(spark, sf_dir):
    saved = outcome.process(
        feeds.order_feed(spark, sf_dir), tokenise.tokenise_local(), requests.save_service(_save_endpoint, NO_WAIT)
    )
    return saved.select(
        *RECORD, "result", "reason", "save_attempts", F.col("save_error").isNotNull().alias("failed")
    )


def process_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir, _TO_SETTLE).select(
        "topic", *RECORD, "transaction_id", "message_type", "tokenised_pan", "result", "reason", "attempts"
    )


def process_local(spark, sf_dir):
    read = ("digital_pan", "amount", "event_timestamp")
    done = outcome.process(feeds.order_feed(spark, sf_dir), tokenise.tokenise_local(), fields=read)
    return (
        done.groupBy("result", "reason")
        .agg(
            F.count("*").alias("records"),
            F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount"),
            F.count("event_timestamp").alias("timestamps"),
            F.countDistinct("tokenised_pan").alias("tokens"),
        )
    )


def offset_ledger(spark, sf_dir):
    return ledger.offset_ledger(_outcomes(spark, sf_dir, _TO_SETTLE))


def at_risk(spark, sf_dir):
    return ledger.at_risk(_outcomes(spark, sf_dir, _TO_SETTLE)).select("topic", *RECORD, "transaction_id", "reason", "committed")


def acked_ranges(spark, sf_dir):
    return intervals.acked_ranges(_outcomes(spark, sf_dir, _TO_SETTLE))


def late_ranges(spark, sf_dir):
    """Intervals carried from batch to batch: every third offset at a time, the last ones first, some of them never."""
    outcomes = stage(_outcomes(spark, sf_dir, _TO_SETTLE).select(*S.RECORD_ID, "result"), "outcomes")
    ranges = None
    for turn in (2, 0, 1):
        now = intervals.acked_ranges(outcomes.where((F.col("offset") % 3 == turn) & (F.col("offset") % 50 != 1)), 1000)
        ranges = stage(now if ranges is None else intervals.merge_ranges(ranges.unionByName(now), 1000), "ranges")
    return ranges


def _stored_ranges(spark, sf_dir):
    return stage(intervals.acked_ranges(_outcomes(spark, sf_dir, _TO_SETTLE)), "ranges")


def ledger_positions(spark, sf_dir):
    return intervals.positions(_stored_ranges(spark, sf_dir))


def resume_offsets(spark, sf_dir):
    """What the topic source is told to start from, one partition of the topic being unknown to the ledger."""
    known = _stored_ranges(spark, sf_dir).where("partition <> 2")
    return spark.createDataFrame([(resume.resume_from(known, {feeds.TOPIC: 4}),)], "starting_offsets STRING")


def _from_zero(ranges: DataFrame) -> DataFrame:
    return ranges.select("topic", "partition").distinct().withColumn("start", F.lit(0).cast("bigint"))


def replay_windows(spark, sf_dir):
    ranges = _stored_ranges(spark, sf_dir)
    return resume.replay_windows(ranges, _from_zero(ranges), reads=4)


def unsettled_records(spark, sf_dir):
    """The records that a replay by the ledger brings back: those in its holes, and no other."""
    ranges = _stored_ranges(spark, sf_dir)
    windows = resume.replay_windows(ranges, _from_zero(ranges), reads=4).withColumnsRenamed({"first": "_from", "last": "_to"})
    feed = feeds.order_feed(spark, sf_dir)
    read = feed.join(windows, ["topic", "partition"]).where(F.col("offset").between(F.col("_from"), F.col("_to")))
    return resume.unsettled(read.select(*feed.columns), ranges, 1000).select("key", *RECORD)


def retry_queue(spark, sf_dir):
    return redelivery.retry_queue(_outcomes(spark, sf_dir)).select(*RECORD, "transaction_id", "digital_pan", "attempts")


def redelivered(spark, sf_dir):
    tokeniser = _vault(spark, sf_dir)
    prepared = outcome.prepare(feeds.order_feed(spark, sf_dir))
    final = redelivery.redeliver(prepared, lambda work: outcome.settle(work, tokeniser, _rule_saver), rounds=3)
    return final.select(*RECORD, "result", "reason", "attempts", "tokenised_pan")


def call_health(spark, sf_dir):
    return health.call_health(
        feeds.table(spark, sf_dir, "events"),
        service=F.col("user_id") % 2,
        order=["ts", "event_id"],
        failed=F.col("event_type") == "error",
    )


def stream_health(spark, sf_dir):
    """The same log in three parts, one after the other."""
    events = feeds.table(spark, sf_dir, "events")
    cuts = events.agg(F.percentile_approx("event_id", [0.3, 0.7], 1000)).first()[0]
    base = fresh_path(spark, "health")
    parts = [F.col("event_id") <= cuts[0], F.col("event_id").between(cuts[0] + 1, cuts[1]), F.col("event_id") > cuts[1]]
    for part in parts:
        events.filter(part).write.mode("append").parquet(f"{base}/calls")
        calls = spark.readStream.schema(events.schema).parquet(f"{base}/calls")
        service, failed = F.col("user_id") % 2, F.col("event_type") == "error"
        watch_health(calls, f"{base}/store", f"{base}/checkpoint", service, ["event_id"], failed).awaitTermination()
    health_columns = ["service", "event_id", "window_size", "failures", "failure_rate", "flagged"]
    return spark.read.parquet(f"{base}/store/health").select(*health_columns)


def outcome_metrics(spark, sf_dir):
    return metrics.outcome_metrics(_outcomes(spark, sf_dir, (*_TO_SETTLE, *S.FLAGS.fieldNames())))


def codec_roundtrip(spark, sf_dir):
    sealed = codec.encrypt_feed(feeds.order_feed(spark, sf_dir), KEY)
    return codec.decrypt_feed(sealed, KEY).select("key", *RECORD, "value", "decrypt_failed")


def encrypted_shape(spark, sf_dir):
    """What the random IV leaves fixed: prefix, length and separator of each envelope."""
    sealed = publish_records(feeds.order_feed(spark, sf_dir), KEY)
    value = F.col("value")
    return sealed.select(
        "key",
        F.coalesce(value.startswith(PREFIX), F.lit(False)).alias("sealed"),
        F.coalesce(F.length(value), F.lit(0)).alias("characters"),
        F.coalesce(F.instr(value.substr(F.lit(len(PREFIX) + 1), F.length(value)), ":"), F.lit(0)).alias("separator"),
    )


def publish_partitions(spark, sf_dir):
    """The partition of a topic of twelve that each record is dealt to by its key."""
    sent = ordered_records(feeds.order_feed(spark, sf_dir).drop("partition"), 12, order="offset")
    return sent.select("key", "partition")


def topic_records(spark, sf_dir):
    """What is published, as a topic gives it back: bytes, some of them no UTF-8, and keys that may be absent."""
    sent = publish_records(feeds.order_feed(spark, sf_dir), KEY)
    k = F.substring("key", 7, 20).cast("bigint")
    damaged = F.concat(
        F.encode(F.lit("<Data><TransactionId>T"), "UTF-8"),
        F.unhex(F.lit("FF")),
        F.encode(F.concat(k.cast("string"), F.lit("</TransactionId></Data>")), "UTF-8"),
    )
    records = sent.select(
        F.when(k % 10 != 0, F.encode("key", "UTF-8")).alias("key"),
        F.when(k % 6 == 0, damaged).otherwise(F.encode("value", "UTF-8")).alias("value"),
        F.lit(feeds.TOPIC).alias("topic"),
        (k % 4).cast("int").alias("partition"),
        F.floor(k / 4).cast("bigint").alias("offset"),
    )
    return codec.decrypt_feed(from_records(records), KEY).select("key", *RECORD, "value", "decrypt_failed")


def _mixed(spark, sf_dir):
    """Even orders encrypted, odd ones plain."""
    plain = feeds.order_feed(spark, sf_dir)
    sealed = codec.encrypt_feed(plain.withColumn("_plain", F.col("value")), KEY)
    odd = F.col("partition") % 2 == 1
    return sealed.withColumn("value", F.when(odd, F.col("_plain")).otherwise(F.col("value"))).drop("_plain")


def decrypt_mixed(spark, sf_dir):
    return codec.decrypt_feed(_mixed(spark, sf_dir), KEY).select("key", *RECORD, "value", "decrypt_failed")


def decrypt_quarantine(spark, sf_dir):
    """The mixed feed with every third envelope cut short: those are set aside, none is lost."""
    damaged = _mixed(spark, sf_dir).withColumn(
        "value",
        F.when(
            F.col("value").startswith(PREFIX) & (F.col("offset") % 3 == 0),
            F.col("value").substr(F.lit(1), F.length("value") - 8),
        ).otherwise(F.col("value")),
    )
    done = outcome.process(damaged, tokenise.tokenise_local(), decoder=lambda feed: codec.decrypt_feed(feed, KEY), fields=("digital_pan",))
    return done.select(*RECORD, "result", "reason", F.col("value").isNotNull().alias("kept"))


def _streamed(spark, sf_dir, drops: list[Column], **options) -> Store:
    """Run the continuous job over the feed, dropped into a folder in parts."""
    base = fresh_path(spark, "stream")
    feed = feeds.order_feed(spark, sf_dir)
    for part in drops:
        feed.filter(part).write.mode("append").parquet(f"{base}/feed")
        source = spark.readStream.schema(S.FEED).parquet(f"{base}/feed")
        query = run.run_stream(source, f"{base}/store", f"{base}/checkpoint", _vault(spark, sf_dir), _rule_saver, **options)
        query.awaitTermination()
    return Store(spark, f"{base}/store")


def stream_outcomes(spark, sf_dir):
    store = _streamed(spark, sf_dir, [F.lit(True)])
    return run.final_outcomes(store).select(*RECORD, "result", "reason", "attempts", "tokenised_pan")


def _two_drops() -> list[Column]:
    return [F.col("partition") % 2 == 1, F.col("partition") % 2 == 0]


def stream_redelivery(spark, sf_dir):
    """Odd partitions first: what fails there comes back with the second batch."""
    store = _streamed(spark, sf_dir, _two_drops())
    return run.final_outcomes(store).select(*RECORD, "result", "reason", "attempts", "tokenised_pan")


def stream_transactions(spark, sf_dir):
    store = _streamed(spark, sf_dir, _two_drops())
    return (
        store.table("transactions")
        .drop("topic", "batch_id", "amountText")
        .withColumn("amount", _money("amount"))
    )


def keyed_transactions(spark, sf_dir):
    """Two jobs with checkpoints and batches of their own save the same feed: every request is there once."""
    root = fresh_path(spark, "saved")
    for drops in (_two_drops(), [F.lit(True)]):
        _streamed(spark, sf_dir, drops, saved=KeyedTable(spark, root, S.SAVED, bucket_offsets=1000))
    saved = KeyedTable(spark, root, S.SAVED).read()
    return saved.drop("topic", "amountText").withColumn("amount", _money("amount"))


def live_metrics(spark, sf_dir):
    """What was counted while the outcomes of two batches were written."""
    rows = live.live_metrics(_streamed(spark, sf_dir, _two_drops()))
    return rows.select(
        "batch_id", "records", "succeeded", "skipped", "to_retry", "amounts_coerced", "timestamps_coerced", "MALFORMED", "SAVE_FAILED"
    )


def stream_acked(spark, sf_dir):
    return _streamed(spark, sf_dir, _two_drops()).batch("acked", 1)


def _due_batches(spark, sf_dir) -> Store:
    """Five batches at set times: odd partitions, even ones, then only what has become due."""
    store, feed = Store(spark, fresh_path(spark, "due")), feeds.order_feed(spark, sf_dir)
    parts = [*_two_drops(), F.lit(False), F.lit(False), F.lit(False)]
    tokeniser = _vault(spark, sf_dir)
    for batch_id, (part, now) in enumerate(zip(parts, (0.0, 0.4, 1.0, 1.5, 2.0))):
        schedule = due.RetrySchedule(deliveries=3, clock=lambda now=now: now)
        due.settle_due_batch(store, feed.where(part), batch_id, tokeniser, _rule_saver, schedule=schedule)
    return store


def due_outcomes(spark, sf_dir):
    final = due.final_due_outcomes(_due_batches(spark, sf_dir))
    return final.select(*RECORD, "result", "reason", "attempts", "tokenised_pan")


def due_batches(spark, sf_dir):
    """How many records each batch settles: new ones, and of the failed ones those that are due."""
    return _due_batches(spark, sf_dir).table("outcomes").groupBy("batch_id").agg(F.count("*").alias("records"))


def stream_ledger(spark, sf_dir):
    return _streamed(spark, sf_dir, _two_drops()).batch("ledger", 1)


def _supplier_folder(spark, sf_dir, blank: str) -> str:
    folder = fresh_path(spark, "folder")
    feeds.write_files(feeds.supplier_feed(spark, sf_dir, blank), folder)
    return folder


def _folder_messages(records: DataFrame) -> DataFrame:
    parsed = parse.parse_feed(records)
    return parsed.select(
        "key",
        "parsed",
        "message_type",
        "record_type",
        "transaction_id",
        "digital_pan",
        _money("amount").alias("amount"),
        "event_timestamp",
    )


def folder_feed(spark, sf_dir):
    return _folder_messages(read_folder(spark, _supplier_folder(spark, sf_dir, blank="")))


def folder_changes(spark, sf_dir):
    """The files of suppliers with low balances are written again: a second look finds just those."""
    folder = _supplier_folder(spark, sf_dir, blank="")
    seen = stage(read_folder(spark, folder).select("path", "modified"), "seen")
    low = feeds.table(spark, sf_dir, "supplier").filter("s_acctbal < 5000")
    again = low.select(F.concat(F.lit("msg."), "s_suppkey").alias("key"), F.lit("<again/>").alias("value"))
    feeds.write_files(again, folder)
    return changed_files(read_folder(spark, folder), seen).select("key", "value")


def folder_polls(spark, sf_dir):
    """Three looks at a folder: all files, those written again, one of them with an older time, and none."""
    folder = _supplier_folder(spark, sf_dir, blank="")
    scheme, _, path = folder.rpartition(":")
    store = Store(spark, fresh_path(spark, "polls"))
    polls = []
    for poll in range(3):
        if poll == 1:
            low = feeds.table(spark, sf_dir, "supplier").filter("s_acctbal < 5000")
            again = low.select(F.concat(F.lit("msg."), "s_suppkey").alias("key"), F.lit("<again/>").alias("value"))
            feeds.write_files(again, folder)
            feeds.set_time(spark, f"{folder}/msg.{low.agg(F.min('s_suppkey')).first()[0]}.xml", seconds=86_400)
        looked_at = f"{scheme}:{path}/../{path.rpartition('/')[2]}//" if scheme else f"{path}//"
        poll_folder(store, looked_at, poll, lambda records: None, settle_seconds=0.0)
        polls.append(stage(store.batch("published", poll).select(F.lit(poll).alias("poll"), "key", "value"), "polled"))
    return polls[0].unionByName(polls[1]).unionByName(polls[2])


def folder_watch(spark, sf_dir):
    """The same three looks by the stream: empty files, rewritten ones and one with an older time come once for each change."""
    folder = _supplier_folder(spark, sf_dir, blank="")
    store, base = Store(spark, fresh_path(spark, "watched")), fresh_path(spark, "watch")
    for look in range(3):
        if look == 1:
            low = feeds.table(spark, sf_dir, "supplier").filter("s_acctbal < 5000")
            again = low.select(F.concat(F.lit("msg."), "s_suppkey").alias("key"), F.lit("<again/>").alias("value"))
            feeds.write_files(again, folder)
            feeds.set_time(spark, f"{folder}/msg.{low.agg(F.min('s_suppkey')).first()[0]}.xml", seconds=86_400)

        def publish(records: DataFrame, look: int = look) -> None:
            store.write("looks", look, records.select("key", "value"))

        watch_changes(store, folder, base, publish, every=None, settle_seconds=0.0).awaitTermination()
    looks = spark.read.schema("key STRING, value STRING, batch_id INT").parquet(f"{store.root}/looks")
    return looks.select(F.col("batch_id").alias("poll"), "key", "value")


def folder_stream(spark, sf_dir):
    folder = _supplier_folder(spark, sf_dir, blank="\n")
    out = fresh_path(spark, "folder-out")
    stream = _folder_messages(watch_folder(spark, folder))
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        parse_messages,
        exact_fields,
        success_requests,
        parse_rejects,
        filter_publishable,
        tokenise_local,
        tokenise_vault,
        tokenise_vault_salted,
        tokenise_prepared,
        tokenise_service,
        service_outage,
        masked_report,
        save_requests,
        save_payloads,
        save_service,
        process_outcomes,
        process_local,
        offset_ledger,
        at_risk,
        retry_queue,
        redelivered,
        call_health,
        stream_health,
        outcome_metrics,
        codec_roundtrip,
        encrypted_shape,
        publish_partitions,
        topic_records,
        decrypt_mixed,
        decrypt_quarantine,
        stream_outcomes,
        stream_redelivery,
        stream_transactions,
        stream_ledger,
        stream_acked,
        live_metrics,
        keyed_transactions,
        acked_ranges,
        late_ranges,
        ledger_positions,
        resume_offsets,
        replay_windows,
        unsettled_records,
        due_outcomes,
        due_batches,
        folder_feed,
        folder_changes,
        folder_polls,
        folder_watch,
        folder_stream,
    )
}
QUERIES["redelivery"] = QUERIES.pop("redelivered")
