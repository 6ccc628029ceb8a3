"""Column contracts shared by the jobs."""

from pyspark.sql import types as T

# One record of the log, identified by these three columns.
RECORD_ID = ["topic", "partition", "offset"]

FEED = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

# Element names of the message fragment, and the column each one fills.
ELEMENTS = {
    "MessageType": "message_type",
    "RecordType": "record_type",
    "TransactionId": "transaction_id",
    "DigitalPan": "digital_pan",
    "Amount": "amount",
    "CurrencyCode": "currency_code",
    "ResponseCode": "response_code",
    "Timestamp": "event_timestamp",
}
ROOT = "Data"

# The enumerations of the feed.
MESSAGE_TYPES = ["TAR", "TVN", "TCN", "ACN"]
ACTIONABLE_TYPES = ["TVN", "TCN", "ACN"]
UNKNOWN_TYPE = "UNKNOWN"
RECORD_TYPES = ["PTLFX"]
PUBLISHED_RECORD_TYPE = "PTLFX"
OTHER_RECORD = "OTHER"

FRAGMENT = T.StructType([T.StructField(name, T.StringType()) for name in ELEMENTS])

AMOUNT = T.DecimalType(38, 10)

MESSAGE = T.StructType(
    [
        T.StructField("message_type", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("digital_pan", T.StringType()),
        T.StructField("amount", AMOUNT),
        T.StructField("amount_text", T.StringType()),
        T.StructField("currency_code", T.StringType()),
        T.StructField("response_code", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("timestamp_text", T.StringType()),
    ]
)

# What the typing rules could not keep: text turned into null, and amounts beyond the decimal.
FLAGS = T.StructType(
    [
        T.StructField("amount_coerced", T.BooleanType()),
        T.StructField("amount_inexact", T.BooleanType()),
        T.StructField("timestamp_coerced", T.BooleanType()),
    ]
)

# A prepared record: parsed, tagged with the reason to skip it, and ready to be settled.
PREPARED = T.StructType(
    [
        *FEED.fields[2:],
        T.StructField("value", T.StringType()),
        *MESSAGE.fields,
        *FLAGS.fields,
        T.StructField("reason", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)

# The tables of the continuous job that its next batch reads.
OUTCOME = T.StructType(
    [*PREPARED.fields, T.StructField("tokenised_pan", T.StringType()), T.StructField("result", T.StringType())]
)
LEDGER = T.StructType(
    [
        *FEED.fields[2:4],
        T.StructField("committed", T.LongType()),
        T.StructField("first_unacked", T.LongType()),
        T.StructField("safe_position", T.LongType()),
    ]
)

# Intervals of offsets, both ends included.
RANGES = T.StructType([*FEED.fields[2:4], T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])

# Field names of the save request.
REQUEST_FIELDS = [
    "messageType",
    "transactionId",
    "tokenisedPan",
    "amount",
    "currencyCode",
    "responseCode",
    "timestamp",
]

# A saved request: the record's id, the request, and the amount as sent.
SAVED = T.StructType(
    [
        *FEED.fields[2:],
        *[T.StructField(name, AMOUNT if name == "amount" else T.StringType()) for name in REQUEST_FIELDS],
        T.StructField("amountText", T.StringType()),
    ]
)


class Result:
    SUCCESS = "SUCCESS"
    SKIPPED = "SKIPPED"
    RETRY = "RETRY"


class Reason:
    DECRYPT_FAILED = "DECRYPT_FAILED"
    MALFORMED = "MALFORMED"
    NOT_PTLFX = "NOT_PTLFX"
    NOT_ACTIONABLE = "NOT_ACTIONABLE"
    TOKENISE_FAILED = "TOKENISE_FAILED"
    SAVE_FAILED = "SAVE_FAILED"
    OK = "OK"
