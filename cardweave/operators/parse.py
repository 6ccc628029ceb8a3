"""Raw XML values to typed messages, with a reject channel."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave import schemas as S
from cardweave.functions import fields
from cardweave.functions.plan import pin
from cardweave.functions.text import is_blank
from cardweave.functions.xml import element, fragment_text, is_accepted, read_fragment
from cardweave.operators.codec import text_feed


#: Every column that parsing can add, besides ``parsed``.
COLUMNS = (*S.MESSAGE.fieldNames(), *S.FLAGS.fieldNames())


def parse_feed(feed: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """Add ``parsed`` and the typed message columns to every record, or only those named in ``columns``.

    Null, blank, malformed and wrong-root values get ``parsed = false`` and null fields.
    A bad amount or timestamp only nulls that field and sets ``amount_coerced`` or
    ``timestamp_coerced``; ``amount_inexact`` marks numbers that the decimal cannot hold. The
    document is parsed once, however many columns and filters use it. Amounts and times are
    typed once too, if at all: what is held in place for that cannot be pruned, so a
    caller that needs neither should name its columns.
    """
    wanted = COLUMNS if columns is None else [name for name in COLUMNS if name in set(columns)]
    if columns is not None and len(wanted) < len(set(columns)):
        raise ValueError(f"not message columns: {sorted(set(columns) - set(COLUMNS))}")
    document = F.col("_document")
    raw = {column: element(document, name) for name, column in S.ELEMENTS.items()}
    ok = F.col("parsed")
    value = F.col("value")
    text = pin(text_feed(feed), "_text", F.when(~is_blank(value), fragment_text(value)))
    parsed = pin(text, "_document", read_fragment(F.col("_text"))).withColumn("parsed", is_accepted(document))

    used = {"amount", "amount_text", *wanted} if "amount_inexact" in wanted else set(wanted)
    # What several typed columns read is worked out once, before them.
    reads = {
        "number": ({"amount", "amount_text", "amount_coerced"}, fields.amount_text(raw["amount"])),
        "moment": ({"event_timestamp", "timestamp_text", "timestamp_coerced"}, fields.event_timestamp(raw["event_timestamp"])),
    }
    read = [c.alias(n) for n, (columns_of, c) in reads.items() if columns_of & used]
    if read:
        parsed = pin(parsed, "_read", F.when(ok, F.struct(*read)))
    number, timestamp = F.col("_read.number"), F.col("_read.moment")
    held = {
        "_amounts": {
            "amount": fields.amount_of(number),
            "amount_coerced": fields.was_coerced(raw["amount"], number),
        },
        "_times": {
            "timestamp_text": fields.iso_text(raw["event_timestamp"], timestamp),
            "timestamp_coerced": fields.was_coerced(raw["event_timestamp"], timestamp),
        },
    }
    typed = {
        "message_type": F.when(ok, fields.message_type(raw["message_type"])),
        "record_type": F.when(ok, fields.record_type(raw["record_type"])),
        **{n: F.when(ok, raw[n]) for n in ("transaction_id", "digital_pan", "currency_code", "response_code")},
    }
    typed |= {n: c for n, c in (("amount_text", number), ("event_timestamp", timestamp)) if n in used}
    # Two steps, since one alone is a longer method than the JVM compiles.
    for name, own in held.items():
        own = {n: c for n, c in own.items() if n in used}
        if own:
            parsed = pin(parsed, name, F.when(ok, F.struct(*[c.alias(n) for n, c in own.items()])))
            typed |= {n: F.col(f"{name}.{n}") for n in own}
    if "amount_inexact" in wanted:
        typed["amount_inexact"] = fields.is_inexact(typed["amount_text"], typed["amount"])
    flags = set(S.FLAGS.fieldNames())
    return parsed.select(
        *feed.columns,
        "parsed",
        *[(F.coalesce(typed[n], F.lit(False)) if n in flags else typed[n]).alias(n) for n in wanted],
    )


def messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter("parsed").drop("parsed", "value")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter("NOT parsed").drop("parsed", *COLUMNS)
