"""Encrypting and decrypting feed values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave.functions.envelope import encrypt_text, is_envelope, open_envelope
from cardweave.functions.keys import key_column
from cardweave.functions.plan import pin
from cardweave.functions.text import utf8_text


def text_feed(feed: DataFrame) -> DataFrame:
    """Key and value as text, whether they arrive as bytes or already as strings."""
    columns = {
        name: utf8_text(F.col(name))
        for name, kind in feed.dtypes
        if name in ("key", "value") and kind == "binary"
    }
    return feed.withColumns(columns) if columns else feed


def encrypt_feed(feed: DataFrame, key: bytes) -> DataFrame:
    """Replace ``value`` by its envelope; null stays null."""
    secret = key_column(feed.sparkSession, key)
    sealed = pin(text_feed(feed), "_sealed", encrypt_text(F.col("value"), secret))
    return sealed.withColumn("value", F.col("_sealed")).drop("_sealed")


def decrypt_feed(feed: DataFrame, key: bytes) -> DataFrame:
    """Open envelopes, pass plain text through.

    Adds ``decrypt_failed``; such a row keeps its envelope in ``value``, so that it can
    be set aside whole.
    """
    feed = text_feed(feed)
    secret = key_column(feed.sparkSession, key)
    sealed = is_envelope(F.col("value"))
    opened = pin(feed, "_plain", F.when(sealed, open_envelope(F.col("value"), secret)))
    return opened.withColumns(
        {
            "decrypt_failed": sealed & F.col("_plain").isNull(),
            "value": F.coalesce(F.col("_plain"), F.col("value")),
        }
    ).drop("_plain")
