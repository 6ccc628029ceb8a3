"""Resolving the symmetric key on the driver, once, before any plan is built."""

from __future__ import annotations

import base64
import binascii
import os
import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column, SparkSession

# Names under which a key may be given.
CONFIG_BASE64 = "crypto.key-base64"
CONFIG_TEXT = "crypto.key"
ENV_BASE64 = "KAFKA_SYMMETRIC_KEY_BASE64"
ENV_TEXT = "KAFKA_SYMMETRIC_KEY"
KEY_LENGTHS = (16, 24, 32)

_NO_BREAK = "\u00a0\u2007\u202f"


def _is_blank(text: str) -> bool:
    def white(ch: str) -> bool:
        if ch in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f":
            return True
        return unicodedata.category(ch) in ("Zs", "Zl", "Zp") and ch not in _NO_BREAK

    return all(white(ch) for ch in text)


def _first_set(*candidates: str | None) -> str | None:
    return next((c for c in candidates if c is not None and not _is_blank(c)), None)


def resolve_key(config: Mapping[str, str] | None = None, env: Mapping[str, str] | None = None) -> bytes:
    """Base64 setting, base64 variable, text setting, text variable: the first one set wins."""
    config = config or {}
    env = os.environ if env is None else env
    encoded = _first_set(config.get(CONFIG_BASE64), env.get(ENV_BASE64))
    if encoded is not None:
        try:
            padded = encoded if "=" in encoded else encoded + "=" * (-len(encoded) % 4)
            key = base64.b64decode(padded, validate=True)
        except binascii.Error as error:
            raise ValueError("the key is not valid base64") from error
    else:
        text = _first_set(config.get(CONFIG_TEXT), env.get(ENV_TEXT))
        if text is None:
            raise ValueError(f"set {ENV_BASE64} or {ENV_TEXT} for message encryption")
        key = text.encode("utf-8")
    if len(key) not in KEY_LENGTHS:
        raise ValueError(f"an AES key has 16, 24 or 32 bytes, this one has {len(key)}")
    return key


def key_column(spark: SparkSession, key: bytes) -> Column:
    """The key as a scalar subquery: a literal would show in ``explain`` and in event logs."""
    return spark.createDataFrame([(bytearray(key),)], "secret BINARY").scalar()
