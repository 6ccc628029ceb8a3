"""The text envelope ``prefix + base64(iv) + ':' + base64(ciphertext and tag)``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardweave.functions.text import utf8_text

# Fixed values of the wire format: 12 IV bytes are exactly 16 base64 characters.
PREFIX = "aes-gcm-v1:"
IV_CHARS = 16

_IV_AT = len(PREFIX) + 1
_SEPARATOR_AT = _IV_AT + IV_CHARS
_SHAPE = rf"\A{PREFIX}[A-Za-z0-9+/]{{{IV_CHARS}}}:[A-Za-z0-9+/]*+={{0,2}}\z"


def encrypt_text(value: Column, key: Column) -> Column:
    """Envelope of ``value``; null stays null.

    ``aes_encrypt`` draws a new IV at every evaluation, so the ciphertext appears once
    and the separator is put in by position.
    """
    sealed = F.aes_encrypt(F.encode(value, "UTF-8"), key, F.lit("GCM"), F.lit("DEFAULT"))
    packed = F.concat(F.lit(PREFIX), F.translate(F.base64(sealed), "\r\n", ""))
    return F.overlay(packed, F.lit(":"), _SEPARATOR_AT, 0)


def is_envelope(value: Column) -> Column:
    return F.coalesce(value.startswith(PREFIX), F.lit(False))


def open_envelope(value: Column, key: Column) -> Column:
    """Plaintext of an envelope, or null when it cannot be opened.

    Without the separator, IV and ciphertext are one base64 text, decoded at once.
    """
    packed = F.concat(value.substr(_IV_AT, IV_CHARS), value.substr(F.lit(_SEPARATOR_AT + 1), F.length(value)))
    sealed = F.try_to_binary(packed, F.lit("base64"))
    plain = F.try_aes_decrypt(sealed, key, F.lit("GCM"), F.lit("DEFAULT"))
    return F.when(value.rlike(_SHAPE), utf8_text(plain))
