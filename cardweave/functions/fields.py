"""Typing rules of the eight message fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardweave import schemas as S
from cardweave.functions.plan import let
from cardweave.functions.text import java_trim


def _enum(raw: Column, names: list[str], default: str) -> Column:
    name = F.upper(java_trim(raw))
    return F.when(name.isin(names), name).otherwise(default)


def message_type(raw: Column) -> Column:
    return _enum(raw, S.MESSAGE_TYPES, S.UNKNOWN_TYPE)


def record_type(raw: Column) -> Column:
    return _enum(raw, S.RECORD_TYPES, S.OTHER_RECORD)


# Decimal literal: digits with an optional point, and an optional exponent of 32 bits.
_DECIMAL = r"\A[+-]?([0-9]++(\.[0-9]*+)?|\.[0-9]++)([eE][+-]?0*+[0-9]{1,10})?\z"
_TEN_DIGITS = r"[eE][+-]?0*+[1-9][0-9]{9}\z"
_MOST_EXPONENT = (1 << 31) - 1


def amount_text(raw: Column) -> Column:
    """The trimmed literal when it is a number, else null."""
    text = java_trim(raw)
    fits = let(
        _parts(text),
        lambda p: F.abs(p["exponent"]).between(0, _MOST_EXPONENT) & p["scale"].between(-_MOST_EXPONENT, _MOST_EXPONENT),
    )
    return F.when(text.rlike(_DECIMAL) & (~text.rlike(_TEN_DIGITS) | fits), text)


# Exponents of two digits and more.
_LONG_EXPONENT = r"[eE][+-]?0*+[1-9][0-9]++\z"


def amount(raw: Column) -> Column:
    """DECIMAL(38,10), or null: a bad amount never rejects the message.

    A number that rounds to zero or is far too large is not handed to the cast when its
    exponent is long: spelling out 1E-999999999 would take the task down.
    """
    return amount_of(amount_text(raw))


def amount_of(text: Column) -> Column:
    """:func:`amount` of an :func:`amount_text`, which is evaluated several times here."""
    whole = S.AMOUNT.precision - S.AMOUNT.scale
    vanishes = let(_parts(text), lambda p: (p["digits"] == "0") | (p["scale"] - F.length(p["digits"]) > S.AMOUNT.scale))
    too_large = let(_parts(text), lambda p: (p["digits"] != "0") & (F.length(p["digits"]) - p["scale"] > whole))
    long = text.rlike(_LONG_EXPONENT)
    return F.when(long & vanishes, F.lit(0).cast(S.AMOUNT)).when(~(long & too_large), text.try_cast(S.AMOUNT))


def is_inexact(text: Column, typed: Column) -> Column:
    """True when a number is too large for the decimal or has decimals that were rounded away."""
    # Only a long literal or one with an exponent can be.
    long = (F.length(text) > S.AMOUNT.scale + 1) | text.rlike("[eE]")
    zeros = lambda p: F.length(p["digits"]) - F.length(F.rtrim(p["digits"], F.lit("0")))
    rounded = let(_parts(text), lambda p: (p["digits"] != "0") & (p["scale"] - zeros(p) > S.AMOUNT.scale))
    return F.coalesce(long & (typed.isNull() | rounded), F.lit(False))


# Literals that already have the printed form.
_PRINTED = r"\A(-?[1-9][0-9]*+(\.[0-9]++)?|0(\.[0-9]{1,6})?)\z"


def amount_json(text: Column) -> Column:
    """The literal as a JSON number, written the way the JVM prints a big decimal.

    The scale is kept (``0.50`` stays ``0.50``); an exponent appears only when the
    scale is negative or the value is below 1E-6.
    """
    return F.when(text.rlike(_PRINTED), text).otherwise(let(_parts(text), _printed))


def _parts(text: Column) -> Column:
    mantissa = F.regexp_replace(text, r"\A[+-]|[eE].*\z", "")
    fraction = F.split_part(mantissa, F.lit("."), F.lit(2))
    exponent = F.coalesce(F.regexp_extract(text, r"[eE]\+?(-?[0-9]+)\z", 1).try_cast("bigint"), F.lit(0))
    return F.struct(
        text.startswith("-").alias("negative"),
        F.regexp_replace(F.replace(mantissa, F.lit(".")), r"\A0+(?=[0-9])", "").alias("digits"),
        exponent.alias("exponent"),
        (F.length(fraction) - exponent).alias("scale"),
    )


def _printed(parts: Column) -> Column:
    digits, scale = parts["digits"], parts["scale"].cast("int")
    n = F.length(digits)
    adjusted = n - 1 - scale
    padded = F.lpad(digits, F.greatest(n, scale + 1), F.lit("0"))
    cut = F.length(padded) - scale
    plain = F.when(scale == 0, digits).otherwise(
        F.concat(padded.substr(F.lit(1), cut), F.lit("."), F.right(padded, scale))
    )
    power = F.when(adjusted > 0, F.concat(F.lit("E+"), adjusted.cast("string")))
    power = power.when(adjusted < 0, F.concat(F.lit("E"), adjusted.cast("string"))).otherwise("")
    point = F.when(n > 1, F.concat(F.lit("."), digits.substr(F.lit(2), n))).otherwise("")
    scientific = F.concat(digits.substr(1, 1), point, power)
    body = F.when((scale >= 0) & (adjusted >= -6), plain).otherwise(scientific)
    return F.when(parts["negative"] & (digits != "0"), F.concat(F.lit("-"), body)).otherwise(body)


# ISO local date-time: seconds optional, up to nine fraction digits, no zone.
_LOCAL_DATE_TIME = (
    r"\A([0-9]{4}|-[0-9]{4,9}|[+][0-9]{5,9})-[0-9]{2}-[0-9]{2}"
    r"[Tt][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{0,9})?)?\z"
)


def event_timestamp(raw: Column) -> Column:
    """TIMESTAMP_NTZ, or null. The cast alone would also take zones, spaces and bare dates."""
    text = java_trim(raw)
    return F.when(text.rlike(_LOCAL_DATE_TIME), F.upper(text).try_cast("timestamp_ntz"))


def iso_text(raw: Column, ts: Column) -> Column:
    """ISO text of the timestamp ``ts`` read from ``raw``, with all nine fraction digits it may have.

    Seconds are left out when seconds and fraction are both zero; a fraction has three, six
    or nine digits. Built from the cast, which knows no time zone: ``date_format`` would
    move a local time that the session's zone skips.
    """
    whole = F.split_part(F.translate(ts.cast("string"), " ", "T"), F.lit("."), F.lit(1))
    fraction = F.regexp_extract(raw, r"[.]([0-9]*?)0*+\s*+\z", 1)
    digits = F.when(F.length(fraction) <= 3, 3).when(F.length(fraction) <= 6, 6).otherwise(9)
    return F.when(fraction == "", F.regexp_replace(whole, r":00\z", "")).otherwise(
        F.concat(whole, F.lit("."), F.rpad(fraction, digits, F.lit("0")))
    )


def was_coerced(raw: Column, typed: Column) -> Column:
    """True when the element held text that the typing rule turned into null."""
    return F.coalesce(F.length(java_trim(raw)) > 0, F.lit(False)) & typed.isNull()
