"""Text rules with the JVM's string semantics."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to U+0020, which is what the JVM's trim() removes.
_TRIMMED = "".join(chr(code) for code in range(0x21))


def is_blank(c: Column) -> Column:
    return c.rlike(r"\A\p{javaWhitespace}*+\z")


def java_trim(c: Column) -> Column:
    """Spark's own ``trim`` strips spaces only."""
    return F.btrim(c, F.lit(_TRIMMED))


def last_four(c: Column) -> Column:
    return F.right(c, F.lit(4))


def mask_pan(c: Column) -> Column:
    """All but the last four characters starred; null or shorter than four: ``****``."""
    return F.when(
        F.length(c) >= 4,
        F.concat(F.repeat(F.lit("*"), F.length(c) - 4), last_four(c)),
    ).otherwise("****")


def stem(file_name: Column) -> Column:
    """File name without its last extension; a leading dot starts no extension."""
    return F.regexp_extract(file_name, r"(?s)\A(.+?)(\.[^.]*)?\z", 1)


def utf8_text(c: Column) -> Column:
    """Bytes to text; invalid sequences become U+FFFD instead of raising."""
    return F.make_valid_utf8(c.cast("string"))
