"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a NULL key part contributes to a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def email_domain(email: Column) -> Column:
    """Part after the first ``@``; empty when there is none."""
    return F.split_part(email, F.lit("@"), F.lit(2))


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the parts' text joined by ``-``."""
    texts = [
        F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit(NULL_KEY_PART))
        for p in parts
    ]
    return F.md5(F.concat_ws("-", *texts))


def packed(text: Column) -> Column:
    """Text as bytes, for joins and counts by it: hex digits in lower case take half a byte each,
    any other text its own bytes. Equal texts, and only they, have equal bytes; the first byte
    tells the forms apart."""
    binary = F.unhex(text)
    short = F.coalesce(F.lower(F.hex(binary)) == text, F.lit(False))
    return F.when(short, F.concat(F.lit(bytearray([1])), binary)).otherwise(
        F.concat(F.lit(bytearray([0])), text.cast("binary"))
    )


def unpacked(value: Column) -> Column:
    """The text of ``packed`` bytes."""
    rest = F.substr(value, F.lit(2))
    return F.when(F.substr(value, F.lit(1), F.lit(1)) == F.lit(bytearray([1])), F.lower(F.hex(rest))).otherwise(
        rest.cast("string")
    )


def concat_code(*parts: Column) -> Column:
    """Concatenate the parts' text; NULL if any part is NULL."""
    return F.concat(*[p.cast("string") for p in parts])
