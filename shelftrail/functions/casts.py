"""Text to number, tolerant or strict."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_number(text: Column | str, strict: bool = False) -> Column:
    """Text as double. Tolerant: unreadable text gives NULL; strict: it raises (ANSI).

    Java's parser also takes a type suffix ("1d", "2.5f"), which no CSV reader
    means as a number: for both forms such text is unreadable.
    """
    text = (F.col(text) if isinstance(text, str) else text).cast("string")
    suffixed = text.rlike(r"[0-9.][dDfF]\s*$")
    if strict:
        problem = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double")
        return F.when(suffixed, problem).otherwise(text.cast("double"))
    return F.when(~suffixed, text.try_cast("double"))


def percent_of(part: Column, whole: Column) -> Column:
    """part / whole * 100, NULL when the whole is 0 or missing."""
    return F.try_divide(part, F.nullif(whole, F.lit(0.0))) * 100
