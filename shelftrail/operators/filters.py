"""Row predicates of the screens, kept inside the plan so they reach the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def within(column: str, low: float, high: float) -> Column:
    """Both ends included."""
    return F.col(column).between(low, high)


def text_matches(column: str, pattern: str) -> Column:
    """Case-insensitive regular expression anywhere in the text; NULL does not match."""
    return F.coalesce(F.col(column).rlike("(?iu)" + pattern), F.lit(False))


def clean_codes(codes: Iterable[str]) -> list[str]:
    """Trimmed, without blanks and repeats, in first-seen order."""
    return list(dict.fromkeys(c.strip() for c in codes if c.strip()))


def split_codes(text: str) -> list[str]:
    return clean_codes(text.split(","))


def code_in(codes: Iterable[str]) -> Column:
    """Exact match on any of the codes; an empty list matches nothing."""
    return F.col("code").isin(clean_codes(codes))


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def code_contains(codes: Iterable[str]) -> Column:
    """Case-insensitive: any of the texts occurs in the code, taken literally."""
    return text_matches("code", "|".join(_quoted(c.strip()) for c in codes))


def price_is_one_of(column: str, prices: Iterable[float]) -> Column:
    return F.col(column).isin(list(prices))


def is_empty(df: DataFrame) -> bool:
    """Reads no more than it takes to find one row."""
    return df.isEmpty()
