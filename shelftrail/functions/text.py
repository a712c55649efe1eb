"""Titles, slugs and entity decoding."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Characters a text editor would call blank: Unicode white space and the four
# ASCII separator controls.
_BLANK = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    # Looking back makes a run of blanks inside the text cost one try, not one per blank.
    return F.regexp_replace(text, rf"(?U)^{_BLANK}++|(?<!{_BLANK}){_BLANK}++\z", "")


def slug_url(title: Column, prefix: str, suffix: str = "") -> Column:
    """Product page address guessed from a title."""
    slug = F.lower(F.replace(title, F.lit(" "), F.lit("-")))
    return F.concat(F.lit(prefix), slug, F.lit(suffix))


def drop_literal(text: Column, literal: str) -> Column:
    return F.replace(text, F.lit(literal), F.lit(""))


def drop_punctuation(text: Column) -> Column:
    """Keep word characters (any script) and white space."""
    return F.regexp_replace(text, r"(?U)[^\w\s\x1c-\x1f]", "")


# Fixed value: a year, or "<number> <word>", or "<word> <number>".
TITLE_PATTERN = r"(\d{4})|(\d+)\s*(\w+)|(\w+)\s*(\d+)"


def _title_group(title: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(title, "(?U)" + TITLE_PATTERN, group), F.lit(""))


def title_distillery(title: Column) -> Column:
    """The word next to the first number of a title; NULL for a bare year."""
    return F.coalesce(_title_group(title, 3), _title_group(title, 4))


def title_age(title: Column, trailing_number: bool = True) -> Column:
    """The first number of a title.

    `trailing_number=False` leaves out the number of a "<word> <number>" match.
    """
    groups = (1, 2, 5) if trailing_number else (1, 2)
    return F.coalesce(*[_title_group(title, g) for g in groups])


def unescape_all(texts: Column) -> Column:
    """HTML entities decoded in every element of a string array.

    Spark has no built-in for the HTML entity table. Only arrays that hold an
    ampersand are handed to Python; all others skip the transfer as NULL.
    """

    # Defined here so that it travels by value and workers need not import this package.
    def decode(items: pd.Series) -> pd.Series:
        return items.map(lambda a: None if a is None else [t if t is None else html.unescape(t) for t in a])

    with_entities = F.when(F.exists(texts, lambda t: F.contains(t, F.lit("&"))), texts)
    return F.coalesce(F.pandas_udf(decode, T.ArrayType(T.StringType()))(with_entities), texts)
