"""Column layouts of the snapshot files and of the canonical stock table."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of the canonical table.
CANONICAL = T.StructType([
    T.StructField("abv", T.DoubleType()),
    T.StructField("availability", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("price_gbp", T.DoubleType()),
    T.StructField("price_ex_vat", T.DoubleType()),
    T.StructField("price_incl_vat", T.DoubleType()),
    T.StructField("size", T.StringType()),
    T.StructField("style", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("vintage", T.StringType()),
    T.StructField("import_date", T.DateType()),
])
CANONICAL_COLUMNS = CANONICAL.fieldNames()

# The header spellings under which each column may arrive,
# in order of preference.
HEADER_ALIASES = {
    "abv": ["ABV", "abv"],
    "availability": ["Available", "available", "availability"],
    "code": ["Code", "code"],
    "country": ["Country", "country"],
    "type": ["Group", "type"],
    "url": ["Link", "url"],
    "price_gbp": ["Price (GBP)", "price_gbp"],
    "price_ex_vat": ["Price (ex-VAT)", "price_ex_vat"],
    "price_incl_vat": ["Price (inc VAT)", "price_incl_vat"],
    "size": ["Size", "size"],
    "style": ["Style", "style"],
    "title": ["Title", "title"],
    "vintage": ["Vintage", "vintage"],
}
NUMERIC_COLUMNS = ["abv", "price_gbp", "price_ex_vat", "price_incl_vat"]

# Positions of the newer 12-column layout. All cells are text;
# typing happens when the canonical table is built.
POSITIONAL = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "code", "title", "vintage", "size", "abv", "style", "country", "group_name",
        "available", "price_incl_vat", "price_ex_vat", "link",
    )
])

# The older 8-column layout, canonical name -> source header.
LEGACY_HEADERS = {
    "code": "Code",
    "title": "Title",
    "size": "Size",
    "style": "Style",
    "country": "Country",
    "type": "Group",
    "availability": "Available",
    "price_gbp": "Price (GBP)",
}

# The newer 12-column layout, canonical name -> source header.
CURRENT_HEADERS = {
    "code": "Code",
    "title": "Title",
    "vintage": "Vintage",
    "size": "Size",
    "abv": "ABV",
    "style": "Style",
    "country": "Country",
    "type": "Group",
    "availability": "Available",
    "price_incl_vat": "Price (inc VAT)",
    "price_ex_vat": "Price (ex-VAT)",
    "url": "Link",
}
