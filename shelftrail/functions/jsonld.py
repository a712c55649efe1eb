"""JSON-LD and head tags of a web page, as column expressions.

Everything stays inside one row of the page table: blocks, graph items and crumbs
are arrays worked on with higher-order functions, so a page is never exploded and
never shuffled, and "the first document that ..." is plain array order.

Spark's JSON functions disagree about repeated keys and NaN, partly by session setting. The
few blocks with either are rewritten as plain JSON before anything else looks at them, so
no result depends on the session.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from shelftrail.functions.text import strip

# Where block, og:title and title sit in a page.
SCRIPT_PATTERN = r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'
OG_TITLE_PATTERN = r'(?id)<meta[^>]+property="og:title"[^>]+content="(.*?)"'
TITLE_PATTERN = r"(?is)<title>(.*?)</title>"

# Product keys that may hold the item code, in order of trust.
CODE_KEYS = ["sku", "mpn", "productID", "productId", "id", "offers"]

# One JSON string token, with its colon when it is an object key. Possessive, so that
# long strings are matched in a loop and not by recursion.
_JSON_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*+:)?'


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def script_blocks(html: Column) -> Column:
    """Raw text of every JSON-LD script, in page order."""
    return F.regexp_extract_all(html, F.lit(SCRIPT_PATTERN), F.lit(1))


def _first_group(html: Column, pattern: str) -> Column:
    """Group 1 of the first match, NULL without one; the page is searched once."""
    return F.regexp_extract(F.regexp_substr(html, F.lit(pattern)), pattern, 1)


def og_title(html: Column) -> Column:
    """Content of og:title; NULL when the tag is absent, '' when it is empty."""
    return _first_group(html, OG_TITLE_PATTERN)


def page_title(html: Column) -> Column:
    return _first_group(html, TITLE_PATTERN)


def _parsed(raw: Column) -> Column:
    """VARIANT of one complete JSON value, else NULL.

    The parser stops at the end of the first value, so the text is wrapped in a
    list: trailing text then breaks the list or makes it longer than one.
    """
    wrapped = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))), "$", "array<variant>"
    )
    return F.when(F.size(wrapped) == 1, wrapped[0])


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def _pairs(raw_list: Column, values: Column) -> Column:
    """The object elements of a JSON list as (raw text, VARIANT) pairs."""
    raws = F.from_json(raw_list, "array<string>")
    pairs = F.zip_with(raws, values, lambda r, v: F.struct(r.alias("raw"), v.alias("doc")))
    return F.filter(pairs, lambda p: F.coalesce(_is_object(p["doc"]), F.lit(False)))


_PAIR = "struct<raw:string,doc:variant>"


def _unfold(pair: Column, values: Column, raw_list: Column) -> Column:
    """A list becomes its objects; a single object becomes itself."""
    single = F.when(
        F.coalesce(_is_object(pair["doc"]), F.lit(False)), F.array(pair)
    ).otherwise(_empty(_PAIR))
    return F.when(values.isNotNull(), _pairs(raw_list, values)).otherwise(single)


def _keys(text: Column) -> Column:
    """Number of object keys, at any depth, in JSON text."""
    return F.size(F.filter(F.regexp_extract_all(text, F.lit(_JSON_STRING), F.lit(0)), lambda t: t.endswith(":")))


def _is_odd(raw: Column) -> Column:
    """Whether text isn't read by Spark's parser, or loses keys when it is (where a session allows repeated keys)."""
    doc = _parsed(raw)
    return (raw != "") & (doc.isNull() | (_keys(raw) != _keys(doc.cast("string"))))


def plain_json(blocks: Column) -> Column:
    """JSON texts without repeated keys, NaN and Infinity, in an array; malformed ones become NULL.

    Of a repeated key the last value counts, at the place of the first; NaN and Infinity
    become null. Which object a key belongs to is a matter of nesting, which built-in
    functions can't follow in one pass, so arrays that hold an odd text, and no others, are
    handed to Python.
    """

    # Defined here so that it travels by value and workers need not import this package.
    def rewrite(items: pd.Series) -> pd.Series:
        def number(text: str):
            value = float(text)
            return value if math.isfinite(value) else None

        def plain(text: str | None) -> str | None:
            try:
                whole = lambda digits: int(digits) if len(digits) < 4000 else None
                return json.dumps(json.loads(text, parse_constant=lambda _: None, parse_float=number, parse_int=whole))
            except (ValueError, TypeError, RecursionError):
                return None

        return items.map(lambda a: None if a is None else [plain(t) for t in a])

    odd = F.when(F.exists(blocks, _is_odd), blocks)
    return F.coalesce(F.pandas_udf(rewrite, T.ArrayType(T.StringType()))(odd), blocks)


def parse_blocks(blocks: Column) -> Column:
    """Block texts to top-level objects; blank and malformed blocks vanish."""
    plain = plain_json(F.transform(blocks, strip))
    pairs = F.transform(plain, lambda b: F.struct(b.alias("raw"), _parsed(b).alias("doc")))
    pairs = F.filter(pairs, lambda p: p["doc"].isNotNull())
    return F.flatten(F.transform(
        pairs, lambda p: _unfold(p, F.try_variant_get(p["doc"], "$", "array<variant>"), p["raw"])
    ))


def flatten_graph(objects: Column) -> Column:
    """Objects with an @graph list become the objects of that list."""
    return F.flatten(F.transform(
        objects,
        lambda p: _unfold(
            p,
            F.try_variant_get(p["doc"], '$["@graph"]', "array<variant>"),
            F.get_json_object(p["raw"], "$['@graph']"),
        ),
    ))


def type_names(doc: Column) -> Column:
    """@type as a list of strings, whether given as text or as a list."""
    value = F.try_variant_get(doc, '$["@type"]', "variant")
    one = F.when(
        F.schema_of_variant(value) == "STRING", F.array(F.try_variant_get(doc, '$["@type"]', "string"))
    )
    return F.coalesce(F.try_variant_get(doc, '$["@type"]', "array<string>"), one, _empty("string"))


def of_type(docs: Column, name: str) -> Column:
    return F.filter(docs, lambda p: F.array_contains(type_names(p["doc"]), name))


def _text_at(doc: Column, path: str) -> Column:
    """A value only if it really is JSON text (a number gives NULL)."""
    return F.when(
        F.schema_of_variant(F.try_variant_get(doc, path, "variant")) == "STRING",
        F.try_variant_get(doc, path, "string"),
    )


def first_match(values: Column) -> Column:
    """First non-NULL element of an array; NULL when there is none."""
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def find_code(text: Column, prefix: str) -> Column:
    """First item code in free text, upper case."""
    return F.upper(F.nullif(F.regexp_extract(text, rf"(?iuU)\b{prefix}\d{{3,}}\b", 0), F.lit("")))


def _code_in_json(value: Column, prefix: str) -> Column:
    """First item code in a JSON value: its text, or its strings in document order.

    Works on the raw text because a VARIANT sorts its keys; key names are skipped.
    """
    strings = F.filter(F.regexp_extract_all(value, F.lit(_JSON_STRING), F.lit(0)), lambda t: ~t.endswith(":"))
    nested = first_match(F.transform(
        strings,
        lambda t: find_code(F.get_json_object(F.concat(F.lit("["), t, F.lit("]")), "$[0]"), prefix),
    ))
    return F.when(F.substring(value, 1, 1).isin("{", "["), nested).otherwise(find_code(value, prefix))


def product_code(docs: Column, in_page: Column, prefix: str) -> Column:
    """Code from the first Product that has one, else the one found in the page."""
    fields = F.transform(
        of_type(docs, "Product"), lambda p: F.map_entries(F.from_json(p["raw"], "map<string,string>"))
    )

    def last(entries: Column, key: str) -> Column:
        return F.try_element_at(F.filter(entries, lambda e: e["key"] == key), F.lit(-1))["value"]

    values = F.flatten(F.transform(fields, lambda f: F.array(*[last(f, key) for key in CODE_KEYS])))
    return F.coalesce(first_match(F.transform(values, lambda v: _code_in_json(v, prefix))), in_page)


def product_name(docs: Column, og: Column, title: Column) -> Column:
    """Product.name, else og:title, else the page title."""
    names = F.transform(
        of_type(docs, "Product"), lambda p: F.nullif(strip(_text_at(p["doc"], "$.name")), F.lit(""))
    )
    return F.coalesce(first_match(names), strip(og), strip(title))


def breadcrumbs(docs: Column) -> Column:
    """Crumb names of the first BreadcrumbList that has any."""
    def names(pair: Column) -> Column:
        items = F.try_variant_get(pair["doc"], "$.itemListElement", "array<variant>")
        crumbs = F.transform(items, lambda i: F.when(
            F.try_variant_get(i, "$.name", "variant").isNotNull(), _text_at(i, "$.name")
        ).otherwise(_text_at(i, "$.item.name")))
        return F.transform(F.filter(crumbs, lambda c: c.isNotNull()), strip)

    lists = F.filter(F.transform(of_type(docs, "BreadcrumbList"), names), lambda c: F.size(c) > 0)
    return F.coalesce(F.get(lists, F.lit(0)), _empty("string"))


def drop_home(crumbs: Column) -> Column:
    return F.filter(crumbs, lambda c: F.lower(c) != "home")


def categories(crumbs: Column, name: Column, code: Column) -> Column:
    """Crumbs without the product itself at the end, closed by the code."""
    last = F.get(crumbs, F.size(crumbs) - 1)
    ends_in_name = F.coalesce((name != "") & (F.lower(last) == F.lower(name)), F.lit(False))
    kept = F.slice(crumbs, F.lit(1), F.size(crumbs) - ends_in_name.cast("int"))
    closing = F.when(code.isNotNull() & ~F.array_contains(kept, code), F.array(code))
    return F.concat(kept, F.coalesce(closing, _empty("string")))
