"""Product metadata from a table of web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelftrail.functions import jsonld
from shelftrail.functions.text import unescape_all
from shelftrail.operators.reshape import overlay, with_levels
from shelftrail.session import materialize

# Fixed value: what the shop's item codes start with.
CODE_PREFIX = "HED"


def page_documents(pages: DataFrame, code_prefix: str = CODE_PREFIX) -> DataFrame:
    """Per page: url, JSON-LD objects, og:title, title and the first code in the page.

    What is needed from the HTML is cut out first, so that entity decoding and all
    later steps carry short texts and not whole pages.
    """
    html = F.col("html")
    cut = pages.select(
        "url",
        jsonld.script_blocks(html).alias("blocks"),
        F.array(jsonld.og_title(html), jsonld.page_title(html)).alias("heads"),
        jsonld.find_code(html, code_prefix).alias("page_code"),
    )
    decoded = cut.select(
        "url", "page_code", unescape_all(F.col("blocks")).alias("blocks"),
        unescape_all(F.col("heads")).alias("heads"),
    )
    return decoded.select(
        "url", "page_code",
        jsonld.flatten_graph(jsonld.parse_blocks(F.col("blocks"))).alias("docs"),
        F.col("heads")[0].alias("og"), F.col("heads")[1].alias("title"),
    )


def page_metadata(pages: DataFrame, code_prefix: str = CODE_PREFIX) -> DataFrame:
    """One row per page: url, hed_id, product_name, categories and category_path."""
    docs = F.col("docs")
    found = page_documents(pages, code_prefix).select(
        "url",
        jsonld.product_code(docs, F.col("page_code"), code_prefix).alias("hed_id"),
        jsonld.product_name(docs, F.col("og"), F.col("title")).alias("product_name"),
        jsonld.drop_home(jsonld.breadcrumbs(docs)).alias("crumbs"),
    )
    return found.select(
        "url", "hed_id", "product_name",
        jsonld.categories(F.col("crumbs"), F.col("product_name"), F.col("hed_id")).alias("categories"),
    ).withColumn("category_path", F.array_join("categories", " > "))


def category_depth(metadata: DataFrame) -> int:
    """Longest category list."""
    return metadata.agg(F.max(F.size("categories")).alias("depth")).first()["depth"] or 0


def metadata_table(pages: DataFrame, code_prefix: str = CODE_PREFIX, depth: int | None = None) -> DataFrame:
    """`page_metadata` plus category_level_1 .. N.

    N depends on the data. Unless `depth` states it, the metadata is written to the
    shared folder first, so the pages are read and parsed once, not twice.
    """
    metadata = page_metadata(pages, code_prefix)
    if depth is None:
        metadata = materialize(metadata, "page-metadata")
        depth = category_depth(metadata)
    return with_levels(metadata, "categories", depth, "category_level")


def schema_rows(pages: DataFrame, template: dict[str, str], found: dict[str, str], code_prefix: str = CODE_PREFIX) -> DataFrame:
    """The template's columns for every page, overlaid with what the page states."""
    return overlay(page_metadata(pages, code_prefix), template, found)
