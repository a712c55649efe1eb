"""JSON-LD, head tags and category lists of small pages."""

import json

import pytest
from pyspark.sql import functions as F

from shelftrail.functions.jsonld import plain_json
from shelftrail.plans.metadata import metadata_table, page_metadata, schema_rows


def block(value, attrs='type="application/ld+json"', tag="script"):
    text = value if isinstance(value, str) else json.dumps(value)
    return f"<{tag} {attrs}>{text}</{tag}>"


def product(**fields):
    return {"@type": "Product", **fields}


def crumbs(*names, type_="BreadcrumbList"):
    return {"@type": type_, "itemListElement": [{"@type": "ListItem", "name": n} for n in names]}


# html -> (code, name, category path)
CASES = {
    "plain product": (block(product(name=" Dram ", sku="hed12345")), ("HED12345", "Dram", "HED12345")),
    "code by key order, not document order": (
        block(product(mpn="HED222", sku="HED111", name="x")), ("HED111", "x", "HED111")),
    "first product with a code": (
        block([product(name="a"), product(name="b", id="HED333")]), ("HED333", "a", "HED333")),
    "code in nested offers, in document order": (
        block(product(name="x", offers={"z": {"k": "HED900"}, "a": "HED100"})), ("HED900", "x", "HED900")),
    "code as a key name does not count": (
        block(product(name="x", offers={"HED555": "none", "b": ["-", "HED556"]})), ("HED556", "x", "HED556")),
    "too few digits, then whole page": (block(product(sku="HED12")) + "<p>see hed777.</p>", ("HED777", None, "HED777")),
    "no word boundary": ("<p>XHED777 HED7778x</p>", (None, None, "")),
    "escaped text in nested values": (
        block('{"@type":"Product","name":"x","offers":{"d":"say \\"HED\\"\\nHED444 \\u00e9"}}'), ("HED444", "x", "HED444")),
    "keys differing in case": (
        block(product(name="x", productId="HED002", productID="HED001")), ("HED001", "x", "HED001")),
    "null and false values": (block(product(name="x", sku=None, mpn=False, id=["HED003"])), ("HED003", "x", "HED003")),
    "number is no code": (block(product(name="x", sku=12345)), (None, "x", "")),
    "graph": (
        block({"@graph": [crumbs("Home", " Spirits ", "X"), product(name="X", sku="HED001")]}),
        ("HED001", "X", "Spirits > HED001")),
    "graph that is no list": (block({"@graph": {}, "@type": "Product", "name": "g"}), (None, "g", "")),
    "type as list": (block({"@type": ["Thing", "Product"], "name": "n"}), (None, "n", "")),
    "item.name and odd items": (
        block({"@type": "BreadcrumbList", "itemListElement": [
            "text", {"item": {"name": "A"}}, {"name": None, "item": {"name": "no"}}, {"name": 5}, {"item": "no"}, {"name": "HOME"}]}),
        (None, None, "A")),
    "first list with names": (
        block([crumbs(), crumbs("A", "B"), crumbs("C")]), (None, None, "A > B")),
    "name at the end, any case": (
        block([crumbs("A", "dram"), product(name="DRAM")]), (None, "DRAM", "A")),
    "code already there": (
        block([crumbs("A", "HED123", "B"), product(name="x", sku="HED123")]), ("HED123", "x", "A > HED123 > B")),
    "malformed block is skipped": (
        block('{"@type":"Product",}') + block("") + block('{"@type":"Product","name":"y"} tail') + block(product(name="ok")), (None, "ok", "")),
    "entities in the block": (
        block('{&quot;@type&quot;:&quot;Product&quot;,&quot;name&quot;:&quot;A &amp;amp; B&quot;}'), (None, "A &amp; B", "")),
    "upper case tag, other attributes": (
        block(product(name="u"), 'id="1" TYPE="application/ld+json" async', "SCRIPT"), (None, "u", "")),
    "other script type": (block(product(name="u"), 'type="text/javascript"') + "<title>t</title>", (None, "t", "")),
    "og before title": (
        '<title>t</title><meta name="a" property="og:title" content="O &amp; G ">', (None, "O & G", "")),
    "empty og wins over title": ('<meta property="og:title" content=""><title>t</title>', (None, "", "")),
    "blank product name": (block(product(name="  ")) + "<TITLE>\n T&eacute; \n</TITLE>", (None, "Té", "")),
    "repeated key, the last counts": (
        block('{"@type":"Product","name":"x","sku":"HED111","sku":"HED222"}'), ("HED222", "x", "HED222")),
    "repeated key in a nested value": (
        block('{"@type":"Product","name":"x","offers":{"sku":"HED111","sku":"HED222"}}'), ("HED222", "x", "HED222")),
    "repeated key whose dropped value occurs elsewhere": (
        block('{"@type":"Product","name":"x","description":"not HED111","offers":{"sku":"HED111","gtin":"HED333","sku":"HED222"},"note":"HED111"}'),
        ("HED222", "x", "HED222")),
    "repeated key takes the place of the first": (
        block('{"@type":"Product","name":"x","offers":{"a":"-","b":"HED222","a":"HED111"}}'), ("HED111", "x", "HED111")),
    "repeated key holding objects": (
        block('{"@type":"Product","name":"x","offers":{"o":{"sku":"HED111"},"o":{"k":"-"},"z":"HED222"}}'), ("HED222", "x", "HED222")),
    "equal keys of different objects": (
        block('{"@type":"Product","name":"x","offers":[{"sku":"-"},{"sku":"HED111"},{"sku":"HED222"}]}'), ("HED111", "x", "HED111")),
    "repeated key spelt differently": (
        block('{"@type":"Product","name":"x","offers":{"sku":"HED111","s\\u006bu":"HED222"}}'), ("HED222", "x", "HED222")),
    "repeated type and name": (
        block('{"@type":"Thing","@type":"Product","name":"x","name":"y","sku":"HED111"}'), ("HED111", "y", "HED111")),
    "repeated graph": (
        block('{"@graph":[{"@type":"Product","name":"old"}],"@graph":[{"@type":"Product","name":"new"}]}'), (None, "new", "")),
    "NaN inside text stays": (
        block('{"@type":"Product","name":"a, NaN, b","price":NaN}'), (None, "a, NaN, b", "")),
    "odd and plain blocks together": (
        block(product(name="first", sku="HED555")) + block('{"@type":"Product","sku":"HED1","sku":"HED666"}'), ("HED555", "first", "HED555")),
    "colon in text, key-like text": (
        block('{"@type":"Product","name":"\\"sku\\": \\"HED111\\"","offers":{"sku":"x:"},"id":"HED222"}'), ("HED222", '"sku": "HED111"', "HED222")),
    "not a number, infinity": (
        block('{"@type":"Product","name":"n","price":NaN,"low":-Infinity,"all":[Infinity, NaN],"sku":"HED300"}'), ("HED300", "n", "HED300")),
    "nothing": ("<p></p>", (None, None, "")),
}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(name, html) for name, (html, _) in CASES.items()], "url string, html string").cache()


@pytest.fixture(scope="module")
def found(pages):
    return {r["url"]: r for r in page_metadata(pages).collect()}


@pytest.mark.parametrize("name", CASES)
def test_page(found, name):
    r = found[name]
    assert (r["hed_id"], r["product_name"], r["category_path"]) == CASES[name][1]


@pytest.mark.parametrize("setting", ["true", "false"])
def test_pages_do_not_depend_on_the_session(spark, pages, setting):
    """Neither on whether Spark allows repeated keys nor on who made the session."""
    other = spark.newSession()
    other.conf.set("spark.sql.variant.allowDuplicateKeys", setting)
    again = other.createDataFrame([(r["url"], r["html"]) for r in pages.collect()], "url string, html string")
    got = {r["url"]: (r["hed_id"], r["product_name"], r["category_path"]) for r in page_metadata(again).collect()}
    assert got == {name: expected for name, (_, expected) in CASES.items()}


def test_plain_pages_skip_python(spark):
    """Only arrays with an odd block are handed over."""
    texts = [['{"a": {"b": 1}, "c": [{"b": 2}]}', ""], [' {"a":1}'.strip()], ['{"a":1,"a":2}', '{"b":NaN}', '{"c":', '{"d": 1}']]
    df = spark.createDataFrame([(t,) for t in texts], "blocks array<string>").select(plain_json(F.col("blocks")).alias("b"))
    assert [r["b"] for r in df.collect()] == [texts[0], texts[1], ['{"a": 2}', '{"b": null}', None, '{"d": 1}']]


def test_long_values(spark):
    """Long strings, many escapes and long runs of blanks neither overflow nor crawl."""
    long = 'a\\"b ' * 100_000
    doc = product(name="n", offers={"description": long, "more": ["HED4321"]})
    html = block(json.dumps(doc) + " " * 100_000) + "<title>" + " " * 100_000 + "t</title>"
    row = page_metadata(spark.createDataFrame([("u", html)], "url string, html string")).first()
    assert (row["hed_id"], row["product_name"]) == ("HED4321", "n")


def test_levels_follow_the_longest_list(pages):
    table = metadata_table(pages)
    assert [c for c in table.columns if c.startswith("category_level")] == [f"category_level_{i}" for i in (1, 2, 3)]
    row = table.where("url = 'code already there'").first()
    assert (row["category_level_1"], row["category_level_3"]) == ("A", "B")
    assert "category_level_2" not in metadata_table(pages, depth=1).columns


def test_other_prefix(spark):
    pages = spark.createDataFrame([("u", "<p>HED123 ab1234</p>")], "url string, html string")
    assert page_metadata(pages, "AB").first()["hed_id"] == "AB1234"


def test_schema_rows(pages):
    template = {"url": "tu", "item_id": "t1", "name": "tn", "cask": "Oak"}
    rows = {r["url"]: r for r in schema_rows(pages, template, {"url": "url", "item_id": "hed_id", "name": "product_name"}).collect()}
    assert tuple(rows["nothing"]) == ("nothing", "t1", "tn", "Oak")
    assert tuple(rows["plain product"]) == ("plain product", "HED12345", "Dram", "Oak")
