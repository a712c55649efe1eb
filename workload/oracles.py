"""DuckDB SQL with the same result as each query, over the driver's views.

Written from the reports' definitions: what a row means is counted, ranked or compared
in whatever way is plainest here, which is neither how the Spark plans go about it nor
how such reports are usually written.
"""

from __future__ import annotations

from workload.fixtures import DIRTY_SQL, DUCK_DAYS, EVENT_STOCKS_SQL, LINE_STOCKS_SQL, MOVED_UP_SQL, PAGES_SQL, PRODUCT_TYPE

_STOCKS = EVENT_STOCKS_SQL.format(events="events", part="part", nation="nation")
_MOVED_UP = MOVED_UP_SQL.format(stocks=f"({_STOCKS})", days=DUCK_DAYS)
_DIRTY = DIRTY_SQL.format(stocks=f"({_STOCKS})")
_LINES = LINE_STOCKS_SQL.format(lineitem="lineitem")
_PAGES = PAGES_SQL.format(pages="pages")

_VIEW = """
SELECT abv, availability, code, country, type, url, coalesce(price_gbp, price_incl_vat) AS price_gbp,
       coalesce(price_ex_vat, 0) AS price_ex_vat, coalesce(price_incl_vat, 0) AS price_incl_vat,
       size, style, title, vintage, import_date
FROM stocks"""

_COMMON = """,
day_prices AS (SELECT code, import_date, median(price_gbp) AS m FROM w GROUP BY code, import_date),
-- Medians in order of size: each one that differs from the next smaller is a new price.
steps AS (SELECT code, m, lag(m) OVER (PARTITION BY code ORDER BY m NULLS LAST) AS smaller FROM day_prices),
changes AS (SELECT code, count(*) FILTER (m IS NOT NULL AND m IS DISTINCT FROM smaller) AS price_changes_count FROM steps GROUP BY code),
-- How many rows of a code had how many units on a day.
levels AS (SELECT code, import_date, coalesce(TRY_CAST(availability AS DOUBLE), 0) AS units, count(*) AS copies FROM w GROUP BY ALL)"""


def _stocks(sql: str) -> str:
    return f"WITH stocks AS ({_STOCKS}) {sql}"


def _w(sql: str) -> str:
    return f"WITH stocks AS ({_STOCKS}), w AS ({_VIEW} WHERE type = '{PRODUCT_TYPE}'){_COMMON} {sql}"


def _lines(sql: str) -> str:
    return f"WITH stocks AS ({_LINES}), w AS ({_VIEW} WHERE type = 'line'){_COMMON} {sql}"


def _pages(sql: str) -> str:
    return f"WITH p AS ({_PAGES}) {sql}"


_TODAY = "SELECT import_date, code, title, price_gbp, url FROM w WHERE import_date = DATE '{day}'"


def _units(days: str, how: str = "LEFT", counts: str = ", price_changes_count") -> str:
    """Rows of the earlier days, each as often as the code has rows with fewer units a day later."""
    return f"""
SELECT e.import_date + 1 AS import_date, e.code, title, url, price_gbp, coalesce(l.units, 0) AS availability,
       e.units - coalesce(l.units, 0) AS units_sold{counts}
FROM (SELECT *, coalesce(TRY_CAST(availability AS DOUBLE), 0) AS units FROM w WHERE {days}) e
{how} JOIN levels l ON l.code = e.code AND l.import_date - 1 = e.import_date
LEFT JOIN changes ON changes.code = e.code,
unnest(range(coalesce(copies, 1)))
WHERE e.units > coalesce(l.units, 0)"""


def _units_all(how: str) -> str:
    return _units("import_date + 1 IN (SELECT import_date FROM w)", how)


def _units_day(day: str, counts: str = ", price_changes_count") -> str:
    return _units(f"import_date = DATE '{day}' - 1", counts=counts)


_MOVED = """
SELECT DATE '2024-01-30' AS import_date, code, title, url, price_gbp, CAST(now AS DOUBLE) AS availability,
       CAST(availability AS DOUBLE) - CAST(now AS DOUBLE) AS units_sold
FROM (SELECT code, availability AS now, count(*) AS copies FROM w WHERE import_date = DATE '2024-01-30' GROUP BY ALL)
JOIN w USING (code), unnest(range(copies))
WHERE import_date = DATE '2024-01-29' AND now <> availability"""


def _discounts(day: str, plain: bool = False, until: str = "9999-01-01") -> str:
    """Offers of a day beside the highest price their code ever had, by one window."""
    fraction = "(old_price - price_gbp) / nullif(old_price, 0)"
    saving = f"round({fraction}, 4) * 100" if plain else f"round({fraction} * 100, 4)"
    return f"""
SELECT import_date AS {'"current_date"' if plain else 'current_import_date'}, code, title, url,
       price_gbp AS current_price, old_price, old_price - price_gbp AS discount, {saving} AS perc_saving
       {'' if plain else ', price_changes_count'}
FROM (SELECT *, max(price_gbp) FILTER (import_date <= DATE '{until}') OVER (PARTITION BY code) AS old_price FROM w)
LEFT JOIN changes USING (code)
WHERE import_date = {day} AND old_price > price_gbp AND code IS NOT NULL"""


_DISCOUNTS = _discounts("DATE '2024-01-30'")

_PLAIN_DISCOUNTS = _discounts("DATE '2024-01-30'", plain=True)


def _daily(median: str = "median(price_gbp)", date: str = "import_date") -> str:
    return f"""
SELECT count(*) AS stock_count, {median} AS median_price,
       sum(TRY_CAST(availability AS DOUBLE)) AS total_availability, {date} AS import_date
FROM w GROUP BY w.import_date"""


def _series(median: str = "median(price_gbp)", where: str = "true") -> str:
    """Per day and code; the changes of a code are the largest gapless rank among its medians."""
    return f"""
SELECT median_price, total_availability, import_date, code,
       coalesce(max(place) OVER (PARTITION BY code), 0) AS price_changes_count
FROM (SELECT *, CASE WHEN median_price IS NOT NULL THEN dense_rank() OVER (PARTITION BY code ORDER BY median_price NULLS LAST) END AS place
      FROM (SELECT code, import_date, {median} AS median_price, sum(TRY_CAST(availability AS DOUBLE)) AS total_availability
            FROM w WHERE {where} AND code IS NOT NULL GROUP BY ALL))"""


_SEARCH = f"""
SELECT c.import_date, c.code, c.title, c.price_gbp, c.url, changes.price_changes_count
FROM ({_TODAY.format(day='2024-01-30')}) c LEFT JOIN changes ON c.code = changes.code"""

_RANKS = """
SELECT code, price_gbp, 1 + cheaper AS price_rank, row_count, first_date
FROM (SELECT *, coalesce(sum(row_count) OVER (PARTITION BY code ORDER BY price_gbp NULLS LAST
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cheaper
      FROM (SELECT code, price_gbp, count(*) AS row_count, min(import_date) AS first_date FROM w GROUP BY ALL))
WHERE cheaper < 2"""


def _new_low(day: str) -> str:
    """Offers of a day that no other row of their code, whatever its day, matches or undercuts."""
    return f"""
SELECT code, title, url, price AS current_minimum_price, DATE '{day}' AS "current_date", above AS previous_price,
       (SELECT min(import_date) FROM w WHERE w.code = n.code AND w.price_gbp = above) AS previous_date,
       above - price AS price_diff, (above - price) / above * 100 AS perc_saving
FROM (SELECT o.code, o.title, o.url, o.price_gbp AS price, count(*) FILTER (w.price_gbp <= o.price_gbp) AS as_low,
             min(w.price_gbp) FILTER (w.price_gbp > o.price_gbp) AS above
      FROM w JOIN w o ON o.code = w.code AND o.import_date = DATE '{day}' GROUP BY ALL) n
WHERE as_low = 1 AND above IS NOT NULL"""


_DAY = "SELECT * FROM stocks WHERE import_date = DATE '2024-01-30'"
_LISTED = f"(SELECT *, count(*) OVER (PARTITION BY code) AS listed FROM ({_DAY}))"
_AVERAGED = f"""
SELECT code, title, size, style, country, type, round(avg(TRY_CAST(availability AS DOUBLE)), 0) AS availability,
       round(avg(price_gbp), 6) AS price_gbp
FROM {_LISTED} WHERE listed > 1 AND code IS NOT NULL GROUP BY ALL"""
_AVERAGED_TEXT = f"SELECT * REPLACE (CAST(CAST(availability AS BIGINT) AS VARCHAR) AS availability) FROM ({_AVERAGED})"
_KEPT = f"SELECT * EXCLUDE (listed) FROM {_LISTED} WHERE listed = 1 OR code IS NULL"
_REPAIRED = f"{_KEPT} UNION ALL BY NAME SELECT *, DATE '2024-01-30' AS import_date FROM ({_AVERAGED_TEXT})"

_SAME_TITLE = """
SELECT DISTINCT code, title, price_gbp, url
FROM (SELECT *, min(code) OVER t AS one, max(code) OVER t AS other FROM w WINDOW t AS (PARTITION BY title))
WHERE one <> other AND title IS NOT NULL"""

_AUDIT = """
SELECT code, import_date, price_gbp, price_incl_vat, coalesce(price_gbp, price_incl_vat) AS unified_price,
       coalesce(price_incl_vat, 0) AS filled_price_incl_vat
FROM stocks WHERE price_incl_vat IS NULL"""

_TITLE = r"(\d{4})|(\d+)\s*(\w+)|(\w+)\s*(\d+)"


def _title_features(age_groups: tuple[int, ...]) -> str:
    def group(n: int) -> str:
        return f"nullif(regexp_extract(title, '{_TITLE}', {n}), '')"

    ages = ", ".join(group(n) for n in age_groups)
    return f"""
SELECT code, title, import_date, coalesce({group(3)}, {group(4)}) AS distillery, coalesce({ages}) AS year_age FROM w"""


_NEWER = "SELECT * REPLACE (CAST(NULL AS DOUBLE) AS price_gbp) FROM stocks"

_CLEAN_TITLE = """
trim(regexp_replace(regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1, 'is'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'))"""

_NUMBER = "lpad(CAST(page_id AS VARCHAR), 5, '0')"
_CODE = f"""CASE page_id % 8 WHEN 2 THEN NULL WHEN 5 THEN 'HED8' || {_NUMBER} WHEN 7 THEN 'HED9' || {_NUMBER} ELSE 'HED' || {_NUMBER} END"""
_NAME = f"""CASE page_id % 8 WHEN 2 THEN {_CLEAN_TITLE} WHEN 3 THEN 'First ' || page_id WHEN 4 THEN 'Salt & Sons ' || page_id
    ELSE 'Item ' || page_id END"""
_LEVELS = f"""CASE page_id % 8 WHEN 1 THEN ['Spirits', 'Cat ' || (page_id % 5)] WHEN 6 THEN ['Shop'] ELSE [] END || CASE WHEN page_id % 8 = 2 THEN [] ELSE [{_CODE}] END"""

_EXPORT = ["code", "title", "size", "style", "country", "type", "availability", "price_gbp"]

ORACLES = {
    # ingest
    "ingest_by_name": _stocks("SELECT * FROM stocks"),
    "ingest_positional": _stocks("SELECT * FROM stocks"),
    "raw_by_name": _stocks(
        "SELECT import_date, count(*) AS row_count, count(price_gbp) AS old_prices,"
        " count(price_incl_vat) AS new_prices, count(url) AS links FROM stocks GROUP BY import_date"
    ),
    "legacy_flags": _stocks(
        "SELECT import_date, import_date < DATE '2024-01-16' AS is_legacy_schema, count(*) AS row_count"
        " FROM stocks GROUP BY import_date"
    ),
    "typed_csv": _stocks("SELECT code, CAST(availability AS INTEGER) AS availability, import_date FROM stocks"),
    # Written in the newer layout, which has no price_gbp column.
    "incremental_ingest": _stocks(
        "SELECT * REPLACE (CAST(NULL AS DOUBLE) AS price_gbp,"
        " CASE WHEN import_date = DATE '2024-01-20' THEN '0' ELSE availability END AS availability) FROM stocks"
    ),
    # Part files that land in a later run, and folders whose part files share their names.
    "late_part_file": _stocks(_NEWER),
    "new_files_in_folders": _stocks(
        "SELECT import_date, count(*) AS row_count FROM stocks WHERE import_date > DATE '2024-01-20' GROUP BY import_date"
    ),
    "incremental_by_name": _stocks(
        "SELECT * REPLACE (CASE WHEN TRY_CAST(availability AS INT) % 5 = 0 THEN NULL ELSE price_gbp END AS price_gbp) FROM stocks"
    ),
    "new_files": _stocks(
        "SELECT import_date, count(*) AS row_count FROM stocks WHERE import_date >= DATE '2024-01-16' GROUP BY import_date"
    ),
    # tables and sinks
    "parquet_day": _stocks(_DAY),
    "named_views": _w(_TODAY.format(day="2024-01-30")),
    "replaced_table": _stocks("SELECT code, title, import_date FROM stocks"),
    "appended_rows": _stocks("SELECT * FROM stocks"),
    "partition_reload": _stocks(
        "SELECT * REPLACE (CASE WHEN import_date = DATE '2024-01-30' THEN round(price_incl_vat + 1, 2)"
        " ELSE price_incl_vat END AS price_incl_vat) FROM stocks"
    ),
    "csv_export": _w(_units_day("2024-01-30")),
    "csv_by_day": _stocks("SELECT code, title, availability, import_date FROM stocks"),
    # views
    "canonical_stocks": _stocks("SELECT * FROM stocks"),
    "product_view": _w("SELECT * FROM w"),
    "today_view": _w(_TODAY.format(day="2024-01-30")),
    # history and movement
    "price_changes": _w("SELECT * FROM changes"),
    "price_changes_approx": _w(
        "SELECT code, count(DISTINCT m) AS price_changes_count FROM"
        " (SELECT code, quantile_disc(price_gbp, 0.5) AS m FROM w GROUP BY code, import_date) GROUP BY code"
    ),
    "units_sold_all": _w(_units_all("LEFT")),
    "versioned_days": _stocks("SELECT * FROM stocks WHERE import_date <> DATE '2024-01-30'"),
    "units_sold_bucketed": _w(_units_all("LEFT")),
    "clustered_view": _w("SELECT * FROM w"),
    "units_sold_all_present": _w(_units_all("INNER")),
    "units_sold_by_date": _w(_units_day("2024-01-30")),
    "units_sold_missing_day": _w(_units_day("2024-01-31")),
    "units_moved": _w(_MOVED),
    "units_sold_no_vanished": _w(f"SELECT * FROM ({_MOVED}) WHERE units_sold > 0"),
    "units_sold_counted": _w(
        f"SELECT *, count(*) AS copies FROM ({_units_all('LEFT')}) GROUP BY ALL"
    ),
    "units_sold_by_date_plain": _w(_units_day("2024-01-30", counts="")),
    "price_search_plain": _w(_TODAY.format(day="2024-01-30")),
    # the default day, on days moved so that the last is the current date
    "discounted_items_today": _w(_discounts("current_date")).replace(_STOCKS, _MOVED_UP),
    "units_sold_today": _w(_units("import_date = current_date - 1")).replace(_STOCKS, _MOVED_UP),
    # unreadable and missing numbers
    "dirty_units_sold_all": _w(_units_all("LEFT")).replace(_STOCKS, _DIRTY),
    "dirty_daily_summary": _w(_daily()).replace(_STOCKS, _DIRTY),
    "dirty_code_series": _w(_series()).replace(_STOCKS, _DIRTY),
    "dirty_discounted_items": _w(_DISCOUNTS).replace(_STOCKS, _DIRTY),
    "dirty_price_ranks": _w(_RANKS).replace(_STOCKS, _DIRTY),
    # reports
    "discounted_items": _w(_DISCOUNTS),
    "maintained_discounts": _w(_DISCOUNTS),
    "discounted_items_plain": _w(_PLAIN_DISCOUNTS),
    "discounted_items_until": _w(_discounts("DATE '2024-01-20'", plain=True, until="2024-01-20")),
    "discount_screen": _w(
        f"SELECT * FROM ({_DISCOUNTS}) WHERE discount BETWEEN 10 AND 500 AND perc_saving > 10"
        " AND regexp_matches(title, '(?i)small|hot')"
    ),
    "discount_alert": _w(f"SELECT * FROM ({_DISCOUNTS}) WHERE current_price <= 50"),
    "discounts_by_title": _w(
        f"SELECT title, round(sum(current_price), 2) AS current_price FROM ({_DISCOUNTS}) GROUP BY title"
    ),
    "daily_stock_summary": _w(_daily()),
    "daily_stock_summary_approx": _w(_daily("quantile_disc(price_gbp, 0.5)")),
    "daily_stock_summary_text": _w(_daily(date="strftime(w.import_date, '%Y-%m-%d')")),
    "daily_counts_and_medians": _w(
        "SELECT count(*) AS stock_count, median(price_gbp) AS median_price, import_date FROM w GROUP BY import_date"
    ),
    "daily_long": _w(
        "SELECT import_date, 'stock_count' AS legend, CAST(count(*) AS DOUBLE) AS value FROM w GROUP BY import_date"
        " UNION ALL SELECT import_date, 'median_price', median(price_gbp) FROM w GROUP BY import_date"
    ),
    "code_series": _w(_series(where="code IN ('SKU00001', 'SKU00002', 'SKU00003')")),
    "code_series_all": _w(_series()),
    "maintained_series": _w(_series()),
    "maintained_new_lows": _w(_new_low("2024-01-30")),
    "maintained_history": _w("""
        SELECT code, count(DISTINCT middle) AS price_changes_count, max(highest) AS max_price
        FROM (SELECT code, import_date, median(price_gbp) AS middle, max(price_gbp) AS highest FROM w GROUP BY code, import_date) GROUP BY code"""),
    "code_series_approx": _w(_series("quantile_disc(price_gbp, 0.5)")),
    "code_series_contains": _w(_series(where="lower(code) LIKE '%sku00001%' OR code LIKE '%0007%'")),
    "price_search": _w(_SEARCH),
    "price_search_screen": _w(
        f"SELECT * FROM ({_SEARCH}) WHERE price_gbp BETWEEN 0 AND 5000 AND regexp_matches(title, '(?i)SMALL')"
    ),
    "max_price_by_title": _w("SELECT title, max(price_gbp) AS price_gbp FROM w GROUP BY title"),
    "max_price_screen": _w(
        "SELECT * FROM (SELECT title, max(price_gbp) AS price_gbp FROM w GROUP BY title)"
        " WHERE price_gbp BETWEEN 50 AND 5000 AND regexp_matches(title, '(?i)ring')"
    ),
    "price_ranks": _w(_RANKS),
    "new_low_today": _w(_new_low("2024-01-30")),
    "totals": _w(
        "SELECT count(*) AS row_count, round(sum(price_gbp), 2) AS price_sum, round(avg(price_gbp), 6) AS price_avg FROM w"
    ),
    # quality
    "row_counts": _stocks("SELECT import_date, count(*) AS row_count FROM stocks GROUP BY import_date"),
    "snapshot_days": _stocks("SELECT DISTINCT import_date AS target_date FROM stocks"),
    "duplicate_codes": _stocks(
        f"SELECT code, count(*) AS duplicate_count FROM ({_DAY}) GROUP BY code HAVING count(*) > 1"
    ),
    "duplicate_repair": _stocks(_AVERAGED),
    "repaired_day": _stocks(_REPAIRED),
    "repair_written_back": _stocks(f"{_REPAIRED} UNION ALL BY NAME SELECT * FROM stocks WHERE import_date <> DATE '2024-01-30'"),
    "emptied_day": _stocks("SELECT * FROM stocks WHERE import_date <> DATE '2024-01-30'"),
    "delete_keys": _stocks(_KEPT),
    "union_replace": _stocks(f"SELECT {', '.join(_EXPORT)} FROM ({_KEPT}) UNION ALL BY NAME {_AVERAGED_TEXT}"),
    "duplicate_titles": _w(_SAME_TITLE),
    "price_points": _w(
        "SELECT DISTINCT code, title, price_gbp, url FROM w, (SELECT min(price_gbp) AS lo, max(price_gbp) AS hi FROM w)"
        " WHERE price_gbp = lo OR price_gbp = hi"
    ),
    "null_price_audit": _stocks(f"{_AUDIT} AND type = '{PRODUCT_TYPE}'"),
    "null_price_audit_stocks": _stocks(_AUDIT),
    "fill_dates": _stocks(
        "SELECT code, availability, CASE WHEN price_gbp IS NULL THEN import_date ELSE DATE '2024-01-30' END"
        " AS import_date FROM stocks"
    ),
    "set_price": _stocks(
        "SELECT code, import_date, CASE WHEN code = 'SKU00001' AND import_date = DATE '2024-01-30'"
        " THEN 24500.0::DOUBLE ELSE price_incl_vat END AS price_incl_vat FROM stocks"
    ),
    # rows and columns
    "tolerant_numbers": _stocks(
        "SELECT code, import_date, TRY_CAST(availability AS DOUBLE) AS units, CAST(availability AS DOUBLE)"
        " AS units_strict, TRY_CAST(availability || ' left' AS DOUBLE) AS units_spoilt FROM stocks"
    ),
    "title_features": _w(_title_features((1, 2, 5))),
    "title_features_leading": _w(_title_features((1, 2))),
    "title_clean": _w(
        r"SELECT code, import_date, regexp_replace(replace(title || '`s (70cl)!', '`', ''), '[^\w\s]', '', 'g')"
        " AS clean_title FROM w"
    ),
    "title_slug": _w(
        "SELECT code, import_date, 'https://shop.example.org/product/' || lower(replace(trim(title), ' ', '-'))"
        " || '-item' AS slug FROM w"
    ),
    "path_dates": _stocks(
        "SELECT code, import_date AS by_pattern, strftime(import_date, '%Y-%m-%d') AS by_parts,"
        " CAST(NULL AS DATE) AS no_date FROM stocks"
    ),
    "source_layout_export": _stocks(
        'SELECT code AS "Code", title AS "Title", size AS "Size", style AS "Style", country AS "Country",'
        f' type AS "Group", availability AS "Available", price_gbp AS "Price (GBP)" FROM ({_DAY})'
    ),
    "renamed_source": _stocks(f"SELECT {', '.join(_EXPORT)} FROM stocks"),
    "first_listed": _w(
        "SELECT import_date, code, title, price_gbp, availability FROM w"
        " ORDER BY price_gbp DESC NULLS LAST, code, import_date, availability LIMIT 20"
    ),
    "with_parameters": _w(
        f"SELECT *, DATE '2024-01-30' AS target_date, '2024-01-30' AS target_text FROM ({_TODAY.format(day='2024-01-30')})"
    ),
    "empty_checks": _w(
        "SELECT kind AS type, kind NOT IN (SELECT type FROM stocks) AS is_empty FROM (VALUES ('purchase'), ('no such type')) v(kind)"
    ),
    # pages
    "page_table": "SELECT url, html FROM pages",
    "page_heads": _pages(f"SELECT page_id, {_CLEAN_TITLE} AS page_title, CAST(NULL AS VARCHAR) AS og_title FROM p"),
    "page_blocks": _pages(
        "SELECT page_id, CAST([1, 1, 0, 1, 2, 1, 1, 1][page_id % 8 + 1] AS INT) AS block_count,"
        " CAST([1, 1, 0, 2, 1, 1, 2, 1][page_id % 8 + 1] AS INT) AS object_count,"
        " CAST([1, 2, 0, 2, 1, 1, 2, 1][page_id % 8 + 1] AS INT) AS doc_count,"
        " ['Product', 'BreadcrumbList,Product', '', 'Product,Product', 'Product', 'Product', 'BreadcrumbList,Product',"
        " 'Product'][page_id % 8 + 1] AS types FROM p"
    ),
    "page_crumbs": _pages(
        "SELECT url, CASE page_id % 8 WHEN 1 THEN 'Home|Spirits|Cat ' || (page_id % 5) WHEN 6 THEN 'Shop|ITEM ' || page_id ELSE '' END AS crumbs,"
        " CASE page_id % 8 WHEN 1 THEN 'Spirits|Cat ' || (page_id % 5) WHEN 6 THEN 'Shop|ITEM ' || page_id ELSE '' END AS kept_crumbs FROM p"
    ),
    "page_metadata": _pages(f"""
SELECT url, {_CODE} AS hed_id, {_NAME} AS product_name, array_to_string({_LEVELS}, ' > ') AS category_path,
       ({_LEVELS})[1] AS category_level_1, ({_LEVELS})[2] AS category_level_2, ({_LEVELS})[3] AS category_level_3
FROM p"""),
    "page_template": _pages(
        f"SELECT url, coalesce({_CODE}, 'X00000') AS item_id, coalesce(nullif({_NAME}, ''), 'Sample') AS name,"
        " 'Single Malt' AS type, 'Japan' AS country FROM p"
    ),
    # the larger line table
    "line_price_changes": _lines("SELECT * FROM changes"),
    "line_daily_summary": _lines(_daily()),
    "line_code_series": _lines(_series()),
    "line_units_sold_all": _lines(_units_all("LEFT")),
    "line_units_sold_by_date": _lines(_units_day("1999-04-07")),
    "line_discounted_items": _lines(_discounts("DATE '1999-04-07'")),
    "line_new_lows": _lines(_new_low("1999-04-07")),
    "line_price_ranks": _lines(_RANKS),
    "line_duplicate_titles": _lines(_SAME_TITLE),
}
