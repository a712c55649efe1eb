"""Renames, exports in source layout, long format and category order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelftrail.functions.dates import day
from shelftrail.schema import CURRENT_HEADERS, LEGACY_HEADERS


def to_canonical_names(df: DataFrame) -> DataFrame:
    """Source headers of either layout renamed to canonical column names."""
    headers = {**CURRENT_HEADERS, **LEGACY_HEADERS}
    return df.withColumnsRenamed({source: name for name, source in headers.items()})


def source_layout(stocks: DataFrame, headers: dict[str, str] = LEGACY_HEADERS, day_is=None) -> DataFrame:
    """Canonical rows (of one day, if given) under the headers of a source layout."""
    if day_is is not None:
        stocks = stocks.where(F.col("import_date") == day(day_is))
    return stocks.select(*[F.col(name).alias(header) for name, header in headers.items()])


def fold(df: DataFrame, ids: list[str], measures: list[str], legend: str = "legend", value: str = "value") -> DataFrame:
    """Measures as rows, the largest value kept per ids and measure."""
    doubles = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in measures])
    long = doubles.unpivot(ids, measures, legend, value)
    return long.groupBy(*ids, legend).agg(F.max(value).alias(value))


def by_measure(df: DataFrame, category: str, measure: str) -> DataFrame:
    """Categories from the largest to the smallest total of a measure."""
    return (
        df.groupBy(category).agg(F.sum(measure).alias(measure))
        .orderBy(F.col(measure).desc_nulls_last(), F.col(category).asc_nulls_last())
    )


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows of a stated order."""
    return df.orderBy(*order).limit(n)


def fill_missing(df: DataFrame, column: str, value: Column) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), value))


def set_cell(df: DataFrame, where: Column, column: str, value: Column) -> DataFrame:
    """`column` set to `value` on the rows that meet the condition."""
    return df.withColumn(column, F.when(where, value).otherwise(F.col(column)))


def overlay(df: DataFrame, template: dict[str, str], found: dict[str, str]) -> DataFrame:
    """The template's columns for every row, overlaid by found values where known.

    `found` maps template columns to columns of `df`; empty text counts as not found.
    """
    def column(name: str, default: str) -> Column:
        fixed = F.lit(default)
        if name in found:
            return F.coalesce(F.nullif(F.col(found[name]), F.lit("")), fixed).alias(name)
        return fixed.alias(name)

    return df.select(*[column(name, default) for name, default in template.items()])


def constant_columns(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Parameters as columns, in place of a join with a one-row relation."""
    return df.withColumns(values)


def with_levels(df: DataFrame, array: str, depth: int, prefix: str) -> DataFrame:
    """Array elements as columns prefix_1 .. prefix_depth, NULL beyond the end."""
    return df.withColumns({
        f"{prefix}_{i + 1}": F.get(F.col(array), F.lit(i)) for i in range(depth)
    }) if depth else df
