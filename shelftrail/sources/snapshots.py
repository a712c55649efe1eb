"""Dated catalogue snapshots in CSV, several layouts, into the canonical table."""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelftrail.functions.casts import to_number
from shelftrail.functions.dates import file_date
from shelftrail.schema import CANONICAL, CANONICAL_COLUMNS, HEADER_ALIASES, NUMERIC_COLUMNS, POSITIONAL

SOURCE_PATH = "source_path"
UNIT_PATTERN = r"^(.*?\d{4}_\d{2}_\d{2}[^/]*)"


def _listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(path)
    )


def snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and modification time of the CSV files below a folder or glob.

    A listing only: the content column is never selected, so no file is opened. A
    session of its own packs the files into a few tasks instead of one task each.
    """
    listing = spark.newSession()
    listing.conf.set("spark.sql.files.maxPartitionNum", 64)
    return _listing(listing, path).select(F.col("_metadata.file_path").alias(SOURCE_PATH), "modificationTime")


def _literal(path: str) -> str:
    """A path in which no character is taken for a wildcard."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def snapshot_unit(path: Column) -> Column:
    """The part of a path that names one snapshot: up to the name holding the date.

    The part files of a folder named like a snapshot belong to one unit; a path
    without a date is a unit by itself.
    """
    dated = F.regexp_extract(path, UNIT_PATTERN, 1)
    return F.when(dated == "", path).otherwise(dated)


def _csv(spark: SparkSession, multi_line: bool):
    # A doubled quote inside a quoted field stands for one quote.
    return (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line)
    )


#: Files whose heads are read at the same time.
_OPEN = 32


def file_headers(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, str]]:
    """(URI, first line) of every CSV file that has a line, below a folder or in a list.

    Only the head of a file is read, one buffer as a rule, through the same file system as
    Spark's readers; none of those can stop early in every file. That is one short read per
    file by threads of the driver, whose file index has an entry per file in any case.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def head(uri: str) -> tuple[str, str | None]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(path.getFileSystem(conf).open(path), "UTF-8"))
        try:
            return uri, reader.readLine()
        finally:
            reader.close()

    with ThreadPoolExecutor(_OPEN) as pool:
        heads = list(pool.map(head, sorted(_listing(spark, paths).inputFiles())))
    # As rows have it in _metadata.file_path: one slash where a URI names no host.
    return [(re.sub("^([^:/]+):///", r"\1:/", uri), line) for uri, line in heads if line is not None]


def _unit_name(path: str) -> str:
    dated = re.match(UNIT_PATTERN, path)
    return dated.group(1) if dated else path


def _columns(header: str) -> tuple[str, ...]:
    """Column names of a header line, without a byte order mark."""
    return tuple(next(csv.reader([header.lstrip("\ufeff")]), ()))


@dataclass
class Layouts:
    """`files`: (URI, layout) of each file with a header; `columns`: the names of each layout, by number."""

    files: list[tuple[str, int]]
    columns: list[tuple[str, ...]]


def layouts(spark: SparkSession, paths: str | list[str]) -> Layouts:
    """The layouts of the CSV files below a folder, or of a list of files.

    The part files of a snapshot must agree on their header.
    """
    heads = [(uri, _columns(line)) for uri, line in file_headers(spark, paths)]
    columns = sorted({names for _, names in heads if names})
    numbers, units, files = {names: i for i, names in enumerate(columns)}, {}, []
    for uri, names in heads:
        if names:
            if units.setdefault(_unit_name(uri), names) != names:
                raise ValueError(f"the header of {unquote(uri)} differs from that of its snapshot")
            files.append((uri, numbers[names]))
    return Layouts(files, columns)


def header_groups(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """File paths by header."""
    found, groups = layouts(spark, path), {}
    for uri, number in found.files:
        groups.setdefault(found.columns[number], []).append(unquote(uri))
    return groups


def _cells(spark: SparkSession, paths: str | list[str], found: Layouts, multi_line: bool) -> DataFrame:
    """All rows of all layouts in one scan: cells c0, c1, ... as text, SOURCE_PATH and layout.

    A file whose header nobody has read fails the scan. Files and their layouts are a table of
    two short columns, which Spark sends to every task as long as its size allows.
    """
    width = max(map(len, found.columns), default=0)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    uris, numbers = zip(*found.files)
    # From Arrow the table is part of the plan, so that Spark knows its size.
    files = spark.createDataFrame(pa.table({SOURCE_PATH: pa.array(uris), "layout": pa.array(numbers, pa.int32())}))
    rows = (
        _csv(spark, multi_line).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).schema(schema).csv(paths)
        .select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))
    )
    unknown = F.raise_error(F.concat(F.lit("no header was read for "), F.col(SOURCE_PATH))).cast("int")
    return rows.join(files, SOURCE_PATH, "left").withColumn("layout", F.coalesce("layout", unknown))


def _by_layout(values: list[Column | None]) -> Column:
    """The value that belongs to a row's layout; NULL for layouts without one."""
    out = F.lit(None)
    for number, value in enumerate(values):
        if value is not None:
            out = F.when(F.col("layout") == number, value).otherwise(out)
    return out


def read_by_name(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All snapshots, columns matched by header, absent ones NULL. Cells stay text.

    Names that differ in case only are one column; of a name given twice in a header the first counts.
    """
    found = layouts(spark, path)
    if not found.columns:
        raise FileNotFoundError(f"no CSV with a header below {path}")
    names: dict[str, str] = {}
    for columns in found.columns:
        for name in columns:
            names.setdefault(name.lower(), name)
    places = [{name.lower(): i for i, name in reversed(list(enumerate(columns)))} for columns in found.columns]
    cells = _cells(spark, path, found, multi_line)
    return cells.select(
        *[_by_layout([F.col(f"c{at[key]}") if key in at else None for at in places]).cast("string").alias(name) for key, name in names.items()],
        SOURCE_PATH,
    )


def resolve(columns: tuple[str, ...], aliases: list[str], numeric: bool = False) -> Column | None:
    """First known value among the cells whose names are aliases; None if a layout has none."""
    places: dict[str, int] = {}
    for i, name in enumerate(columns):
        places.setdefault(name.lower(), i)
    cells = [F.col(f"c{places[a]}") for a in dict.fromkeys(a.lower() for a in aliases) if a in places]
    if numeric:
        cells = [to_number(c) for c in cells]
    return F.coalesce(*cells) if cells else None


def stocks_by_name(
    spark: SparkSession, path: str, multi_line: bool = False, files: list[str] | None = None
) -> DataFrame:
    """Canonical table of all snapshots (or of some files), whatever their column order.

    One scan reads all layouts; which cell holds a column depends on the row's file.
    """
    if files is not None and not files:
        return spark.createDataFrame([], CANONICAL)
    paths = path if files is None else [_literal(f) for f in files]
    found = layouts(spark, paths)
    if not found.columns:
        return spark.createDataFrame([], CANONICAL)
    types = {f.name: f.dataType for f in CANONICAL}
    columns = [
        _by_layout([resolve(c, aliases, name in NUMERIC_COLUMNS) for c in found.columns]).cast(types[name]).alias(name)
        for name, aliases in HEADER_ALIASES.items()
    ]
    return _cells(spark, paths, found, multi_line).select(
        *columns, file_date(F.col(SOURCE_PATH)).alias("import_date")
    ).select(*CANONICAL_COLUMNS)


def read_positional(spark: SparkSession, path: str | list[str], escape: str = '"') -> DataFrame:
    """All snapshots as the 12 text columns of the newer layout, whatever their header.

    Shorter rows are padded with NULL. One scan over all files and layouts.
    """
    rows = (
        spark.read.schema(POSITIONAL).option("header", True).option("quote", '"')
        .option("escape", escape).option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True).csv(path)
    )
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))


def is_legacy() -> Column:
    """An 8-column row read as 12 columns: nothing in the last four, a price in the eighth.

    An older row without a price cannot be told from a newer one and is read as such;
    `stocks_by_name` has no such doubt.
    """
    trailing = ["available", "price_incl_vat", "price_ex_vat", "link"]
    nothing_follows = F.lit(True)
    for name in trailing:
        nothing_follows &= F.col(name).isNull()
    return nothing_follows & to_number("group_name").isNotNull()


# Canonical column -> position taken in the older and in the newer
# layout, None where that layout has no such column.
_POSITIONS = {
    "abv": (None, "abv"),
    "availability": ("country", "available"),
    "code": ("code", "code"),
    "country": ("abv", "country"),
    "type": ("style", "group_name"),
    "url": (None, "link"),
    "price_gbp": ("group_name", None),
    "price_ex_vat": (None, "price_ex_vat"),
    "price_incl_vat": (None, "price_incl_vat"),
    "size": ("vintage", "size"),
    "style": ("size", "style"),
    "title": ("title", "title"),
    "vintage": (None, "vintage"),
}


def canonical_by_position(raw: DataFrame) -> DataFrame:
    """Canonical rows from positional ones, the two layouts told apart row by row."""
    flagged = raw.withColumn("__legacy", is_legacy())

    def column(name: str) -> Column:
        old, new = (F.lit(None).cast("string") if p is None else F.col(p) for p in _POSITIONS[name])
        value = F.when(F.col("__legacy"), old).otherwise(new)
        return (to_number(value) if name in NUMERIC_COLUMNS else value).alias(name)

    return flagged.select(
        *[column(name) for name in _POSITIONS], file_date(F.col(SOURCE_PATH)).alias("import_date")
    ).select(*CANONICAL_COLUMNS)


def stocks_by_position(
    spark: SparkSession, path: str, escape: str = '"', files: list[str] | None = None
) -> DataFrame:
    paths = path if files is None else [_literal(f) for f in files]
    return canonical_by_position(read_positional(spark, paths, escape))


def build_stocks(
    spark: SparkSession, path: str, layout: str = "by_name", files: list[str] | None = None
) -> DataFrame:
    """Canonical table of the snapshots below `path`, or of some of their files."""
    readers = {"by_name": stocks_by_name, "positional": stocks_by_position}
    return readers[layout](spark, path, files=files)


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """One CSV file with its types guessed from the data."""
    return _csv(spark, False).option("inferSchema", True).csv(path)


def file_key(path: Column) -> Column:
    """What tells a file from others: from the name with the date on, else its own name.

    Part files have the same names in every snapshot folder, so the folder counts.
    """
    dated = F.regexp_extract(path, r"([^/]*\d{4}_\d{2}_\d{2}[^/]*(?:/[^/]+)?)$", 1)
    return F.when(dated == "", F.regexp_extract(path, r"([^/]+)$", 1)).otherwise(dated)


def new_files(listing: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files of a listing that were not loaded before (batch form of the stream)."""
    key = file_key(F.col(SOURCE_PATH)).alias("file_name")
    return listing.withColumn("file_name", key).join(loaded.select(key).distinct(), "file_name", "left_anti")
