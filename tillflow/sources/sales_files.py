"""Delimited sales files and master product sheets, read as text by column name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillflow.functions.text import missing_to_null, strip
from tillflow.schemas import MASTER_NAMES, POSITION, SEEN_FILES, conform

# Quotes inside a quoted field are doubled; a backslash is ordinary text.
DIALECT = {"quote": '"', "escape": '"'}
BOM_MARKS = ("﻿", "ï»¿")


def normal_header(name: str) -> str:
    """A heading without byte-order mark and surrounding blanks."""
    for mark in BOM_MARKS:
        name = name.replace(mark, "")
    return name.strip()


def distinct_headers(names: list[str]) -> list[str]:
    """Headings made unique whatever their case; the first of equal ones keeps its name."""
    seen: dict[str, int] = {}
    result = []
    for name in map(normal_header, names):
        count = seen[name.lower()] = seen.get(name.lower(), 0) + 1
        result.append(name if count == 1 else f"{name}_{count}")
    return result


def raw_header(spark: SparkSession, path, encoding: str = "UTF-8", **options) -> list[str]:
    """Headings of the first file as they stand; reads one line."""
    first = spark.read.options(**{**DIALECT, **options}).csv(
        path, header=False, encoding=encoding).first()
    if first is None:
        raise ValueError(f"no header found in {path}")
    return ["" if value is None else value for value in first]


def read_header(spark: SparkSession, path, encoding: str = "UTF-8", **options) -> list[str]:
    return distinct_headers(raw_header(spark, path, encoding, **options))


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def header_options(header: list[str]) -> tuple[T.StructType, dict]:
    """Schema and options that make every file prove its headings match ``header``.

    Spark fills columns by position; without the proof a file with another column order
    would be misread. Headings equal up to case cannot be proven and are taken in order.
    """
    provable = len({name.lower() for name in header}) == len(header) and all(header)
    names = header if provable else distinct_headers(header)
    return text_schema(names), {"header": True, "enforceSchema": not provable}


def keeping_ragged(schema: T.StructType, ragged: str | None) -> tuple[T.StructType, dict]:
    """Schema and options that keep the text of lines with too many or too few fields.

    It comes in a column of its own in the same scan; such a line's other columns hold what
    could be read of it.
    """
    if ragged is None:
        return schema, {}
    wide = T.StructType([*schema.fields, T.StructField(ragged, T.StringType())])
    return wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": ragged}


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def position() -> Column:
    """Where a row lies in its input, in an order that "first" and "last" can use.

    The id grows inside a file split, and splits are ordered by the fields before it.
    """
    return F.struct(
        F.col("_metadata.file_modification_time"), F.col("_metadata.file_name"),
        F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row_id"),
    )


def normal_columns(df: DataFrame, *extra: Column) -> DataFrame:
    """Normalised headings, and spellings of a missing value as null."""
    names = distinct_headers(df.columns)
    return df.select(
        *[missing_to_null(quoted(old)).alias(new) for old, new in zip(df.columns, names)], *extra
    )


def _named(df: DataFrame) -> DataFrame:
    """Normalised headings beside the position."""
    names = [c for c in df.columns if c != POSITION]
    return df.select(*[missing_to_null(quoted(old)).alias(new)
                       for old, new in zip(names, distinct_headers(names))], POSITION)


def decoded_name(name: str) -> str:
    """A heading read as Latin-1, as UTF-8 if its bytes are that."""
    try:
        return name.encode("latin-1").decode("utf-8")
    except UnicodeError:
        return name


def decoded_value(value: Column) -> Column:
    """A value read as Latin-1, which loses no byte, as UTF-8 if its bytes are that."""
    read = F.encode(value, "ISO-8859-1").cast("string")
    return F.when(F.is_valid_utf8(read), read).otherwise(value)


def decoded_columns(df: DataFrame) -> DataFrame:
    """All text columns and headings decoded; other columns stay."""
    return df.select(*[
        (decoded_value(quoted(f.name)) if f.dataType == T.StringType() else quoted(f.name))
        .alias(decoded_name(f.name)) for f in df.schema.fields])


def read_sales_csv(spark: SparkSession, path, encoding: str = "auto", ragged: str | None = None,
                   only: DataFrame | None = None, **options) -> DataFrame:
    """A header CSV as text columns plus ``file_position``.

    ``path`` is a file, a folder or a list of them, all with the same columns; read files
    of another layout apart and union them by name. With ``auto``, each value is taken as
    UTF-8 if its bytes are valid UTF-8 and as Latin-1 otherwise, in one scan. ``ragged`` names
    a column for the text of lines whose number of fields is not the heading's. ``only`` are
    the files to take, as ``listed_files`` gives them.
    """
    source = "ISO-8859-1" if encoding == "auto" else encoding
    header = raw_header(spark, path, source, **options)
    schema, checks = header_options(header)
    schema, keep = keeping_ragged(schema, ragged)
    df = spark.read.options(**{**DIALECT, **options}, **checks, **keep).schema(schema).csv(
        path, encoding=source)
    placed = df.withColumn(POSITION, position())
    if only is not None:
        placed = placed.withColumn(_FILE, F.col("_metadata.file_path")).join(
            only.select(F.col("path").alias(_FILE)), _FILE, "left_semi").drop(_FILE)
    if encoding == "auto":
        placed = decoded_columns(placed)
    return _named(placed)


_FILE = "_file_path"


def listed_files(spark: SparkSession, folder: str, master: bool = False) -> DataFrame:
    """(path, length, modified) of a folder's CSV files; a name with "master" marks a master sheet.

    Only the listing is read, and it stays a frame: no list of files comes to the driver.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"))
    marked = F.contains(F.lower(F.element_at(F.split("path", "/"), -1)), F.lit("master"))
    return conform(files.where(marked if master else ~marked), SEEN_FILES)


def unseen_files(listed: DataFrame, seen: DataFrame) -> DataFrame:
    """Files that are not in the ledger; one whose size or time has changed counts as new."""
    return listed.join(seen, ["path", "length", "modified"], "left_anti")


def read_new_sales(spark: SparkSession, folder: str, new: DataFrame, **options) -> DataFrame:
    """The rows of the ``new`` files of a folder.

    Older files are left out by time before they are opened, and of the rest exactly the new
    ones are kept, by a join on the file's path.
    """
    first = new.agg(F.min("modified").alias("first")).first()["first"]
    after = (first - dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
    zone = spark.conf.get("spark.sql.session.timeZone")
    return read_sales_csv(spark, folder, only=new, modifiedAfter=after, timeZone=zone,
                          pathGlobFilter="*.csv", **options)


def _csv_files(spark: SparkSession, folder: str, master: bool) -> list[str]:
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    marked = F.contains(name, F.lit("master"))
    return [row.path for row in listed.select("path").filter(marked if master else ~marked)
            .orderBy("path").toLocalIterator()]


def discover_sales_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of CSV files whose name does not mark them as master sheets, for small folders."""
    return _csv_files(spark, folder, master=False)


def discover_master_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of CSV files whose name marks them as master sheets, for small folders."""
    return _csv_files(spark, folder, master=True)


def read_master_csv(spark: SparkSession, path, **options) -> DataFrame:
    return map_master_columns(read_sales_csv(spark, path, **options))


def read_master_parquet(spark: SparkSession, path) -> DataFrame:
    return map_master_columns(spark.read.parquet(path))


def map_master_columns(master: DataFrame) -> DataFrame:
    """Master headings to dimension names, text columns trimmed."""
    renamed = master.withColumnsRenamed(MASTER_NAMES)
    text = {f.name for f in renamed.schema if isinstance(f.dataType, T.StringType)}
    return renamed.select(
        *[strip(F.col(f"`{c}`")).alias(c) if c in text else F.col(f"`{c}`")
          for c in renamed.columns]
    )
