"""Raw extracts as CSV files."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.schemas import MULTILINE_TABLES, raw_schema

# No extract can contain this character, so only an unquoted empty field is
# NULL; a quoted empty field stays an empty string.
_NEVER = "\u0000"

_DIALECT = {"header": "true", "quote": '"', "escape": '"', "nullValue": _NEVER}


def read_extract(
    spark: SparkSession, table: str, path: str, *, multiline: bool | None = None
) -> DataFrame:
    """One extract: header line skipped, columns by position, all text.

    A row with too few or too many fields fails the job. Only extracts with
    free text need ``multiline``; the others stay splittable.
    """
    if multiline is None:
        multiline = table in MULTILINE_TABLES
    return (
        spark.read.schema(raw_schema(table))
        .options(**_DIALECT)
        # Unread columns must still be parsed, or a short row would go unnoticed.
        .options(mode="FAILFAST", columnPruning="false", multiLine=str(multiline).lower())
        .csv(path)
    )


def csv_reader(
    spark: SparkSession, folder: str, files: Mapping[str, str] | None = None
) -> Callable[[str], DataFrame]:
    """Reader of all nine extracts in ``folder``.

    ``files`` maps table names to file or directory names; the default is
    ``<table>.csv``.
    """
    names = dict(files or {})

    def read(table: str) -> DataFrame:
        return read_extract(spark, table, f"{folder}/{names.get(table, table + '.csv')}")

    return read


def write_extract(df: DataFrame, path: str, *, compression: str = "none") -> None:
    """Write a raw table in the dialect :func:`read_extract` reads, one file for each task.

    A compressed file is read by one task whole.
    """
    df.write.mode("overwrite").options(
        header="true",
        quote='"',
        escape='"',
        nullValue="",
        emptyValue='""',
        compression=compression,
        # Blanks at either end of a field are part of it.
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)
