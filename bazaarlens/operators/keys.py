"""Key checks: what a constraint would refuse, counted.

Over a copy in buckets of the key's first column the rows of a key lie in one file, and the
check moves nothing but its few totals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.sources.buckets import Dealt, dealt


class KeyViolation(ValueError):
    """A table breaks its declared key."""


def key_report(table: str, df: DataFrame | Dealt, key: Sequence[str]) -> DataFrame:
    """One row: total rows, rows with a NULL in the key, and surplus duplicates.

    Rows with a NULL key part are counted as such and never as duplicates.
    """
    per_key = dealt(df).each(
        lambda part: part.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    )
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])

    def total(condition, amount):
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0))

    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(", ".join(key)).alias("key_columns"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        total(incomplete, F.col("_rows")).alias("null_key_rows"),
        total(~incomplete, F.col("_rows") - F.lit(1)).alias("duplicate_rows"),
    )


def key_reports(tables: Mapping[str, tuple[DataFrame | Dealt, Sequence[str]]]) -> DataFrame:
    """The reports of several tables, in table order, as one DataFrame."""
    reports = [key_report(name, df, key) for name, (df, key) in tables.items()]
    return reduce(DataFrame.unionAll, reports).orderBy("table_name")


def require_key(
    table: str, df: DataFrame | Dealt, key: Sequence[str], *, allow_null: bool
) -> None:
    """Raise :class:`KeyViolation` unless ``key`` identifies every row."""
    report = key_report(table, df, key).first()
    if report["duplicate_rows"] or (report["null_key_rows"] and not allow_null):
        raise KeyViolation(
            f"{table}({report['key_columns']}): {report['duplicate_rows']} duplicate and "
            f"{report['null_key_rows']} NULL keys in {report['total_rows']} rows"
        )
