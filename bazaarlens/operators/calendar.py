"""Every day between two dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def days_between(df: DataFrame, day: str, name: str) -> DataFrame:
    """One row per calendar day from the earliest to the latest ``day`` of ``df``.

    As in a step-by-step calendar, a table without any date gives a single NULL day.
    """
    span = df.agg(F.min(day).alias("_from"), F.max(day).alias("_to"))
    return span.select(
        F.explode_outer(F.sequence("_from", "_to", F.expr("interval 1 day"))).alias(name)
    )
