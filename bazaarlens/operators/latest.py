"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.temporal import span_micros


def latest_per_key(df: DataFrame, key: str, moment: str, tie_break: str) -> DataFrame:
    """The row of each key with the latest ``moment``.

    A NULL moment counts as latest, and equal moments go to the smallest
    ``tie_break``. Written as an aggregate rather than a window: each task
    reduces its share of a hot key to one row before the shuffle, and the
    optimizer learns that ``key`` is unique, so unused joins to it disappear.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    preference: list[Column] = [
        # NULL sorts lowest inside a struct, so a missing moment is preferred.
        (-span_micros(epoch, F.col(moment))).alias("_age"),
        F.col(tie_break).isNull().alias("_no_tie"),
        F.col(tie_break).alias("_tie"),
    ]
    payload = [F.col(c) for c in df.columns if c != key]
    best = F.min(F.struct(*preference, *payload)).alias("_best")
    picked = df.groupBy(key).agg(best)
    return picked.select(*[key if c == key else F.col(f"_best.{c}") for c in df.columns])
