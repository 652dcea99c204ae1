"""Most frequent values next to ordinary aggregates, in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BALLOT = "struct<race:string,choice:string,weight:bigint>"


def ballot(race: str, choice: Column, weight: Column) -> Column:
    """One vote: ``choice`` gains ``weight`` in ``race``."""
    return F.struct(
        F.lit(race).alias("race"),
        choice.cast("string").alias("choice"),
        weight.cast("bigint").alias("weight"),
    )


def aggregate_with_modes(
    df: DataFrame,
    key: str,
    ballots: Column,
    races: tuple[str, ...],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Per key: the winner of every race plus sums.

    ``ballots`` is an array of :func:`ballot` votes, at least one per row. Ties
    go to the smallest choice and NULL choices never win. Votes are first
    counted per (key, race, choice), so neither a hot key nor one with many
    distinct choices is ever held in a single buffer.
    """
    votes = df.select(
        key,
        *[column.alias(name) for name, column in sums.items()],
        F.posexplode(ballots).alias("_nth", "_vote"),
    ).select(
        key,
        F.col("_vote.race").alias("_race"),
        F.col("_vote.choice").alias("_choice"),
        F.col("_vote.weight").alias("_weight"),
        # A row's amounts travel with its first vote only.
        *[F.when(F.col("_nth") == 0, F.col(name)).alias(name) for name in sums],
    )
    tallies = votes.groupBy(key, "_race", "_choice").agg(
        *[F.sum(name).alias(name) for name in ("_weight", *sums)]
    )

    def winner(race: str) -> Column:
        eligible = (F.col("_race") == race) & F.col("_choice").isNotNull()
        candidate = F.struct((-F.col("_weight")).alias("_rank"), F.col("_choice"))
        return F.min(F.when(eligible, candidate)).getField("_choice").alias(race)

    return tallies.groupBy(key).agg(
        *[winner(race) for race in races],
        *[F.sum(name).alias(name) for name in sums],
    )
