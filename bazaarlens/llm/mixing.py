"""Mixing sources to target weights by iterative proportional fitting.

Token weights are summed per cell of source, language and topic. Each sweep rakes the
cells to the target share of every source, then every language, then every topic, and
holds each cell to the tokens it has. What the cells end with, divided by what they
have, is the probability with which their documents are sampled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import filled, table, without
from bazaarlens.operators.scratch import stored

# Topics by what a text holds, the first that fits; else ``general``.
TOPICS = {
    "legal": r"(?i)\b(?:licen[sc]e|copyright|rights reserved)\b",
    "contact": r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9]",
    "technical": r"[{}<>=]|\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]",
    "emphatic": r"[!?]{2}",
}
SIDES = ("source", "lang", "topic")
#: Share of all tokens to sample, exponent of default targets, sweeps.
SHARE, TEMPER, SWEEPS = 0.5, 0.7, 10
#: Cells are looked up by broadcast up to so many, by a shuffled join beyond.
BROADCAST_CELLS = 100_000


def topic_of(text: Column) -> Column:
    """The first of ``TOPICS`` whose pattern occurs in the text."""
    topic = F.lit("general")
    for name, pattern in reversed(TOPICS.items()):
        topic = F.when(text.rlike(pattern), name).otherwise(topic)
    return topic


def tokens_of(text: Column) -> Column:
    """Runs of characters other than white space."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"\s+"))).cast("long")


def described(df: DataFrame) -> DataFrame:
    """``df`` with ``topic`` and ``n_tokens`` of its text; columns of these names are replaced."""
    kept = [F.col(f"`{c}`") for c in without(df, ["topic", "n_tokens"])]
    return df.select(*kept, topic_of(filled()).alias("topic"), tokens_of(filled()).alias("n_tokens"))


def _targets(
    cells: DataFrame, side: str, targets: dict[str, dict[str, float]], total: Column, temper: float
) -> DataFrame:
    """``cells`` with the tokens each value of a side is to have."""
    beside = Window.partitionBy(side)
    has = F.sum("tokens").over(beside)
    if side in targets:
        shares = F.create_map(*[F.lit(x) for pair in targets[side].items() for x in pair])
        wish = F.coalesce(F.try_element_at(shares, F.col(side)), F.lit(0.0))
        return cells.withColumn(f"wish_{side}", wish * total)
    # tempered shares: large values give to small ones
    sized = cells.withColumn("__has", has.cast("double")).withColumn(
        "__n", F.count(F.lit(1)).over(beside)
    )
    norms = sized.agg(
        F.sum(F.when(F.col("__has") > 0, F.pow("__has", F.lit(temper)) / F.col("__n"))).alias("s")
    ).first()["s"]
    wish = F.when(F.col("__has") > 0, F.pow("__has", F.lit(temper))).otherwise(0.0)
    return sized.withColumn(f"wish_{side}", wish / F.lit(norms or 1.0) * total).drop("__has", "__n")


def raked(
    docs: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    share: float = SHARE,
    temper: float = TEMPER,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """Cells (source, lang, topic) with tokens, raked weight and sampling probability.

    ``docs``: source, lang, topic, n_tokens. ``targets`` gives shares by side and
    value; a side without them gets its own shares to the power ``temper``, and values
    that are not named get nothing. A null value is a value of its own. Cells without
    tokens get the share ``share`` of their documents.
    """
    cells = stored(
        docs.groupBy(*SIDES).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    )
    total = F.lit(float(cells.agg(F.sum("tokens")).first()[0] or 0) * share)
    for side in SIDES:
        cells = _targets(cells, side, targets or {}, total, temper)
    state = stored(cells.withColumn("weight", F.col("tokens") * F.lit(float(share))))
    for _ in range(sweeps):
        for side in SIDES:
            now = F.sum("weight").over(Window.partitionBy(side))
            state = state.withColumn(
                "weight",
                F.when(now > 0, F.col("weight") * F.col(f"wish_{side}") / now).otherwise(0.0),
            )
        state = stored(state.withColumn("weight", F.least("weight", F.col("tokens").cast("double"))))
    probability = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(share)
    return state.select(*SIDES, "tokens", "documents", "weight", probability.alias("probability"))


def sampled(
    df: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    share: float = SHARE,
    seed: int = 17,
) -> DataFrame:
    """``df`` with topic, n_tokens, probability and sampled.

    ``df``: doc_id, text, source, lang. A document is drawn if a number between 0 and
    1 made from its doc_id and ``seed`` is below its cell's probability: the same
    document is drawn the same way however rows are ordered or repeated. Null texts
    have no tokens; an empty table stays empty; columns of the new names are replaced.
    """
    names = ["topic", "n_tokens", "probability", "sampled"]
    return drawn(described(df.select(*[F.col(f"`{c}`") for c in without(df, names)])), targets, share, seed)


def drawn(
    given: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    share: float = SHARE,
    seed: int = 17,
) -> DataFrame:
    """``sampled`` for rows that ``described`` has been applied to; reads them twice."""
    cells = raked(given, targets, share).select(
        *[F.col(s).alias(f"__{s}") for s in SIDES], "probability"
    )
    cells = stored(cells)
    if cells.count() <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    same = reduce(lambda a, b: a & b, [F.col(s).eqNullSafe(F.col(f"__{s}")) for s in SIDES])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return (
        given.join(cells, same)
        .withColumn("sampled", draw < F.col("probability"))
        .select(*[F.col(f"`{c}`") for c in given.columns], "probability", "sampled")
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell, probability and draw of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    # texts are looked at once
    return drawn(stored(described(docs).drop("text"))).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "probability", "sampled"
    )
