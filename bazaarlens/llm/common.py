"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from bazaarlens.operators.scratch import release, stored

#: Rows that a task turns into Python objects at once.
SLICE = 512
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` whose names, in any case, are not among ``names``."""
    taken = {name.lower() for name in names}
    return [c for c in df.columns if c.lower() not in taken]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds few texts as objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows at most, for wide rows; the session's setting returns."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_columns(
    df: DataFrame,
    inputs: list[Column | str],
    fields: list[StructField],
    make: Callable[[], Callable[..., list]],
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with columns computed row by row in Python workers, in Arrow batches.

    ``make()`` is called once per task and returns a function from the batch's
    inputs (one list each) to the values of the new columns (one list each). Kept
    columns pass through; a kept column with the name of a new one is replaced. An
    input given by its name is the column as it is, nulls included; if it is kept, the
    workers get it once.
    """
    kept = without(df.select(*keep) if keep is not None else df, [f.name for f in fields])
    schema = StructType([df.schema[c] for c in kept] + fields)
    given, lower = len(kept), [c.lower() for c in kept]
    named: list[Column] = []
    read = []
    for column in inputs:
        if isinstance(column, str) and column.lower() in lower:
            read.append(lower.index(column.lower()))
            continue
        read.append(given + len(named))
        column = F.col(f"`{column}`") if isinstance(column, str) else column
        named.append(column.alias(f"__in_{len(named)}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, types = make(), None
        for batch in sliced(batches):
            if types is None:
                from pyspark.sql.pandas.types import to_arrow_type

                types = [to_arrow_type(f.dataType) for f in fields]
            new = work(*[batch.column(i).to_pylist() for i in read])
            arrays = [pa.array(v, t) for v, t in zip(new, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:given], *arrays], names=[f.name for f in schema.fields]
            )

    return df.select(*[F.col(f"`{c}`") for c in kept], *named).mapInArrow(run, schema)


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[pa.Table]:
    """Runs of equal keys in a sorted stream of batches, one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        start = 0
        rows = list(zip(*columns, strict=True))
        for i, key in enumerate(rows):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable from each id that has a link.

    ``edges``: columns ``a`` and ``b`` (long). Returns ``id``, ``component``. Each round
    maps every id to the smallest of itself and its neighbours, and that one on once more,
    then replaces both ends of each link: links that fall together or into one id are
    gone, so the next round has far fewer. An id that others were mapped to and that moved
    itself keeps a link to where it went. Rounds are written out, which cuts the lineage.
    Minima are computed map-side first: an id with very many links does not gather them.
    """
    def different(pairs: DataFrame) -> DataFrame:
        ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
        return stored(pairs.where("a <> b").select(*ends).distinct())

    pairs, moves = different(edges.select("a", "b")), []
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label"))
        near = stored(near)
        on = near.select(F.col("id").alias("label"), F.col("label").alias("next"))
        moved = stored(near.join(on, "label").select("id", F.col("next").alias("label")))
        moves.append(moved)
        of_a = moved.select(F.col("id").alias("a"), F.col("label").alias("x"))
        of_b = moved.select(F.col("id").alias("b"), F.col("label").alias("y"))
        kept = moved.select(F.col("label").alias("b")).distinct().join(of_b, "b")
        after = different(
            pairs.join(of_a, "a").join(of_b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
            .unionByName(kept.select(F.col("b").alias("a"), F.col("y").alias("b")))
        )
        release(pairs)
        release(near)
        pairs = after
    if not moves:
        return pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))
    found = moves[0]
    for moved in moves[1:]:
        further = moved.select(F.col("id").alias("label"), F.col("label").alias("next"))
        found = found.join(further, "label", "left").select(
            "id", F.coalesce("next", "label").alias("label")
        )
    return found.select("id", F.col("label").alias("component"))
