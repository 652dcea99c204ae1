"""Global order without a single-task window.

Rows are range-partitioned and sorted, then stored together with a slot number
(partition in the high bits, position in the low bits). One small count per
partition turns slots into global positions. Range bounds are sampled, so the
stored copy is what every later step reads.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from bazaarlens.functions.ordering import rising
from bazaarlens.operators.scratch import stored

_SLOT_BITS = 33  # layout of monotonically_increasing_id


def _partition_of() -> Column:
    return F.shiftright(F.col("_slot"), _SLOT_BITS)


@dataclass(frozen=True)
class SortKey:
    """One column to rank by. NULL position is explicit, never the engine default."""

    column: str
    descending: bool = False
    nulls_first: bool = False

    def on(self, column: Column) -> Column:
        if self.descending:
            return column.desc_nulls_first() if self.nulls_first else column.desc_nulls_last()
        return column.asc_nulls_first() if self.nulls_first else column.asc_nulls_last()

    def beyond(self, key: Column, tie: Column, cut_key: Column | None, cut_tie: Column) -> Column:
        """Does (key, tie) come after the cut row? ``cut_key`` None means NULL."""
        if cut_key is None:
            later = key.isNotNull() if self.nulls_first else F.lit(False)
            return later | (key.isNull() & (tie > cut_tie))
        further = key < cut_key if self.descending else key > cut_key
        later = F.coalesce(further | ((key == cut_key) & (tie > cut_tie)), F.lit(False))
        return later if self.nulls_first else later | key.isNull()


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(sorted_rows.withColumn("_slot", F.monotonically_increasing_id()))


def _sizes(placed: DataFrame, *by: str, weight: Column | None = None) -> list[Row]:
    """Rows (or total weight) per stored partition: a handful of numbers each."""
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        placed.groupBy(_partition_of().alias("_part"), *by).agg(total.alias("_size")).collect()
    )


def row_numbers(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Consecutive numbers from 1 in the given (total) order."""
    placed = _placed(df, order)
    starts, seen = [], 0
    for part, size in sorted((r["_part"], r["_size"]) for r in _sizes(placed)):
        starts.append((part, seen))
        seen += size
    spark = df.sparkSession
    offsets = spark.createDataFrame(starts, "_start_part bigint, _start bigint")
    local = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    # One offset row per stored partition: bounded by the partition count.
    return placed.join(F.broadcast(offsets), _partition_of() == F.col("_start_part")).select(
        *df.columns, (F.col("_start") + local + F.lit(1)).alias(name)
    )


def _stacked(df: DataFrame, keys: Mapping[str, SortKey], *carried: str) -> DataFrame:
    """One row per ranking: its number in ``_nth`` and its key in its own column."""
    types = {k.column: df.schema[k.column].dataType for k in keys.values()}
    names = list(keys)
    entries = [
        F.struct(
            F.lit(nth).alias("_nth"),
            *[
                (
                    F.col(keys[other].column)
                    if other == name
                    else F.lit(None).cast(types[keys[other].column])
                ).alias(f"_key{i}")
                for i, other in enumerate(names)
            ],
        )
        for nth, name in enumerate(names)
    ]
    return df.select(*carried, F.inline(F.array(*entries)))


def ntile_columns(
    df: DataFrame, buckets: int, unique: str, keys: Mapping[str, SortKey]
) -> dict[str, Column]:
    """Bucket-number expressions, one per named ranking, for rows of ``df``.

    Bucket sizes differ by at most one, larger buckets first; ties are broken by
    ``unique`` ascending. Only the rows at the bucket boundaries are located, by
    a narrow range shuffle; the wide rows are then compared with these few cuts
    and neither shuffled nor joined.
    """
    names = list(keys)
    order = [F.col("_nth").asc()]
    order += [keys[name].on(F.col(f"_key{i}")) for i, name in enumerate(names)]
    placed = _placed(_stacked(df, keys, unique), [*order, rising(unique)])

    per_part: dict[int, dict[int, int]] = defaultdict(dict)
    for row in _sizes(placed, "_nth"):
        per_part[row["_part"]][row["_nth"]] = row["_size"]

    wanted: dict[int, list[int]] = {nth: [] for nth in range(len(names))}
    for nth in wanted:
        total = sum(sizes.get(nth, 0) for sizes in per_part.values())
        if total == 0:
            continue
        base, extra = divmod(total, buckets)
        for cut in (i * base + min(i, extra) for i in range(1, buckets)):
            passed = 0
            for part in sorted(per_part):
                size = per_part[part].get(nth, 0)
                if cut <= passed + size:
                    ahead = sum(n for t, n in per_part[part].items() if t < nth)
                    wanted[nth].append((part << _SLOT_BITS) + ahead + cut - passed - 1)
                    break
                passed += size

    slots = sorted({slot for cuts in wanted.values() for slot in cuts})
    # At most (buckets - 1) rows per ranking come back.
    found = {
        row["_slot"]: row
        for row in placed.filter(F.col("_slot").isin(slots or [-1]))
        .select(
            "_slot",
            F.col(unique).cast("string").alias("_tie"),
            *[F.col(f"_key{i}").cast("string").alias(f"_key{i}") for i in range(len(names))],
        )
        .collect()
    }
    tie_type = df.schema[unique].dataType
    columns = {}
    for nth, name in enumerate(names):
        key = keys[name]
        bucket = F.lit(1)
        for slot in wanted[nth]:
            row = found[slot]
            text = row[f"_key{nth}"]
            cut = None if text is None else F.lit(text).cast(df.schema[key.column].dataType)
            after = key.beyond(
                F.col(key.column), F.col(unique), cut, F.lit(row["_tie"]).cast(tie_type)
            )
            bucket = bucket + after.cast("int")
        columns[name] = bucket
    return columns


def with_rows_ahead(df: DataFrame, keys: Mapping[str, SortKey]) -> tuple[DataFrame, int]:
    """Add, per named ranking, how many rows sort strictly before (rank minus one).

    Also returns the row count. Rows are first reduced to distinct key values
    with their counts, so a value shared by a third of all rows costs one row;
    only the distinct values are put in order.
    """
    names = list(keys)
    key_columns = [f"_key{i}" for i in range(len(names))]
    values = (
        _stacked(df, keys).groupBy("_nth", *key_columns).agg(F.count(F.lit(1)).alias("_rows"))
    )
    order = [F.col("_nth").asc()]
    order += [keys[name].on(F.col(f"_key{i}")) for i, name in enumerate(names)]
    placed = _placed(values, order)

    per_ranking: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for row in _sizes(placed, "_nth", weight=F.col("_rows")):
        per_ranking[row["_nth"]].append((row["_part"], row["_size"]))
    starts, total = [], 0
    for nth, parts in per_ranking.items():
        total = 0
        for part, size in sorted(parts):
            starts.append((part, nth, total))
            total += size

    spark = df.sparkSession
    offsets = spark.createDataFrame(starts, "_part bigint, _nth int, _start bigint")
    # Windows follow the stored range partitions, which are even in size.
    within = (
        Window.partitionBy("_part", "_nth")
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    running = (
        placed.withColumn("_part", _partition_of())
        .withColumn("_before", F.coalesce(F.sum("_rows").over(within), F.lit(0)))
        .join(F.broadcast(offsets), ["_part", "_nth"])
        .withColumn("_ahead", F.col("_start") + F.col("_before"))
    )
    result = df
    for nth, name in enumerate(names):
        ranks = running.filter(F.col("_nth") == nth).select(
            F.col(f"_key{nth}").alias(f"_value{nth}"), F.col("_ahead").alias(name)
        )
        result = result.join(
            ranks, F.col(keys[name].column).eqNullSafe(F.col(f"_value{nth}")), "left"
        ).drop(f"_value{nth}")
    return result, total
