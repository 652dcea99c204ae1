"""Copies of tables dealt into buckets by a join key.

Tables that are joined and summed up by order get a second copy, narrowed to what those
jobs read: one sorted file for each bucket of the key. Two such copies with as many buckets
are joined, and each is grouped by its key, without a shuffle; the shuffle is paid once, when
the copy is written. Rows of a key with more than ``WIDE_ROWS`` rows, and rows without a
key, would make one bucket as large as they are: they lie apart, dealt evenly, and are summed
up in every task before they move.

Buckets need a catalog entry. It is an external table of the session's catalog whose name
comes from the path, declared again by any session that reads the copy; dropping it leaves
the files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaarlens.operators.scratch import release, shuffles_dropped, stored
from bazaarlens.sources.layout import CODEC

#: Rows of one key that a bucket takes.
WIDE_ROWS = 100_000


@dataclass(frozen=True)
class Buckets:
    """Key and columns (all, if none are named) of a copy; ``unique``: one row per key."""

    key: str
    columns: tuple[str, ...] = ()
    unique: bool = False

    def narrowed(self, schema: StructType) -> StructType:
        return StructType([f for f in schema.fields if not self.columns or f.name in self.columns])


@dataclass(frozen=True)
class Dealt:
    """A table in buckets, and apart from them its rows of very frequent keys."""

    bucketed: DataFrame
    wide: DataFrame | None = None

    def each(self, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """What ``work`` makes of either part, together. No key has rows in both."""
        done = work(self.bucketed)
        return done if self.wide is None else done.unionByName(work(self.wide))

    def rows(self) -> DataFrame:
        return self.each(lambda part: part)


def dealt(table: DataFrame | Dealt) -> Dealt:
    """The table as it is, without buckets, if it has none."""
    return table if isinstance(table, Dealt) else Dealt(table)


BUCKETS = {
    "stg_customers": Buckets(
        "customer_id",
        ("customer_id", "customer_unique_id", "customer_city", "customer_state"),
        unique=True,
    ),
    "stg_orders": Buckets("order_id", unique=True),
    "stg_order_items": Buckets(
        "order_id",
        ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
    ),
    "stg_order_payments": Buckets("order_id"),
    "stg_order_reviews": Buckets("order_id", ("order_id", "review_score"), unique=True),
    "int_orders_enriched": Buckets(
        "order_id",
        (
            "order_id",
            "customer_unique_id",
            "customer_state",
            "order_status",
            "order_purchase_timestamp",
            "order_delivered_customer_date",
            "total_order_value",
            "review_score",
        ),
        unique=True,
    ),
}


def _entry(path: str) -> str:
    return f"bazaarlens_{hashlib.md5(path.encode()).hexdigest()}"


def frequent_keys(rows: DataFrame, key: str, more_than: int = WIDE_ROWS) -> DataFrame:
    """Stored list ``_key`` of the keys with more rows than that, and NULL if rows have none."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    wide = (F.col("_rows") > more_than) | F.col(key).isNull()
    return stored(counts.filter(wide).select(F.col(key).alias("_key")))


def write_buckets(
    table: DataFrame, path: str, spec: Buckets, count: int, wide_rows: int = WIDE_ROWS
) -> bool:
    """Write the copy of a stored table; say whether it has very frequent keys.

    Each bucket is written by one task as one file. Rows per key are counted before
    anything else moves, so no task receives more than ``wide_rows`` rows of one key.
    """
    key = spec.key
    rows = table.select(*spec.narrowed(table.schema).names)
    wide = False
    if not spec.unique:
        apart = frequent_keys(rows, key, wide_rows)
        if not apart.isEmpty():
            wide, same = True, F.col(key).eqNullSafe(F.col("_key"))
            rows.join(apart, same, "left_semi").write.option("compression", CODEC).parquet(
                f"{path}/wide"
            )
            rows = rows.join(apart, same, "left_anti")
    # inserted, not saved as a table: then the shuffle is the write's own and goes with it
    name = _declared(table.sparkSession, path, spec.narrowed(table.schema), spec, count)
    with shuffles_dropped(table.sparkSession):
        rows.repartition(count, key).write.insertInto(name)
    if not spec.unique:
        release(apart)
    return wide


def _declared(spark: SparkSession, path: str, kept: StructType, spec: Buckets, count: int) -> str:
    """Name of the catalog's table of the buckets under ``path``, which is made if it is not there."""
    name = _entry(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (compression '{CODEC}') "
        f"CLUSTERED BY (`{spec.key}`) SORTED BY (`{spec.key}`) INTO {count} BUCKETS "
        f"LOCATION '{path}/buckets'"
    )
    return name


def read_buckets(
    spark: SparkSession, path: str, schema: StructType, spec: Buckets, count: int, wide: bool
) -> Dealt:
    """The copy under ``path`` of a table with the given schema."""
    kept = spec.narrowed(schema)
    name = _declared(spark, path, kept, spec, count)
    apart = spark.read.schema(kept).parquet(f"{path}/wide") if wide else None
    return Dealt(spark.table(name), apart)


def forget_buckets(spark: SparkSession, path: str) -> None:
    """Drop this session's catalog entry of a copy, if it has one."""
    spark.sql(f"DROP TABLE IF EXISTS {_entry(path)}")
