"""How stored tables are laid out so that filters can skip data.

The secondary indexes of a row store become file layout: rows are ordered on the
columns filters use, so Parquet row-group statistics exclude most of a table, and
optionally partitioned into folders. Where several columns are looked up, rows follow a
curve through all of them. Columns looked up by single values that are all over the files
get Bloom filters. Jobs that go by order read the copies in buckets instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bazaarlens.functions import rising
from bazaarlens.operators.curve import rank_bounds, with_curve_position
from bazaarlens.operators.scratch import release, shuffles_dropped, stored

#: Codec of stored tables: they lie beside one another in several layers and copies.
CODEC = "zstd"


@dataclass(frozen=True)
class Layout:
    """Order of rows in the files, and folder columns.

    With ``spread`` each file holds one range of the order, at the price of a
    shuffle; ``unique`` then ends the order so that a very frequent value of the
    leading columns still spreads over many files. Without it every task sorts
    what it writes. ``curve`` expressions come after the folders and before the order, all
    of them with equal weight.
    """

    order: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    spread: bool = False
    folders: tuple[str, ...] = ()
    curve: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()


LAYOUTS = {
    # Narrow and looked up by time: worth a shuffle.
    "stg_orders": Layout(
        order=("order_purchase_timestamp",),
        unique=("order_id",),
        spread=True,
        bloom=("customer_id",),
    ),
    "stg_order_items": Layout(
        curve=("product_id", "seller_id"), unique=("order_id", "order_item_id"), spread=True
    ),
    "stg_order_payments": Layout(order=("payment_type",)),
    "stg_order_reviews": Layout(order=("review_score",)),
    # Monthly folders, so that a range of dates opens only its months.
    "int_orders_enriched": Layout(
        folders=("order_year", "order_month"),
        curve=("customer_state", "date_format(order_date, 'dd')"),
        unique=("order_id",),
        spread=True,
    ),
    "int_seller_status_history": Layout(order=("seller_id", "valid_from")),
}


def write_table(df: DataFrame, path: str, layout: Layout | None = None) -> None:
    """Write ``df`` as Parquet, clustered when a layout is given."""
    if layout is None:
        with shuffles_dropped(df.sparkSession):
            df.write.option("compression", CODEC).parquet(path)
        return
    filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in layout.bloom}
    place: tuple[str, ...] = ()
    if layout.curve:
        place = ("_place",)
        df = stored(df)  # read twice: for the bounds and to be dealt out
        bounds = rank_bounds(df, layout.curve)
        placed = with_curve_position(df, layout.curve, bounds, "_place")
    else:
        placed = df
    order = [rising(c) for c in (*layout.folders, *place, *layout.order, *layout.unique)]
    if layout.spread:
        placed = placed.repartitionByRange(*order)
    if order:
        placed = placed.sortWithinPartitions(*order)
    with shuffles_dropped(df.sparkSession):
        (
            placed.drop(*place)
            .write.options(compression=CODEC, **filters)
            .partitionBy(*layout.folders)
            .parquet(path)
        )
    if layout.curve:
        release(df)


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Scan a stored table with a known schema, columns in their declared order."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(schema).parquet(*paths).select(*(columns or schema.names))
