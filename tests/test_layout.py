"""What a stored layout lets a scan skip, read from file footers and scan metrics."""

import random
import time
from datetime import date, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bazaarlens.operators.curve import curve_position, rank_bounds, with_curve_position
from bazaarlens.sources.buckets import Buckets, write_buckets
from bazaarlens.sources.layout import LAYOUTS, Layout, read_table, write_table

FILES = 64


@pytest.fixture
def many_files(spark):
    """One file per range, as a large table has."""
    names = {
        "spark.sql.shuffle.partitions": str(FILES),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def row_groups(path):
    """Per row group: least and greatest value of each column with statistics."""
    found = []
    for file in sorted(Path(path).rglob("*.parquet")):
        metadata = pq.ParquetFile(file).metadata
        for i in range(metadata.num_row_groups):
            group = metadata.row_group(i)
            bounds = {}
            for j in range(group.num_columns):
                column = group.column(j)
                if column.statistics is not None and column.statistics.has_min_max:
                    bounds[column.path_in_schema] = (column.statistics.min, column.statistics.max)
            found.append((str(file.parent.relative_to(path)), bounds))
    return found


def holding(groups, column, value):
    return sum(low <= value <= high for _, b in groups for low, high in [b[column]])


def items(spark, hot=0.0):
    rng = random.Random(1)
    data = [
        (
            f"o{i // 3}",
            i % 3 + 1,
            "p00007" if rng.random() < hot else f"p{rng.randrange(2000):05d}",
            f"s{rng.randrange(500):04d}" if i % 50 else None,
        )
        for i in range(30_000)
    ]
    return spark.createDataFrame(
        data, "order_id string, order_item_id int, product_id string, seller_id string"
    )


def test_one_product_and_one_seller_lie_in_few_row_groups(spark, many_files, tmp_path):
    df, path = items(spark), str(tmp_path / "items")
    write_table(df, path, LAYOUTS["stg_order_items"])
    groups = row_groups(path)
    assert len(groups) == FILES
    # an eighth of the files is the square root of their number; allow its double
    for column, values in (("product_id", ["p00003", "p01000", "p01999"]), ("seller_id", ["s0001", "s0250"])):
        for value in values:
            assert 1 <= holding(groups, column, value) <= FILES / 4
    stored = read_table(spark, path, df.schema)
    assert stored.exceptAll(df).count() == 0 and stored.count() == df.count()
    # without the curve, or sorted by one column, the other is everywhere
    write_table(df, str(tmp_path / "plain"), Layout(order=("product_id",), unique=("order_id",), spread=True))
    assert holding(row_groups(tmp_path / "plain"), "seller_id", "s0250") == FILES


def scanned(df):
    """Rows that the scan of a collected filter has read."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().get("numOutputRows").get().value()


def test_a_lookup_reads_a_part_of_the_rows(spark, many_files, tmp_path):
    df, path = items(spark), str(tmp_path / "items")
    write_table(df, path, LAYOUTS["stg_order_items"])
    for condition in ("product_id = 'p01000'", "seller_id = 's0250'"):
        found = read_table(spark, path, df.schema).filter(condition)
        assert found.count() == df.filter(condition).count() > 0
        assert scanned(read_table(spark, path, df.schema).filter(condition)) <= df.count() / 4


def test_a_hot_product_spreads_over_many_files(spark, many_files, tmp_path):
    df, path = items(spark, hot=0.4), str(tmp_path / "items")
    write_table(df, path, LAYOUTS["stg_order_items"])
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in Path(path).rglob("*.parquet")]
    assert sum(sizes) == 30_000 and max(sizes) < 30_000 / 10


def test_a_state_and_month_lie_in_few_row_groups(spark, many_files, tmp_path):
    rng = random.Random(2)
    start = date(2018, 1, 1)
    data = []
    for i in range(20_000):
        day = start + timedelta(days=rng.randrange(120))
        data.append((f"o{i}", f"S{rng.randrange(25):02d}", day, day.year, day.month))
    df = spark.createDataFrame(
        data, "order_id string, customer_state string, order_date date, order_year int, order_month int"
    )
    path = str(tmp_path / "orders")
    write_table(df, path, LAYOUTS["int_orders_enriched"])
    groups = row_groups(path)
    march = [g for g in groups if g[0].endswith("order_month=3")]
    assert len(groups) >= FILES and 8 <= len(march) <= FILES / 2
    assert 1 <= holding(march, "customer_state", "S10") <= len(march) / 2
    assert 1 <= holding(march, "order_date", date(2018, 3, 11)) <= len(march) / 2
    both = [g for g in march if holding([g], "customer_state", "S10") and holding([g], "order_date", date(2018, 3, 11))]
    assert 1 <= len(both) <= len(march) / 4


def test_bloom_filter_skips_an_absent_customer(spark, many_files, tmp_path):
    """Customers are all over files ordered by time: only the filter tells."""
    data = [(f"c{i * 7919 % 20000:05d}", f"o{i}", i) for i in range(20_000)]
    df = spark.createDataFrame(data, "customer_id string, order_id string, n int").withColumn(
        "order_purchase_timestamp", F.expr("timestamp_ntz'2018-01-01 00:00:00' + make_dt_interval(0, 0, n)")
    )
    path = str(tmp_path / "orders")
    write_table(df, path, LAYOUTS["stg_orders"])
    assert holding(row_groups(path), "customer_id", "c10000") > FILES * 0.9
    one = read_table(spark, path, df.schema).filter("customer_id = 'c10000'")
    assert one.count() == 1
    assert scanned(read_table(spark, path, df.schema).filter("customer_id = 'c10000'")) < 20_000 / 10


def test_no_filter_on_columns_of_few_values():
    assert "order_status" not in LAYOUTS["stg_orders"].bloom


def test_places_on_the_curve(spark):
    """Four by four cells in the order of a Z: the bits of both ranks take turns."""
    df = spark.createDataFrame([(a, b) for a in "abcd" for b in "wxyz"], "a string, b string")
    bounds = [["b", "c", "d"], ["x", "y", "z"]]
    got = {
        (r["a"], r["b"]): r["place"]
        for r in df.select("a", "b", curve_position(("a", "b"), bounds).alias("place")).collect()
    }
    for (a, b), place in got.items():
        x, y = "abcd".index(a), "wxyz".index(b)
        assert place == (x >> 1) * 8 + (y >> 1) * 4 + (x & 1) * 2 + (y & 1)
    nulls = spark.createDataFrame([(None, "w"), ("a", None)], "a string, b string")
    assert {r[0] for r in nulls.select(curve_position(("a", "b"), bounds)).collect()} == {0}
    none = rank_bounds(nulls.limit(0), ("a", "b"))
    assert none == [[], []]
    assert nulls.select(curve_position(("a", "b"), none)).first()[0] == 0


def test_compiled_places_equal_interpreted_ones(spark):
    rows = [(f"p{i * 37 % 101}" if i % 9 else None, f"é{i % 5}" if i % 7 else "") for i in range(900)]
    df = spark.createDataFrame(rows, "a string, b string")
    columns = ("a", "concat(b, 'x')")
    for bounds in (rank_bounds(df, columns), [[], rank_bounds(df, ("b",))[0]], [[], []]):
        both = with_curve_position(df, columns, bounds, "place")
        assert both.columns == ["a", "b", "place"]
        assert both.filter(F.col("place") != curve_position(columns, bounds)).count() == 0
    plan = with_curve_position(df, columns, rank_bounds(df, columns), "place")
    assert "lambda" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_stored_tables_and_copies_are_packed_tightly(spark, tmp_path):
    """Layers and their copies lie beside one another on disk, and no shuffle files beside them."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for folder in disk.localDirsString() for f in Path(folder).rglob("shuffle_*")}

    before = shuffled()
    rows = spark.range(50).selectExpr("'o' || id AS order_id", "id % 3 AS payment_type")
    write_table(rows, f"{tmp_path}/plain")
    write_table(rows, f"{tmp_path}/placed", LAYOUTS["stg_order_payments"])
    write_buckets(rows, f"{tmp_path}/copy", Buckets("order_id"), 2, 100)
    write_buckets(rows, f"{tmp_path}/wide", Buckets("payment_type"), 2, 10)
    until = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    files = [f for f in tmp_path.rglob("*.parquet")]
    assert {f.parent.name for f in files} >= {"plain", "placed", "buckets", "wide"}
    for file in files:
        meta = pq.ParquetFile(file).metadata
        assert {meta.row_group(g).column(0).compression for g in range(meta.num_row_groups)} <= {"ZSTD"}
