"""Copies in buckets: what they hold, and that joins over them move nothing."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from bazaarlens.operators.bitmaps import numbered_lists, sums_and_distinct
from bazaarlens.plans import intermediate, marts
from bazaarlens.plans.warehouse import TABLES, ByKey, Warehouse
from bazaarlens.sources import buckets
from bazaarlens.sources.buckets import BUCKETS, Buckets, Dealt, dealt, read_buckets, write_buckets
from bazaarlens.sources.synthetic import synthetic_reader

SMALL = contract.SMALL


@pytest.fixture(scope="module")
def layers(spark):
    return contract.warehouse(spark, SMALL)


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def without_broadcasts(spark):
    return settings(spark, spark__sql__autoBroadcastJoinThreshold="-1")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange \w+\((.*?)\), ENSURE_REQUIREMENTS", plan(df))


@pytest.mark.parametrize("name", BUCKETS)
def test_copies_hold_every_row(layers, name):
    spec, whole = BUCKETS[name], layers.table(name)
    names = [c for c in whole.columns if not spec.columns or c in spec.columns]
    copy = dealt(layers.by_key(name)).rows()
    assert copy.columns == names
    assert copy.exceptAll(whole.select(*names)).count() == 0
    assert copy.count() == whole.count()


@pytest.mark.parametrize(
    ("name", "rest"),
    [
        # what is still shuffled: customers, parties and their joins, report groups
        ("int_orders_enriched", {"customer_id"}),
        ("int_seller_performance", {"seller_id"}),
        ("int_product_performance", {"product_id"}),
        ("q07_payment_trends", {"quarter"}),
    ],
)
def test_nothing_is_shuffled_by_order(spark, layers, name, rest):
    with without_broadcasts(spark):
        if name in TABLES:
            df = layers.derive(name)
        else:
            build, tables, options = contract._REPORTS[name]
            df = build(*[layers.read(t) for t in tables], **options)
        assert plan(df).count("Bucketed: true") >= 2
        moved = exchanges(df)
        assert moved and not any("order_id" in keys for keys in moved)
        assert {re.match(r"\w+", keys)[0] for keys in moved} <= rest
        assert df.count() > 0


def test_a_party_is_summed_up_with_one_shuffle(spark, layers):
    items, enriched = layers.by_key("stg_order_items"), layers.by_key("int_orders_enriched")
    for party in ("seller_id", "product_id"):
        with without_broadcasts(spark):
            profile = intermediate._sales_profile(items, enriched, party)
            assert len(exchanges(profile)) == 1


def test_other_session_reads_the_copies(spark, tmp_path):
    raw = synthetic_reader(spark, SMALL)
    built = Warehouse(spark, str(tmp_path), raw, buckets=3)
    built.table("int_orders_enriched")
    reopened = Warehouse.reopen(spark.newSession(), str(tmp_path), raw)
    # the catalog of a new application is empty
    for version in reopened._versions.values():
        if version.buckets:
            spark.sql(f"DROP TABLE {buckets._entry(version.copy)}")
    with without_broadcasts(reopened.spark):
        again = reopened.derive("int_orders_enriched")
        assert not any("order_id" in keys for keys in exchanges(again))
        assert "SelectedBucketsCount: 3 out of 3" in plan(again)
        assert sorted(map(tuple, again.collect()), key=str) == sorted(
            map(tuple, reopened.table("int_orders_enriched").collect()), key=str
        )


def task_rows(df):
    """Rows that each task of a scan reads."""
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


@pytest.fixture(scope="module")
def hot(spark, layers):
    """A third of all lines in one order, some without order, payments likewise."""

    def moved(df, number):
        draw = F.pmod(F.xxhash64(*df.columns), F.lit(30))
        order = F.when(draw < 10, "o1").when(draw == 11, None).otherwise(F.col("order_id"))
        return df.withColumn("order_id", order).withColumn(
            number, F.monotonically_increasing_id().cast("int")
        )

    return {
        "stg_order_items": moved(layers.table("stg_order_items"), "order_item_id"),
        "stg_order_payments": moved(layers.table("stg_order_payments"), "payment_sequential"),
    }


def test_a_hot_order_lies_apart(spark, hot, tmp_path):
    for name, df in hot.items():
        path = str(tmp_path / name)
        assert write_buckets(df, path, BUCKETS[name], 4, wide_rows=500)
        copy = read_buckets(spark, path, df.schema, BUCKETS[name], 4, True)
        assert copy.wide.select("order_id").distinct().count() == 2  # o1 and none
        names = copy.bucketed.columns
        assert copy.rows().exceptAll(df.select(*names)).count() == 0
        assert copy.rows().count() == df.count()
        with settings(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
            assert max(task_rows(copy.bucketed)) < df.count() / 3


def test_results_do_not_depend_on_where_a_hot_order_lies(spark, layers, hot, tmp_path):
    copies = {}
    for name, df in hot.items():
        path = str(tmp_path / name)
        write_buckets(df, path, BUCKETS[name], 4, wide_rows=500)
        copies[name] = read_buckets(spark, path, df.schema, BUCKETS[name], 4, True)
    items, payments = copies["stg_order_items"], copies["stg_order_payments"]
    orders, customers = layers.table("stg_orders"), layers.table("stg_customers")
    reviews, products = layers.table("stg_order_reviews"), layers.table("stg_products")
    enriched, sellers = layers.table("int_orders_enriched"), layers.table("stg_sellers")
    for build in (
        lambda i, p: intermediate.orders_enriched(orders, customers, i, p, reviews),
        lambda i, p: intermediate.seller_performance(sellers, i, enriched),
        lambda i, p: intermediate.product_performance(products, i, enriched),
        lambda i, p: intermediate.customer_history(enriched, p),
        lambda i, p: marts.product_category_analysis(i, products, enriched),
    ):
        plain = build(hot["stg_order_items"], hot["stg_order_payments"])
        apart = build(items, payments)
        assert sorted(map(str, apart.collect())) == sorted(map(str, plain.collect()))


def test_a_hot_order_is_summed_up_before_it_moves(spark, layers, hot, tmp_path):
    """The rows that the shuffle of the wide part gets: one per party and task."""
    df = hot["stg_order_items"]
    path = str(tmp_path / "items")
    write_buckets(df, path, BUCKETS["stg_order_items"], 4, wide_rows=500)
    copy = read_buckets(spark, path, df.schema, BUCKETS["stg_order_items"], 4, True)
    summed = copy.wide.filter("seller_id IS NOT NULL").groupBy("seller_id", "order_id").count()
    assert "partial_count" in plan(summed)
    assert summed.count() < copy.wide.count() / 5


def test_without_frequent_keys_there_is_one_part(spark, tmp_path):
    df = spark.range(100).selectExpr("cast(id % 40 as string) as k", "id")
    assert not write_buckets(df, str(tmp_path / "a"), Buckets("k"), 2)
    copy = read_buckets(spark, str(tmp_path / "a"), df.schema, Buckets("k"), 2, False)
    assert copy.wide is None and copy.rows().count() == 100
    empty = df.limit(0)
    assert not write_buckets(empty, str(tmp_path / "b"), Buckets("k"), 2)
    assert read_buckets(spark, str(tmp_path / "b"), df.schema, Buckets("k"), 2, False).rows().count() == 0
    assert isinstance(dealt(copy), Dealt) and ByKey("x") == ByKey("x")


def test_bitmaps_count_exactly(spark):
    """More numbers than one bitmap has bits, groups without numbers, and a NULL group."""
    rows = spark.range(90_000).selectExpr(
        "case when id % 3 = 0 then null when id % 3 = 1 then 'a' else 'b' end as g",
        "cast(id % 7 as decimal(10,2)) as x", "id + 1 as n", "id % 10 + 1 as m",
    ).selectExpr("g", "x", "array(n, n, m) as both", "case when g = 'a' then array(m) end as few")
    empty = spark.createDataFrame([("none", 1)], "g string, x int").selectExpr(
        "g", "cast(x as decimal(10,2)) as x", "cast(array() as array<bigint>) as both",
        "cast(null as array<bigint>) as few",
    )
    given = rows.unionByName(empty)
    got = sums_and_distinct(given, "g", {"total": "x"}, {"all": "both", "some": "few"})
    expected = given.groupBy("g").agg(F.sum("x").alias("total")).join(
        given.select(F.col("g").alias("h"), F.explode_outer("both").alias("n"))
        .groupBy("h").agg(F.count_distinct("n").alias("all")),
        F.col("g").eqNullSafe(F.col("h")),
    )
    found = {r["g"]: (r["total"], r["all"], r["some"]) for r in got.collect()}
    assert {g: v[:2] for g, v in found.items()} == {
        r["g"]: (r["total"], r["all"]) for r in expected.collect()
    }
    assert {g: v[2] for g, v in found.items()} == {None: 0, "a": 10, "b": 0, "none": 0}


def test_lists_are_numbered_densely(spark):
    near = spark.createDataFrame([("b", "y"), ("a", "z"), ("c", "y"), ("d", None)], "id string, near string")
    plain = spark.createDataFrame([("b",), ("a",)], "id string")
    first, second = numbered_lists(near, plain)
    assert sorted(map(tuple, first.select("id", "_number").collect())) == [
        ("a", 3), ("b", 1), ("c", 2), ("d", 4)
    ]
    assert sorted(map(tuple, second.collect())) == [("a", 5), ("b", 6)]


def test_categories_come_from_one_join(spark, layers):
    with without_broadcasts(spark):
        derived = layers.derive("mart_product_category_analysis")
        text = plan(derived)
    assert "Expand" not in text
    # both sides of the one join of items with orders are read from buckets
    assert text.count("Bucketed: true") == 2
    assert not any(keys.startswith("order_id") and "," not in keys for keys in exchanges(derived))


def test_no_sets_are_gathered_for_categories(spark, layers):
    """Sets of sellers and products by order would be aggregates that sort all lines."""
    assert "ObjectHashAggregate" not in plan(layers.derive("mart_product_category_analysis"))


def test_members_and_single_numbers_are_counted(spark):
    """Ids without numbers, also NULL, beside plain numbers; sums are those of all rows."""
    given = spark.range(5000).selectExpr(
        "if(id % 5 = 0, null, 'a') as g", "cast(id % 3 as long) as x", "if(id % 2 = 0, id % 100, null) as n",
        "if(id % 7 = 0, null, concat('o', id % 900)) as o",
    )
    got = sums_and_distinct(given, "g", {"total": "x"}, {"numbers": "n"}, ("members", "o"))
    expected = given.groupBy("g").agg(
        F.sum("x").alias("total"), F.count_distinct("n").alias("numbers"), F.count_distinct("o").alias("members")
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
