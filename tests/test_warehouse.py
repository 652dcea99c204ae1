import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from bazaarlens.operators.keys import KeyViolation
from bazaarlens.plans import examples, intermediate
from bazaarlens.plans.warehouse import BUILD_STEPS, TABLES, Warehouse
from bazaarlens.schemas import RAW_COLUMNS
from bazaarlens.sources.layout import LAYOUTS
from bazaarlens.sources.synthetic import synthetic_reader

SMALL = contract.SMALL


@pytest.fixture(scope="module")
def layers(spark):
    return contract.warehouse(spark, SMALL)


def test_steps_cover_all_tables():
    assert sorted(name for step in BUILD_STEPS for name in step) == sorted(TABLES)


def test_build_and_reopen(spark, tmp_path):
    raw = synthetic_reader(spark, SMALL)
    built = Warehouse(spark, str(tmp_path / "w"), raw)
    built.build()
    reopened = Warehouse.reopen(spark, str(tmp_path / "w"), raw)
    for name in ("mart_customer_segments", "int_seller_status_history"):
        again = reopened.table(name)
        assert again.schema == built.table(name).schema
        assert again.exceptAll(built.table(name)).count() == 0
        assert again.count() > 0
    assert Warehouse.reopen(spark, str(tmp_path / "none"), raw)._versions == {}
    # the raw layer is stored too: counting it reads files and starts no job by itself
    assert {f"raw_{name}" for name in RAW_COLUMNS} <= set(built._versions)


def test_broken_key_keeps_the_published_version(spark, layers, tmp_path):
    data = {"twice": False}

    def raw(table):
        df = layers.raw(table)
        return df.unionAll(df) if data["twice"] and table == "sellers" else df

    house = Warehouse(spark, str(tmp_path), raw)
    before = house.table("stg_sellers").count()
    data["twice"] = True
    with pytest.raises(KeyViolation):
        house.refresh("stg_sellers")
    assert house.table("stg_sellers").count() == before
    report = house.key_report(("staging",)).filter("table_name = 'stg_sellers'").first()
    assert report["duplicate_rows"] == 0


def test_broken_key_on_first_use_publishes_nothing(spark, layers, tmp_path):
    def raw(table):
        df = layers.raw(table)
        return df.unionAll(df) if table == "sellers" else df

    house = Warehouse(spark, str(tmp_path), raw)
    with pytest.raises(KeyViolation):
        house.table("stg_sellers")
    assert "stg_sellers" not in house._versions
    assert "stg_sellers" not in Warehouse.reopen(spark, str(tmp_path), raw)._versions


def test_every_line_is_an_item(spark, layers):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert layers.table("stg_order_items").count() == lines


def test_raw_layer_is_stored_once(spark, tmp_path):
    asked = []

    def source(table):
        asked.append(table)
        return synthetic_reader(spark, SMALL)(table)

    house = Warehouse(spark, str(tmp_path), source)
    first = house.raw("orders")
    assert house.raw("orders").exceptAll(first).count() == 0
    assert asked == ["orders"]
    house.refresh("stg_sellers")
    house.refresh("stg_sellers")
    assert asked == ["orders", "sellers", "sellers"]


def test_monthly_folders_are_pruned(layers):
    enriched = layers.table("int_orders_enriched")
    march = enriched.filter("order_year = 1998 and order_month = 3")
    filters = plan(march).split("PartitionFilters: [")[1].split("]")[0]
    assert "order_year" in filters and "order_month" in filters
    report = examples.state_on_time_value(enriched, start="1998-01-01", end="1998-06-30")
    filters = plan(report).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "order_year" in filters and "order_month" in filters
    by_date = enriched.filter("order_date between date'1998-01-01' and date'1998-06-30'")
    expected = by_date.filter("delivery_status = 'on_time'").count()
    assert report.agg(F.sum("orders")).first()[0] == expected


def test_categories_are_not_copied_for_each_count(layers):
    assert "Expand" not in plan(layers.derive("mart_product_category_analysis"))


def test_one_hot_order_seller_and_customer(spark, layers, tmp_path):
    """A third of all lines in one order and with one seller, broadcasts off."""

    def raw(table):
        df = layers.raw(table)
        if table == "order_items":
            hot = F.pmod(F.xxhash64("order_id", "order_item_id"), F.lit(3)) == 0
            number = F.concat("order_id", F.lit("-"), "order_item_id")
            return df.select(
                F.when(hot, "o1").otherwise(F.col("order_id")).alias("order_id"),
                F.when(hot, number).otherwise(F.col("order_item_id")).alias("order_item_id"),
                "product_id",
                F.when(hot, "s1").otherwise(F.col("seller_id")).alias("seller_id"),
                *df.columns[4:],
            )
        return df

    data = raw("order_items").select("order_id", "seller_id", F.col("price").cast("decimal(10,2)"))
    items = data.withColumn("freight_value", F.col("price")).withColumn("product_id", F.lit("p"))
    enriched = layers.table("int_orders_enriched")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = intermediate._sales_profile(items, enriched, "seller_id").select(
            "seller_id", "_orders", "_items", "_price"
        )
        expected = items.groupBy("seller_id").agg(
            F.count_distinct("order_id").alias("_orders"),
            F.count(F.lit(1)).alias("_items"),
            F.sum("price").alias("_price"),
        )
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_invariants(layers):
    revenue = layers.table("stg_order_items").agg(F.sum("price")).first()[0]
    for name in ("int_seller_performance", "int_product_performance"):
        assert layers.table(name).agg(F.sum("total_revenue")).first()[0] == revenue
    history = layers.table("int_seller_status_history")
    per_seller = history.groupBy("seller_id").agg(
        F.count_if("is_current").alias("current"), F.count(F.lit(1)).alias("n"),
        F.sum(F.datediff("valid_to", "valid_from") + 1).alias("days"),
        F.datediff(F.max("valid_to"), F.min("valid_from")).alias("span"),
    )
    assert per_seller.filter("current <> 1 or days <> span + 1").count() == 0
    numbers = history.agg(F.min("scd_id"), F.max("scd_id"), F.count_distinct("scd_id")).first()
    assert numbers[0] == 1 and numbers[1] == numbers[2] == history.count()
    people = layers.table("mart_customer_segments")
    for name in ("recency_quintile", "frequency_quintile", "monetary_quintile"):
        sizes = [r["count"] for r in people.groupBy(name).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_global_window_over_entities(layers):
    scorecard = plan(layers.derive("mart_seller_scorecard"))
    assert "SinglePartition" not in scorecard
    # The scalar maximum may end in one row; nothing is ranked in one task.
    assert "Window" not in plan(layers.derive("mart_customer_segments"))
    # The surrogate key is a join of stored rows with one offset per partition.
    history = plan(layers.derive("int_seller_status_history"))
    assert "Window" not in history and "SinglePartition" not in history


def test_plans_prune_push_and_limit(spark, layers):
    reports = contract._REPORTS

    def report(name):
        build, tables, options = reports[name]
        return plan(build(*[layers.read(t) for t in tables], **options))

    assert "WindowGroupLimit" in report("q05_top_sellers_per_state")
    assert "TakeOrderedAndProject" in report("q06_repeat_order_gap")
    assert "TakeOrderedAndProject" in report("q12_sellers_above_state_avg")
    status = report("ex_count_by_status")
    assert "EqualTo(order_status,shipped)" in status
    assert "ReadSchema: struct<order_status:string>" in status
    weekday = report("q08_delivery_by_dow")
    assert "customer_unique_id" not in weekday
    for name in reports:
        if name != "q16_shared_customer_pairs":
            text = report(name)
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
            assert "Python" not in text and "BatchEval" not in text, name


def test_layouts_name_real_columns(layers):
    for name, layout in LAYOUTS.items():
        columns = set(layers.table(name).columns)
        used = (layout.order, layout.folders, layout.unique, layout.bloom)
        assert {column for part in used for column in part} <= columns
        layers.table(name).selectExpr(*layout.curve)


def test_missing_tables_of_one_step_are_written_together(spark, tmp_path):
    """A table asked for alone has what it needs stored, step by step, and nothing else."""
    from threading import Barrier

    both = Barrier(2, timeout=60)  # broken if one waits alone

    class Watched(Warehouse):
        def _checked(self, name):
            if name in ("stg_products", "stg_order_items"):
                both.wait()
            return super()._checked(name)

    house = Watched(spark, str(tmp_path), synthetic_reader(spark, SMALL))
    needed = {"stg_products", "stg_order_items", "int_orders_enriched", "mart_product_category_analysis"}
    assert house.table("mart_product_category_analysis").count() > 0
    stored = set(house._versions)
    assert needed <= stored and "stg_sellers" not in stored and "raw_sellers" not in stored
    assert not any(name.startswith(("int_", "mart_")) for name in stored - needed)
    before = dict(house._versions)
    house.gather(needed)
    assert house._versions == before
