"""Publication, failed checks, and deletion of what nothing names any more."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from bazaarlens.operators.keys import KeyViolation, key_report
from bazaarlens.operators.scratch import session_folder
from bazaarlens.plans import analytics
from bazaarlens.plans.warehouse import TABLES, Warehouse
from bazaarlens.sources.buckets import BUCKETS, read_buckets, write_buckets
from bazaarlens.sources.files import Files, written_at

SMALL = contract.SMALL


@pytest.fixture(scope="module")
def layers(spark):
    return contract.warehouse(spark, SMALL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def versions(root, *names):
    return sorted(p.name for p in Path(root, *names).iterdir() if p.is_dir())


def test_failed_old_and_current_versions(spark, layers, tmp_path):
    data = {"twice": False}

    def raw(table):
        df = layers.raw(table)
        return df.unionAll(df) if data["twice"] and table == "sellers" else df

    root = str(tmp_path)
    house = Warehouse(spark, root, raw)
    old = house.table("stg_sellers")
    house.table("stg_orders")
    count = old.count()
    data["twice"] = True
    with pytest.raises(KeyViolation):
        house.refresh("stg_sellers")  # leaves a version that no manifest names
    data["twice"] = False
    house.refresh("stg_sellers")
    house.refresh("stg_orders")
    assert len(versions(root, "staging", "stg_sellers")) == 3
    assert len(versions(root, "staging", "stg_orders")) == 4  # two, each with its copy
    # readers of superseded versions are within their time
    assert house.vacuum(keep_seconds=3600) == []
    assert old.count() == count
    # and beyond it what the newest manifest does not name goes
    gone = house.vacuum(keep_seconds=0)
    assert len(versions(root, "staging", "stg_sellers")) == 1
    assert len(versions(root, "staging", "stg_orders")) == 2
    assert len(versions(root, "raw", "sellers")) == 1 and len(versions(root, "manifests")) == 1
    assert all(not Path(p).exists() for p in gone)
    again = Warehouse.reopen(spark, root, raw)
    assert again.table("stg_sellers").count() == count
    assert again.by_key("stg_orders").count() == layers.table("stg_orders").count()
    assert house.vacuum(keep_seconds=0) == []


def test_all_states_are_kept(spark, layers, tmp_path):
    """Parts of the history, of monthly states and of persons lie in several versions."""
    house = Warehouse(spark, str(tmp_path), layers.raw)
    house.build(check_keys=False)
    before = {n: house.table(n).count() for n in TABLES}
    first = sorted(map(tuple, house.derive("mart_state_performance").collect()), key=str)
    house.refresh("int_orders_enriched")
    house.refresh("mart_state_performance")
    house.extend_history()
    assert house.vacuum(keep_seconds=0)
    again = Warehouse.reopen(spark, str(tmp_path), layers.raw)
    assert {n: again.table(n).count() for n in TABLES} == before
    assert sorted(map(tuple, again.derive("mart_state_performance").collect()), key=str) == first
    for name in BUCKETS:
        again.by_key(name)


def test_manifests_stay_bounded(spark, layers, tmp_path):
    house = Warehouse(spark, str(tmp_path), layers.raw)
    for _ in range(6):
        house.refresh("stg_sellers")
        house.vacuum(keep_seconds=0)
    assert len(versions(tmp_path, "manifests")) == 1
    assert len(versions(tmp_path, "staging", "stg_sellers")) == 1
    # a manifest that was not completed is none
    unfinished = tmp_path / "manifests" / f"v{time.time_ns()}"
    unfinished.mkdir()
    assert Warehouse.reopen(spark, str(tmp_path), layers.raw).table("stg_sellers").count() > 0


def test_a_reader_of_a_superseded_manifest_has_its_time(spark, layers, tmp_path):
    """Retention counts from when a version was superseded, not from when it was written."""
    house = Warehouse(spark, str(tmp_path), layers.raw)
    house.table("stg_sellers")
    time.sleep(3)
    reader = house.table("stg_sellers")
    house.refresh("stg_sellers")  # only now is the first one old
    house.vacuum(keep_seconds=2)
    assert reader.count() > 0


def test_scratch_of_ended_sessions_goes(spark, layers, tmp_path):
    house = Warehouse(spark, str(tmp_path), layers.raw)
    folder = Path(session_folder(spark))
    ended = folder.parent / "app-ended" / "scratch" / "x"
    ended.mkdir(parents=True)
    (folder / "scratch").mkdir(parents=True, exist_ok=True)
    assert not any("app-ended" in p for p in house.vacuum(keep_seconds=3600))
    time.sleep(1.1)
    assert any("app-ended" in p for p in house.vacuum(keep_seconds=0))
    assert not ended.exists() and (folder / "scratch").exists()


def test_versions_carry_their_time(spark, tmp_path):
    assert written_at("/w/staging/t/v123") == written_at("/w/staging/t/v123-by-key") == 123
    assert written_at("/w/staging/t/other") == 0
    assert Files(spark).under(str(tmp_path / "none")) == []


@pytest.mark.parametrize("name", [n for n in BUCKETS if TABLES[n].key[0] == BUCKETS[n].key])
def test_key_checks_move_only_their_totals(layers, name):
    report = key_report(name, layers._keyed(name), TABLES[name].key)
    text = plan(report)
    assert "Exchange hashpartitioning" not in text and "Exchange SinglePartition" in text
    row = report.first()
    assert (row["null_key_rows"], row["duplicate_rows"]) == (0, 0)
    assert row["total_rows"] == layers.table(name).count()


def test_duplicates_in_any_bucket_are_found(spark, layers, tmp_path):
    """Rows repeated by other tasks, a hot key apart from the buckets, and missing keys."""
    items = layers.table("stg_order_items")
    twice = items.unionByName(items.filter("order_id = 'o7'").repartition(3)).unionByName(
        items.limit(5).withColumn("order_id", F.lit(None).cast("string"))
    )
    spec, path = BUCKETS["stg_order_items"], str(tmp_path / "copy")
    wide = write_buckets(twice, path, spec, 5, wide_rows=6)
    copy = read_buckets(spark, path, twice.schema, spec, 5, wide)
    row = key_report("t", copy, TABLES["stg_order_items"].key).first()
    assert wide and row["null_key_rows"] == 5
    assert row["duplicate_rows"] == items.filter("order_id = 'o7'").count() > 0
    assert row["total_rows"] == twice.count()


def test_grouping_sets_without_copies_of_lines(spark, layers):
    for name in ("q10_rollup_state_category", "q11_cube_state_category"):
        build, tables, options = contract._REPORTS[name]
        text = plan(build(*[layers.read(t) for t in tables], **options))
        assert "Expand" not in text


def test_an_order_in_three_categories_counts_once_per_group(spark):
    items = spark.createDataFrame(
        [("o1", p, 1.0) for p in "abcc"] + [("o2", "a", None), ("o3", "d", 9.0), ("o4", "b", 2.0)],
        "order_id string, product_id string, price double",
    ).withColumn("price", F.col("price").cast("decimal(10,2)"))
    products = spark.createDataFrame(
        [("a", "x"), ("b", "y"), ("c", "z"), ("d", "other"), ("e", None)],
        "product_id string, product_category string",
    )
    enriched = spark.createDataFrame(
        [("o1", "S"), ("o2", "S"), ("o3", "S"), ("o4", "T"), ("o5", "U")],
        "order_id string, customer_state string",
    )
    got = analytics.cube_state_category(
        items, products, enriched, states=("S", "T", "U"), categories=("x", "y", "z")
    )
    assert {(r["state"], r["category"]): (r["orders"], r["revenue"] and float(r["revenue"])) for r in got.collect()} == {
        ("S", "x"): (2, 1.0), ("S", "y"): (1, 1.0), ("S", "z"): (1, 2.0), ("S", "** ALL **"): (2, 4.0),
        ("T", "y"): (1, 2.0), ("T", "** ALL **"): (1, 2.0),
        ("** ALL **", "x"): (2, 1.0), ("** ALL **", "y"): (2, 3.0), ("** ALL **", "z"): (1, 2.0),
        ("** ALL **", "** ALL **"): (3, 6.0),
    }
    only_null = analytics.cube_state_category(
        items.filter("order_id = 'o2'"), products, enriched, states=("S",), categories=("x",)
    )
    assert {(r["orders"], r["revenue"]) for r in only_null.collect()} == {(1, None)}
    assert analytics.cube_state_category(items.limit(0), products, enriched).count() == 0
    rolled = analytics.rollup_state_category(
        items, products, enriched, states=("S", "T"), categories=("x", "y", "z")
    ).collect()
    assert [(r["state"], r["is_state_total"], r["is_category_total"]) for r in rolled][-1] == ("** ALL STATES **", 1, 1)
    assert len(rolled) == 7
