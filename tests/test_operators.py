import random
from collections import Counter, defaultdict
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlens.functions import rising
from bazaarlens.operators.keys import KeyViolation, key_report, require_key
from bazaarlens.operators.modal import aggregate_with_modes, ballot
from bazaarlens.operators.numbering import number_small_groups, number_within
from bazaarlens.operators.pairs import (
    _met_by_rare_items,
    _pair_counts,
    items_left_out,
    top_shared_pairs,
)
from bazaarlens.operators.placement import SortKey, ntile_columns, row_numbers, with_rows_ahead


@pytest.fixture(scope="module")
def people(spark):
    """Heavy ties and NULLs over several partitions."""
    rng = random.Random(7)
    data = [
        (
            f"id{i:05d}",
            rng.choice([1, 1, 1, 1, 2, 3, None]),
            rng.choice([None, *[Decimal(n) / 4 for n in range(300)]]),
        )
        for i in range(3001)
    ]
    return spark.createDataFrame(data, "id string, orders int, value decimal(10,2)").repartition(5)


def test_row_numbers_match_a_global_window(people):
    numbered = row_numbers(people, [rising("value"), rising("id")], "n")
    expected = people.withColumn(
        "n", F.row_number().over(Window.orderBy(rising("value"), rising("id"))).cast("bigint")
    )
    assert numbered.exceptAll(expected).count() == 0
    assert numbered.count() == 3001


@pytest.mark.parametrize("take", [3001, 7, 3, 0])
def test_ntile_matches_the_built_in(people, take):
    df = people.orderBy("id").limit(take)
    keys = {
        "a": SortKey("orders"),
        "b": SortKey("value"),
        "c": SortKey("value", descending=True, nulls_first=True),
        "d": SortKey("orders", nulls_first=True),
    }
    cuts = ntile_columns(df, 5, "id", keys)
    got = df.select("id", *[column.alias(name) for name, column in cuts.items()])
    built_in = {
        name: F.ntile(5).over(Window.orderBy(key.on(F.col(key.column)), rising("id")))
        for name, key in keys.items()
    }
    expected = df.select("id", *[column.alias(name) for name, column in built_in.items()])
    assert got.exceptAll(expected).count() == 0
    assert got.count() == take


def test_seven_people_fill_quintiles_evenly(spark):
    df = spark.createDataFrame([(f"p{i}", i if i < 6 else None) for i in range(7)], "id string, v int")
    buckets = df.select("id", ntile_columns(df, 5, "id", {"b": SortKey("v")})["b"].alias("b"))
    assert [r["b"] for r in buckets.orderBy("id").collect()] == [1, 1, 2, 2, 3, 4, 5]


def test_rows_ahead_give_percent_rank(people):
    keys = {
        "up": SortKey("value"),
        "down": SortKey("value", descending=True, nulls_first=True),
        "few": SortKey("orders"),
    }
    ranked, count = with_rows_ahead(people, keys)
    assert count == 3001
    got = ranked.select("id", *[(F.col(k) / (count - 1)).alias(k) for k in keys])
    expected = people.select(
        "id",
        *[
            F.percent_rank().over(Window.orderBy(key.on(F.col(key.column)))).alias(name)
            for name, key in keys.items()
        ],
    )
    assert got.exceptAll(expected).count() == 0
    assert got.count() == 3001


def test_numbers_within_groups(spark):
    # One group holds a third of the rows.
    data = [("hot" if i % 3 == 0 else f"g{i % 40}", (i * 7919) % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, a int, b int").repartition(6)
    numbered = number_within(df, "g", ["a", "b"], "n")
    expected = df.withColumn(
        "n", F.row_number().over(Window.partitionBy("g").orderBy("a", "b")).cast("bigint")
    )
    assert numbered.exceptAll(expected).count() == 0
    assert numbered.count() == 3000


def test_small_groups_are_numbered_where_they_lie(spark):
    """As by global position, but without a further exchange after a join by group."""
    left = spark.createDataFrame(
        [(i % 7 if i % 11 else None, -i) for i in range(60)], "g bigint, a bigint"
    )
    order = ["a"]
    both = [f(left, "g", order, "n") for f in (number_within, number_small_groups)]
    assert both[0].dtypes == both[1].dtypes
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))
    keys = spark.range(7).withColumnRenamed("id", "k")
    joined = left.hint("merge").join(keys, left["g"] == keys["k"])
    plan = number_small_groups(joined, "g", order, "n")._jdf.queryExecution().toString()
    plan = plan[plan.index("== Physical Plan ==") :]
    assert "Window" in plan and plan.count("Exchange hashpartitioning(g") == 1


def brute_force_pairs(links, at_least, limit):
    owners = defaultdict(set)
    for owner, item in links:
        owners[owner].add(item)
    counts = [
        (a, b, len(owners[a] & owners[b]))
        for a, b in combinations(sorted(owners), 2)
        if len(owners[a] & owners[b]) >= at_least
    ]
    return sorted(counts, key=lambda p: (-p[2], p[0], p[1]))[:limit]


@pytest.mark.parametrize(("at_least", "limit"), [(5, 15), (1, 200), (2, 7)])
def test_pairs_match_brute_force(spark, at_least, limit):
    rng = random.Random(at_least)
    owners = [f"s{i:03d}" for i in range(90)]
    links = {(o, f"c{rng.randrange(120)}") for o in owners for _ in range(rng.randrange(1, 30))}
    # A few items everyone holds.
    links |= {(o, item) for o in owners[:80] for item in ("all1", "all2", "all3")}
    df = spark.createDataFrame(sorted(links), "seller string, person string").repartition(4)
    got = top_shared_pairs(df, "seller", "person", at_least=at_least, limit=limit)
    assert [tuple(r) for r in got.collect()] == brute_force_pairs(links, at_least, limit)


def test_pairs_only_through_items_everyone_holds(spark):
    links = [(f"s{i:02d}", f"c{j}") for i in range(20) for j in range(6)]
    df = spark.createDataFrame(links, "seller string, person string")
    got = top_shared_pairs(df, "seller", "person", at_least=5, limit=15)
    assert [tuple(r) for r in got.collect()] == brute_force_pairs(links, 5, 15)
    none = top_shared_pairs(df, "seller", "person", at_least=7, limit=15)
    assert none.collect() == []


def everyone_holds(people, sellers, extra, seed):
    """``people`` held by all sellers, and ``extra`` others held by a few."""
    rng = random.Random(seed)
    links = {(f"s{i:03d}", f"all{j:03d}") for i in range(sellers) for j in range(people)}
    links |= {(f"s{rng.randrange(sellers):03d}", f"c{rng.randrange(extra)}") for _ in range(8 * extra)}
    return links


def test_people_held_by_all_sellers_are_not_expanded(spark):
    links = everyone_holds(600, 60, 400, 1)
    df = spark.createDataFrame(sorted(links), "seller string, person string").repartition(4)
    got = top_shared_pairs(df, "seller", "person", at_least=5, limit=15)
    expected = brute_force_pairs(links, 5, 15)
    assert [tuple(r) for r in got.collect()] == expected
    assert expected[-1][2] > 600


def test_rows_of_the_pair_join(spark):
    """600 widely held items would make 600 x 1,770 rows; the rare ones make a few."""
    links = everyone_holds(600, 60, 400, 1)
    holders = Counter(item for _, item in links)
    per_owner = defaultdict(list)
    for owner, item in links:
        per_owner[owner].append(item)
    data = [
        (int(owner[1:]), item, n)
        for owner, items in per_owner.items()
        for n, item in enumerate(sorted(items, key=lambda x: (-holders[x], x)))
    ]
    ranked = spark.createDataFrame(data, "_no long, person string, _from_end long")
    left_out, tried = items_left_out(ranked, "person", 610)
    rows = dict(tried)
    assert rows[0] >= 600 * 60 * 59 // 2
    assert left_out >= 600 and rows[left_out] < rows[0] / 20
    assert rows[left_out] * 4 <= rows[609] * 5
    # where no item is wide, nothing is left out and found counts are whole
    flat = spark.createDataFrame(
        [(o, f"c{o % 50}-{k}", k) for o in range(200) for k in range(100)],
        "_no long, person string, _from_end long",
    )
    assert items_left_out(flat, "person", 3)[0] == 0


@pytest.mark.parametrize("seed", range(3))
def test_left_out_items_are_counted_for_either_owner(spark, seed):
    rng = random.Random(seed)
    links = [
        (o, f"c{int(rng.paretovariate(0.7)) % 90}") for o in range(40) for _ in range(rng.randrange(5, 60))
    ]
    links = sorted(set(links))
    holders = Counter(item for _, item in links)
    df = spark.createDataFrame(
        [(o, i, holders[i]) for o, i in links if holders[i] > 1], "_no long, person string, _holders long"
    )
    for bound in (2, 6, 11):
        got = {
            (r["first"], r["second"]): r["shared"]
            for r in _met_by_rare_items(df, "person", bound).filter(F.col("shared") >= bound).collect()
        }
        named = [(f"{o:03d}", i) for o, i in links]
        expected = brute_force_pairs(named, bound, 10**6)
        assert got == {(int(a), int(b)): n for a, b, n in expected}


@pytest.mark.parametrize(("listed", "wide_rows"), [(1_000, 100_000), (1_000, 12), (8, 100_000), (8, 12)])
def test_pairs_of_lists_of_wide_items_and_of_frequent_owners(spark, listed, wide_rows):
    rng = random.Random(3)
    links = {(o, f"c{rng.randrange(60)}") for o in range(40) for _ in range(rng.randrange(1, 25))}
    links |= {(o, "all") for o in range(40)}
    holders = Counter(item for _, item in links)
    df = spark.createDataFrame(
        sorted((o, i, holders[i]) for o, i in links), "_no long, person string, _holders long"
    )
    counted = _pair_counts(df, "person", listed=listed, wide_rows=wide_rows)
    got = sorted((f"{a:03d}", f"{b:03d}", n) for a, b, n in (tuple(r) for r in counted.collect()))
    assert got == sorted(brute_force_pairs([(f"{o:03d}", i) for o, i in links], 1, 10**6))


def test_pairs_are_summed_up_where_the_lists_of_their_first_owner_lie(spark):
    """No row of a single pair is shuffled: only links by item and lists by first owner."""
    df = spark.createDataFrame(
        [(o, f"c{o % 7}", 9) for o in range(60)], "_no long, person string, _holders long"
    )
    plan = _pair_counts(df, "person")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 2 and "second" not in "".join(exchanges)


def test_three_sellers_of_one_person_make_three_pairs(spark):
    df = spark.createDataFrame([(s, "p") for s in "cab"], "seller string, person string")
    got = top_shared_pairs(df, "seller", "person", at_least=1, limit=15).collect()
    assert [tuple(r) for r in got] == [("a", "b", 1), ("a", "c", 1), ("b", "c", 1)]


def test_modes_break_ties_low_and_skip_null(spark):
    df = spark.createDataFrame(
        [("k", "b", 1), ("k", "a", 2), ("k", None, 4), ("k", None, 8), ("n", None, 16)],
        "k string, v string, x int",
    )
    got = aggregate_with_modes(
        df,
        "k",
        F.array(ballot("v", F.col("v"), F.lit(1)), ballot("w", F.col("v"), F.col("x"))),
        ("v", "w"),
        {"total": F.col("x"), "rows": F.lit(1)},
    )
    assert {tuple(r) for r in got.collect()} == {
        ("k", "a", "a", 15, 4),
        ("n", None, None, 16, 1),
    }


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert tuple(key_report("t", df, ("a", "b")).first()) == ("t", "a, b", 5, 2, 1)
    with pytest.raises(KeyViolation):
        require_key("t", df, ("a", "b"), allow_null=True)
    nulls = df.filter("a is null")
    require_key("t", nulls, ("a",), allow_null=True)
    with pytest.raises(KeyViolation):
        require_key("t", nulls, ("a",), allow_null=False)
