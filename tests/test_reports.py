from datetime import date, datetime, timedelta
from decimal import Decimal

from bazaarlens.plans import analytics, examples

D = Decimal


def test_growth_needs_a_positive_previous_month(spark, rows):
    months = spark.createDataFrame(
        [(date(2018, m, 1), None if v is None else D(v), 1)
         for m, v in [(1, "0.00"), (2, "80.00"), (3, "100.00"), (4, "33.00"), (5, None), (6, "1.00")]],
        "month_start date, gmv decimal(20,2), total_orders bigint",
    )
    assert rows(analytics.mom_growth(months), "mom_growth_pct") == [
        (None,), (None,), (D("25.0"),), (D("-67.0"),), (None,), (None,)
    ]
    running = rows(analytics.cumulative_gmv(months), "cumulative_gmv", "cumulative_orders")
    assert running[0] == (D("0.00"), 1)
    assert running[-1] == (D("214.00"), 6)


def test_category_ranks_share_ties(spark, rows):
    categories = spark.createDataFrame(
        [(f"c{i:02d}", D(v)) for i, v in enumerate([5, 9, 9, 1, 1, 1, 1, 1, 1, 1, 1, 1])],
        "product_category string, total_revenue decimal(20,2)",
    ).selectExpr("*", "1L as total_orders", "1 as avg_price", "1 as avg_review_score")
    got = rows(analytics.top_categories(categories), "revenue_rank", "product_category")
    assert got[:4] == [(1, "c01"), (1, "c02"), (3, "c00"), (4, "c03")]
    assert len(got) == 10 and got[-1] == (4, "c09")


def test_equal_states_share_the_cumulative_value(spark, rows):
    states = spark.createDataFrame(
        [("A", D("50.00")), ("B", D("20.00")), ("C", D("20.00")), ("D", D("10.00"))],
        "customer_state string, total_revenue decimal(20,2)",
    )
    got = dict(rows(analytics.state_pareto(states), "customer_state", "cumulative_pct"))
    assert got == {"A": D("50.0"), "B": D("90.0"), "C": D("90.0"), "D": D("100.0")}


SCORES = """seller_state string, seller_id string, seller_city string, total_orders bigint,
 total_revenue decimal(20,2), avg_review_score decimal(22,2)"""


def test_state_leaders_and_outperformers(spark, rows):
    data = [("SP", s, "X", 1, None if v is None else D(v), None)
            for s, v in [("a", 10), ("b", 10), ("c", 100), ("d", 5), ("e", None)]]
    scores = spark.createDataFrame([*data, ("RJ", "z", "X", 1, D(7), None)], SCORES)
    assert rows(analytics.top_sellers_per_state(scores), "seller_state", "seller_id",
                "rank_in_state") == [
        ("RJ", "z", 1), ("SP", "e", 1), ("SP", "c", 2), ("SP", "a", 3)
    ]
    # Mean of the four known revenues is 31.25; only 100 exceeds its double.
    assert rows(analytics.sellers_above_state_average(scores), "seller_id", "state_avg_revenue",
                "times_above_avg") == [("c", D("31.25"), D("3.2"))]


ENRICHED = """order_id string, customer_unique_id string, customer_state string, order_status string,
 order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz,
 order_date date, total_order_value decimal(21,2), review_score int, delivery_status string"""


def orders(spark, *data, **fixed):
    built = []
    for i, (person, bought) in enumerate(data):
        built.append((f"o{i:03d}", person, fixed.get("state", "SP"), fixed.get("status", "delivered"),
                      bought, bought and bought + timedelta(days=1), bought and bought.date(),
                      D("10.00"), 5, "on_time"))
    return spark.createDataFrame(built, ENRICHED)


def test_gaps_between_orders(spark, rows):
    t = datetime(2018, 1, 1)
    visits = [("u1", t), ("u1", t + timedelta(hours=36)), ("u0", t), ("u2", t), ("u2", t)]
    visits += [("u3", t + timedelta(days=n)) for n in range(50)]
    enriched = orders(spark, *visits)
    history = spark.createDataFrame(
        [("u0", False), ("u1", True), ("u2", True), ("u3", True)],
        "customer_unique_id string, is_repeat_customer boolean",
    )
    got = rows(analytics.repeat_order_gap(enriched, history))
    assert len(got) == 30
    assert got[0] == ("u1", "o000", t, None, t + timedelta(hours=36), None)
    assert got[1][3:] == (t, None, 1.5)
    assert got[2][1:] == ("o003", t, None, t, None)  # equal times go by order id
    # The last row still sees its successor.
    assert got[-1][4] == got[-1][2] + timedelta(days=1)
    short = analytics.repeat_order_gap(enriched, history, limit=3)
    assert rows(short) == got[:3]


def test_payment_shares(spark, rows):
    dated = orders(spark, ("u", datetime(2018, 3, 31, 23)), ("u", datetime(2018, 4, 1)))
    payments = spark.createDataFrame(
        [("o000", k) for k in ("boleto", "voucher", "cash")] + [("o001", "boleto"), ("gone", "x")],
        "order_id string, payment_type string",
    )
    assert rows(analytics.payment_trends(payments, dated)) == [
        (date(2018, 1, 1), 3, D("0.0"), D("33.3"), D("33.3"), D("0.0")),
        (date(2018, 4, 1), 1, D("0.0"), D("100.0"), D("0.0"), D("0.0")),
    ]


def test_weekdays(spark, rows):
    enriched = orders(spark, ("u", datetime(2018, 5, 20, 1)), ("u", datetime(2018, 5, 26)))
    assert rows(analytics.delivery_by_weekday(enriched)) == [
        ("Sunday", 0, 1, D("1.0"), D("0.0")),
        ("Saturday", 6, 1, D("1.0"), D("0.0")),
    ]


def test_cohorts_and_new_customers(spark, rows):
    enriched = orders(
        spark,
        ("u1", datetime(2017, 12, 31)), ("u1", datetime(2018, 1, 1)), ("u1", datetime(2018, 1, 9)),
        ("u2", datetime(2017, 12, 1)), ("u2", datetime(2018, 12, 1)),
        ("u3", datetime(2018, 1, 5)), (None, datetime(2018, 1, 5)),
    )
    assert rows(analytics.cohort_retention(enriched)) == [
        (date(2017, 12, 1), 2, 1, 0, 0, 0, 1),
        (date(2018, 1, 1), 1, 0, 0, 0, 0, 0),
    ]
    assert rows(analytics.new_vs_returning(enriched)) == [
        (date(2017, 12, 1), 2, 2, 0, D("100.0"), D("0.0")),
        (date(2018, 1, 1), 2, 1, 1, D("50.0"), D("50.0")),
        (date(2018, 12, 1), 1, 0, 1, D("0.0"), D("100.0")),
    ]


def test_days_with_gaps(spark, rows):
    days = [0, 0, 1, 2, 3, 4, 5, 6, 200]
    start = datetime(2018, 1, 1, 9)
    enriched = orders(spark, *[("u", start + timedelta(days=d)) for d in days]).unionByName(
        orders(spark, ("u", start + timedelta(days=210)), status="shipped")
    )
    average = rows(analytics.moving_average(enriched), "order_date", "orders", "orders_7day_avg",
                   "revenue_7day_avg")
    assert average[0] == (date(2018, 1, 1), 2, D("2.0"), D("20.00"))
    assert average[6] == (date(2018, 1, 7), 1, D("1.1"), D("11.43"))
    # Seven rows, not seven days.
    assert average[7] == (date(2018, 7, 20), 1, D("1.0"), D("10.00"))
    calendar = rows(analytics.calendar_fill(enriched))
    assert len(calendar) == 211
    assert calendar[0] == (date(2018, 1, 1), 2, D("20.00"), 1)
    assert calendar[7] == (date(2018, 1, 8), 0, D("0.00"), 1)
    assert calendar[-1] == (date(2018, 7, 30), 0, D("0.00"), 1)


def test_calendar_of_nothing_is_one_unknown_day(spark, rows):
    assert rows(analytics.calendar_fill(orders(spark, status="x")), "cal_date", "orders") == [
        (None, 0)
    ]


def test_reviews_need_more_than_the_minimum(spark, rows):
    enriched = orders(spark, *[("u", datetime(2018, 1, 1))] * 100)
    assert rows(analytics.reviews_by_delivery(enriched)) == []
    assert rows(analytics.reviews_by_delivery(enriched, more_than=99)) == [
        ("on_time", 100, D("5.00"), 100, 0, D("0.0"), D("100.0"))
    ]


def sales(spark):
    enriched = orders(spark, ("u1", datetime(2018, 1, 1)), ("u2", datetime(2018, 1, 1)))
    other = orders(spark, ("u3", datetime(2018, 1, 1)), state="RJ").replace("o000", "o900", "order_id")
    items = spark.createDataFrame(
        [("o000", "pb", "s", D("10.00"), D("1.00")), ("o000", "ph", "s", D("5.00"), D("1.00")),
         ("o001", "pb", "t", D("1.00"), D("1.00")), ("o900", "pb", "t", D("2.00"), D("0.50")),
         ("o900", "px", "t", D("0.00"), D("9.00"))],
        "order_id string, product_id string, seller_id string, price decimal(10,2), "
        "freight_value decimal(10,2)",
    )
    products = spark.createDataFrame(
        [("pb", "bed_bath_table", D("100.5000")), ("ph", "health_beauty", None), ("px", "other", D(1))],
        "product_id string, product_category string, product_weight_g decimal(18,4)",
    )
    return items, products, enriched.unionByName(other)


def test_rollup_and_cube(spark, rows):
    lines = sales(spark)
    states, categories = "** ALL STATES **", "** ALL CATEGORIES **"
    assert rows(analytics.rollup_state_category(*lines)) == [
        ("RJ", "bed_bath_table", 1, D("2.00"), 0, 0),
        ("RJ", categories, 1, D("2.00"), 0, 1),
        ("SP", "bed_bath_table", 2, D("11.00"), 0, 0),
        ("SP", "health_beauty", 1, D("5.00"), 0, 0),
        # One order holds both categories, so orders do not add up.
        ("SP", categories, 2, D("16.00"), 0, 1),
        (states, categories, 3, D("18.00"), 1, 1),
    ]
    cube = rows(analytics.cube_state_category(*lines))
    assert ("** ALL **", "bed_bath_table", 3, D("13.00")) in cube
    assert len(cube) == 8


def test_freight_ratio_skips_free_items(spark, rows):
    items, products, _ = sales(spark)
    got = rows(analytics.freight_ratio(items, products, min_items=1, above="0.1"))
    # (0.1 + 1 + 0.25) / 3; the item with price zero has no ratio at all.
    assert got == [
        ("bed_bath_table", 3, D("4.33"), D("0.83"), D("45.0"), D("101")),
        ("health_beauty", 1, D("5.00"), D("1.00"), D("20.0"), None),
    ]
    assert rows(analytics.freight_ratio(items, products, min_items=4, above="0.1")) == []


def test_shared_customers(spark, rows):
    items, _, enriched = sales(spark)
    assert rows(analytics.shared_customer_pairs(items, enriched, at_least=1)) == []
    again = enriched.replace("u2", "u1", "customer_unique_id")
    assert rows(analytics.shared_customer_pairs(items, again, at_least=1)) == [("s", "t", 1)]


def test_lookups(spark, rows):
    enriched = orders(spark, ("u", datetime(2018, 3, 31)), ("u", datetime(2018, 3, 31, 12)),
                      ("u", datetime(2018, 6, 1))).selectExpr(
        "*", "'c' as customer_id", "year(order_date) as order_year",
        "month(order_date) as order_month",
    )
    # The upper bound is the midnight at the start of the day.
    assert rows(examples.orders_in_range(enriched), "order_id") == [("o000",)]
    assert rows(examples.count_by_status(enriched)) == [(0,)]
    assert rows(examples.count_by_status(enriched, status="delivered")) == [(3,)]
    assert rows(examples.state_on_time_value(enriched)) == [("SP", 3, D("10.00"))]
    items, products, _ = sales(spark)
    numbered = items.selectExpr("*", "1 as order_item_id")
    assert rows(examples.delivered_items_since(enriched, numbered, products, since="2018-03-31")) != []
    assert rows(examples.delivered_items_since(enriched, numbered, products)) == []
