from datetime import date, datetime, timedelta
from decimal import Decimal

from bazaarlens.plans import marts

D = Decimal

SELLERS = """seller_id string, seller_city string, seller_state string, total_orders bigint,
 total_revenue decimal(20,2), avg_review_score decimal(22,2), avg_delivery_days decimal(21,1)"""


def scorecard(spark, *sellers):
    data = [(s, "X", "SP", n, D(r), None if v is None else D(v), None if d is None else D(d))
            for s, n, r, v, d in sellers]
    return {r["seller_id"]: r for r in marts.seller_scorecard(
        spark.createDataFrame(data, SELLERS)).collect()}


def test_seller_tiers(spark):
    got = scorecard(
        spark,
        ("gold", 50, "1.00", "4.00", "1.0"),
        ("silver", 20, "1.00", "3.50", "1.0"),
        ("bronze", 5, "1.00", "1.00", "1.0"),
        ("new", 4, "1.00", "5.00", "1.0"),
        ("unreviewed", 60, "1.00", None, "1.0"),
        ("idle", 0, "0.00", "5.00", "1.0"),
    )
    assert {k: r["seller_tier"] for k, r in got.items()} == {
        "gold": "gold", "silver": "silver", "bronze": "bronze", "new": "new",
        "unreviewed": "bronze",
    }


def test_seller_percentiles_with_missing_values(spark):
    got = scorecard(
        spark,
        ("a", 1, "10.00", "3.00", "2.0"),
        ("b", 1, "20.00", "3.00", "9.0"),
        ("c", 1, "30.00", "5.00", None),
        ("d", 1, "40.00", None, "2.0"),
    )
    assert [got[s]["revenue_percentile"] for s in "abcd"] == [D("0"), D("0.333"), D("0.667"), D("1")]
    # Equal reviews share a rank; a missing one is the highest.
    assert [got[s]["review_percentile"] for s in "abcd"] == [D("0"), D("0"), D("0.667"), D("1")]
    # Missing delivery days come first in the descending order.
    assert [got[s]["delivery_speed_percentile"] for s in "abcd"] == [
        D("0.667"), D("0.333"), D("0"), D("0.667")
    ]
    alone = scorecard(spark, ("a", 1, "10.00", "3.00", "2.0"))
    assert alone["a"]["revenue_percentile"] == 0


HISTORY = """customer_unique_id string, lifetime_orders bigint, lifetime_value decimal(24,2),
 avg_order_value decimal(38,16), avg_review_score decimal(22,2), first_order_date timestamp_ntz,
 last_order_date timestamp_ntz, is_repeat_customer boolean, preferred_payment_method string,
 primary_state string"""


def test_segments(spark):
    end = datetime(2018, 9, 1)
    data = []
    # Ten people; recency rises with the number, the other two are chosen freely.
    for i, (orders, value) in enumerate(
        [(1, 1), (2, 9), (9, 8), (1, 2), (4, 7), (8, 10), (2, 3), (2, 20), (7, 4), (9, None)]
    ):
        last = end - timedelta(days=9 - i, hours=12 if i == 0 else 0)
        data.append((f"p{i}", orders, None if value is None else D(value), D("1.005"), None, last,
                     last, orders > 1, None, None))
    orders = spark.createDataFrame([(end,), (datetime(2018, 1, 1),)],
                                   "order_purchase_timestamp timestamp_ntz")
    got = {r["customer_unique_id"]: r for r in marts.customer_segments(
        spark.createDataFrame(data, HISTORY), orders).collect()}
    quintiles = {k: (r["recency_quintile"], r["frequency_quintile"], r["monetary_quintile"])
                 for k, r in got.items()}
    assert quintiles["p0"] == (1, 1, 1)
    assert quintiles["p9"] == (5, 5, 5)  # a missing value is the highest
    assert quintiles["p7"] == (4, 3, 5)  # a tie at two orders, split by person id
    assert {k: r["customer_segment"] for k, r in got.items()} == {
        "p0": "at_risk", "p1": "at_risk", "p2": "frequent", "p3": "at_risk", "p4": "regular",
        "p5": "frequent", "p6": "recent", "p7": "loyal", "p8": "loyal", "p9": "champions",
    }
    assert got["p0"]["recency_days"] == 10  # nine and a half days round away from zero
    assert got["p0"]["avg_order_value"] == D("1.01")


ORDERS = """order_id string, customer_unique_id string, customer_state string, order_status string,
 order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz,
 order_year int, order_month int, total_order_value decimal(21,2), total_freight decimal(20,2),
 review_score int, delivery_status string"""


def orders(spark, *data):
    built = []
    for i, (person, state, status, bought, days, value, review, delivery) in enumerate(data):
        done = None if days is None else bought + timedelta(days=days)
        built.append((f"o{i}", person, state, status, bought, done, bought.year, bought.month,
                      None if value is None else D(value), D("1.00"), review, delivery))
    return spark.createDataFrame(built, ORDERS)


def test_month_and_state_views(spark, rows):
    day = datetime(2018, 3, 31, 23)
    enriched = orders(
        spark,
        ("u1", "SP", "delivered", day, 1, "10.00", 5, "on_time"),
        ("u1", "SP", "delivered", day, 2, "10.01", 2, "late"),
        ("u2", "SP", "delivered", day, None, None, None, "not_delivered"),
        ("u3", "RJ", "delivered", datetime(2018, 4, 1), 1, "5.00", 1, "on_time"),
        ("u4", "RJ", "shipped", day, 1, "99.00", 1, "late"),
    )
    assert rows(marts.monthly_revenue(enriched)) == [
        (2018, 3, date(2018, 3, 1), 3, 2, D("20.01"), D("10.01"), D("3.00"), D("3.50"), D("1.5"),
         D("33.3")),
        (2018, 4, date(2018, 4, 1), 1, 1, D("5.00"), D("5.00"), D("1.00"), D("1.00"), D("1.0"),
         D("0.0")),
    ]
    states = rows(marts.state_performance(enriched), "customer_state", "total_orders",
                  "total_revenue", "low_review_pct")
    # Low reviews count against all delivered orders, reviewed or not.
    assert states == [("SP", 3, D("20.01"), D("33.3")), ("RJ", 1, D("5.00"), D("100.0"))]


def test_category_needs_ten_orders(spark, rows):
    day = datetime(2018, 3, 1)
    enriched = orders(spark, *[("u", "SP", "delivered", day, 1, "1.00", 4, "on_time")] * 10,
                      ("u", "SP", "shipped", day, 1, "1.00", 1, "on_time"))
    items = spark.createDataFrame(
        [(f"o{i}", "p10", f"s{i % 3}", D("2.00")) for i in range(11)]
        + [("o0", "p10", "s0", D("4.00"))]
        + [(f"o{i}", "p9", "s0", D("1.00")) for i in range(9)],
        "order_id string, product_id string, seller_id string, price decimal(10,2)",
    )
    products = spark.createDataFrame([("p10", "ten"), ("p9", "nine")],
                                     "product_id string, product_category string")
    got = rows(marts.product_category_analysis(items, products, enriched))
    assert got == [("ten", 10, D("24.00"), D("2.18"), 3, 1, D("4.00"), D("1.0"))]
