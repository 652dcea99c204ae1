from datetime import date, datetime
from decimal import Decimal

import pytest

from bazaarlens.plans import intermediate, seller_history, staging

D = Decimal


@pytest.fixture(scope="module")
def shop(raw):
    """A small shop with one order per delivery case."""

    def order(number, customer, bought, delivered=None, status="delivered"):
        return {
            "order_id": f"o{number}",
            "customer_id": f"c{number}" if customer else None,
            "order_status": status,
            "order_purchase_timestamp": bought,
            "order_delivered_customer_date": delivered,
            "order_estimated_delivery_date": "2018-01-20 00:00:00",
        }

    def item(order, number, product, seller, price, freight="1.00"):
        return {
            "order_id": order,
            "order_item_id": str(number),
            "product_id": product,
            "seller_id": seller,
            "price": price,
            "freight_value": freight,
        }

    def payment(order, number, kind, value="5.00"):
        return {
            "order_id": order,
            "payment_sequential": str(number),
            "payment_type": kind,
            "payment_installments": str(number),
            "payment_value": value,
        }

    return {
        "orders": staging.orders(
            raw(
                "orders",
                order(1, "u1", "2018-01-01 00:00:00", "2018-01-20 00:00:00"),
                order(2, "u1", "2018-01-02 06:00:00", "2018-01-20 00:00:01"),
                order(3, "u2", "2018-01-03 00:00:00", None, "shipped"),
                order(4, None, "2018-01-04 00:00:00", "2018-01-05 12:00:00", "canceled"),
            )
        ),
        "customers": staging.customers(
            raw(
                "customers",
                {"customer_id": "c1", "customer_unique_id": "u1", "customer_state": "sp"},
                {"customer_id": "c2", "customer_unique_id": "u1", "customer_state": "rj"},
                {"customer_id": "c3", "customer_unique_id": "u2", "customer_state": "mg"},
            )
        ),
        "items": staging.order_items(
            raw(
                "order_items",
                item("o1", 1, "p1", "s1", "10.00"),
                item("o1", 2, "p1", "s1", "20.00"),
                item("o2", 1, "p2", "s1", "30.00"),
                item("o4", 1, "p1", "s2", "0.01"),
            )
        ),
        "payments": staging.order_payments(
            raw(
                "order_payments",
                payment("o1", 1, "voucher"),
                payment("o1", 2, "credit_card"),
                payment("o1", 3, "voucher"),
                payment("o2", 1, "credit_card"),
                payment("o2", 2, "credit_card"),
            )
        ),
        "reviews": staging.order_reviews(
            raw(
                "order_reviews",
                {"order_id": "o1", "review_id": "r1", "review_score": "4"},
                {"order_id": "o2", "review_id": "r2", "review_score": "1"},
            )
        ),
        "sellers": staging.sellers(
            raw("sellers", *[{"seller_id": f"s{i}", "seller_state": "sp"} for i in (1, 2, 3)])
        ),
        "products": staging.products(
            raw("products", {"product_id": "p1"}, {"product_id": "p2"}, {"product_id": "p3"}),
            raw("category_translation"),
        ),
    }


@pytest.fixture(scope="module")
def enriched(shop):
    names = ("orders", "customers", "items", "payments", "reviews")
    return intermediate.orders_enriched(*[shop[n] for n in names])


def test_enriched_orders(enriched, rows):
    got = {r[0]: r[1:] for r in rows(enriched.orderBy("order_id"), *[
        "order_id", "customer_unique_id", "delivery_status", "total_items", "total_products",
        "total_order_value", "payment_methods", "max_installments", "review_score",
        "delivery_days", "order_day_of_week", "order_date",
    ])}
    assert got["o1"] == ("u1", "on_time", 2, 1, D("32.00"), "credit_card, voucher", 3, 4, 19.0,
                         "Monday   ", date(2018, 1, 1))
    assert got["o2"][1] == "late"
    # Nothing bought, paid or reviewed: NULL, and the row stays.
    assert got["o3"][:9] == ("u2", "not_delivered", None, None, None, None, None, None, None)
    # The delivery status ignores the order status; the customer may be unknown.
    assert got["o4"][:2] == (None, "on_time")


def test_seller_metrics(shop, enriched, rows):
    got = intermediate.seller_performance(shop["sellers"], shop["items"], enriched)
    by_id = {r["seller_id"]: r.asDict() for r in got.collect()}
    s1 = by_id["s1"]
    assert (s1["total_orders"], s1["total_items_sold"], s1["unique_products_sold"]) == (2, 3, 2)
    assert (s1["total_revenue"], s1["avg_item_price"]) == (D("60.00"), D("20.0000000000000000"))
    # Weighted by item: (4 + 4 + 1) / 3, and (19 + 19 + 17.75) / 3 days.
    assert (s1["avg_review_score"], s1["avg_delivery_days"]) == (D("3.00"), D("18.6"))
    assert s1["active_days"] == 1.25
    # Without items: one sold item, no orders, no amounts.
    s3 = by_id["s3"]
    assert (s3["total_orders"], s3["total_items_sold"], s3["unique_products_sold"]) == (0, 1, 0)
    assert s3["total_revenue"] is None and s3["active_days"] is None


def test_product_metrics(shop, enriched, rows):
    got = intermediate.product_performance(shop["products"], shop["items"], enriched)
    assert sorted(rows(got, "product_id", "times_ordered", "total_revenue", "avg_review_score")) == [
        ("p1", 2, D("30.01"), D("4.00")),
        ("p2", 1, D("30.00"), D("1.00")),
        ("p3", 0, None, None),
    ]


def test_payments_weigh_a_persons_orders(shop, enriched):
    got = {
        r["customer_unique_id"]: r
        for r in intermediate.customer_history(enriched, shop["payments"]).collect()
    }
    # The order without a customer belongs to nobody.
    assert set(got) == {"u1", "u2"}
    u1 = got["u1"]
    assert u1["lifetime_orders"] == 2 and u1["is_repeat_customer"]
    assert u1["lifetime_value"] == 3 * D("32.00") + 2 * D("31.00")
    assert u1["avg_order_value"] == D("31.6000000000000000")
    assert u1["avg_review_score"] == D("2.80")  # (3 x 4 + 2 x 1) / 5
    assert u1["preferred_payment_method"] == "credit_card"  # 3 against 2
    assert u1["primary_state"] == "SP"  # 3 payments against 2
    assert u1["last_order_date"] == datetime(2018, 1, 2, 6)
    u2 = got["u2"]
    assert u2["lifetime_orders"] == 1 and u2["lifetime_value"] is None
    assert u2["preferred_payment_method"] is None and u2["primary_state"] == "MG"


def test_tied_payment_types(raw, shop, enriched):
    tied = raw(
        "order_payments",
        {"order_id": "o3", "payment_sequential": "1", "payment_type": "voucher"},
        {"order_id": "o3", "payment_sequential": "2", "payment_type": "boleto"},
    )
    got = intermediate.customer_history(enriched, staging.order_payments(tied))
    row = got.filter("customer_unique_id = 'u2'").first()
    assert row["preferred_payment_method"] == "boleto"


def history(raw, months, sales, sellers):
    """Orders in ``months``; ``sales`` are (seller, month) items."""
    orders = [
        {"order_id": m, "order_purchase_timestamp": None if m == "none" else f"{m}-15 08:00:00"}
        for m in months
    ]
    items = [
        {"order_id": m, "order_item_id": str(n), "seller_id": s} for n, (s, m) in enumerate(sales)
    ]
    return seller_history.seller_status_history(
        staging.sellers(raw("sellers", *[{"seller_id": s} for s in sellers])),
        staging.order_items(raw("order_items", *items)),
        staging.orders(raw("orders", *orders)),
    )


OPEN = date(9999, 12, 31)


def test_status_ranges(raw, rows):
    # No orders at all in 2018-05: that month does not exist.
    months = ["2018-01", "2018-02", "2018-03", "2018-04", "2018-06"]
    sales = [
        ("a", "2018-01"), ("a", "2018-02"), ("a", "2018-04"), ("a", "2018-04"), ("a", "2018-06"),
        ("b", "2018-03"),
    ]
    got = history(raw, months, sales, ["a", "b", "c"])
    assert sorted(rows(got, "scd_id", "seller_id", "seller_status", "valid_from", "valid_to",
                       "is_current", "orders_at_change")) == [
        (1, "a", "active", date(2018, 1, 1), date(2018, 2, 28), False, 1),
        (2, "a", "inactive", date(2018, 3, 1), date(2018, 3, 31), False, 0),
        # Two items of one order count twice.
        (3, "a", "active", date(2018, 4, 1), OPEN, True, 2),
        (4, "b", "inactive", date(2018, 1, 1), date(2018, 2, 28), False, 0),
        (5, "b", "active", date(2018, 3, 1), date(2018, 3, 31), False, 1),
        (6, "b", "inactive", date(2018, 4, 1), OPEN, True, 0),
        (7, "c", "inactive", date(2018, 1, 1), OPEN, True, 0),
    ]


def test_orders_without_a_date_form_a_last_month(raw, rows):
    got = history(raw, ["2018-01", "none"], [("a", "2018-01"), ("b", "none")], ["a", "b"])
    assert sorted(rows(got, "scd_id", "seller_id", "seller_status", "valid_from", "valid_to",
                       "is_current")) == [
        (1, "a", "active", date(2018, 1, 1), OPEN, True),
        (2, "a", "inactive", None, OPEN, True),
        (3, "b", "inactive", date(2018, 1, 1), OPEN, True),
    ]
