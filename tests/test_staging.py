from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from bazaarlens.plans import staging
from bazaarlens.sources.csv_extracts import csv_reader, read_extract, write_extract

D = Decimal


def test_review_choice(raw, rows):
    reviews = raw(
        "order_reviews",
        {"review_id": "old", "order_id": "dates", "review_creation_date": "2018-01-01 00:00:00"},
        {"review_id": "new", "order_id": "dates", "review_creation_date": "2018-01-02 00:00:00"},
        {"review_id": "b", "order_id": "tie", "review_creation_date": "2018-01-01 00:00:00"},
        {"review_id": "a", "order_id": "tie", "review_creation_date": "2018-01-01 00:00:00"},
        {"review_id": "dated", "order_id": "null", "review_creation_date": "2018-01-02 00:00:00"},
        {"review_id": "undated", "order_id": "null", "review_score": "3"},
    )
    got = staging.order_reviews(reviews)
    assert got.columns == reviews.columns
    assert set(rows(got, "order_id", "review_id", "review_score")) == {
        ("dates", "new", None),
        ("tie", "a", None),
        ("null", "undated", 3),
    }


def test_product_categories_and_blank_numbers(raw, rows):
    products = raw(
        "products",
        {"product_id": "1", "product_category_name": "bebes", "product_weight_g": ""},
        {"product_id": "2", "product_category_name": "pc_gamer", "product_weight_g": "100"},
        {"product_id": "3", "product_name_length": "40"},
    )
    names = raw(
        "category_translation",
        {"product_category_name": "bebes", "product_category_name_english": "baby"},
    )
    got = staging.products(products, names)
    wanted = ("product_id", "product_category", "product_weight_g", "product_name_length")
    assert sorted(rows(got, *wanted)) == [
        ("1", "baby", None, None),
        ("2", "pc_gamer", D("100.0000"), None),
        ("3", "unknown", None, 40),
    ]


def test_a_repeated_translation_repeats_the_product(raw):
    products = raw("products", {"product_id": "1", "product_category_name": "x"})
    names = raw(
        "category_translation",
        {"product_category_name": "x", "product_category_name_english": "one"},
        {"product_category_name": "x", "product_category_name_english": "two"},
    )
    assert staging.products(products, names).count() == 2


def test_malformed_text_fails(raw):
    with pytest.raises(PySparkException):
        staging.orders(
            raw("orders", {"order_id": "1", "order_purchase_timestamp": "yesterday"})
        ).collect()
    with pytest.raises(PySparkException):
        staging.order_items(raw("order_items", {"order_id": "1", "price": "1,50"})).collect()


def test_money_and_moments(raw, rows):
    items = raw(
        "order_items",
        {"order_item_id": "1", "price": "10.005", "shipping_limit_date": "2018-01-01 10:00:00"},
        {"order_item_id": "2"},
    )
    got = rows(staging.order_items(items), "order_item_id", "price", "shipping_limit_date")
    assert got == [(1, D("10.01"), datetime(2018, 1, 1, 10)), (2, None, None)]


def test_zip_codes(raw, rows):
    points = raw(
        "geolocation",
        *[
            {
                "geolocation_zip_code_prefix": "01000",
                "geolocation_lat": lat,
                "geolocation_lng": lng,
                "geolocation_city": city,
                "geolocation_state": "sp ",
            }
            for lat, lng, city in [
                ("-23.5", "-46.0000005", "sao paulo"),
                ("-23.6", "-46.0000006", " SAO PAULO "),
                ("-23.7", None, "osasco"),
                (None, None, "osasco"),
            ]
        ],
    )
    # Two cities tie: the alphabetically first wins.
    assert rows(staging.geolocation(points)) == [
        ("01000", D("-23.600000"), D("-46.000001"), "Osasco", "SP")
    ]


def test_csv_dialect(spark, rows, tmp_path):
    (tmp_path / "order_reviews.csv").write_text(
        "any,header,names,are,skipped,by,position\n"
        'r1,o1,5,,"She said ""good""\nand left","2018-01-01 00:00:00",\n'
        'r2,o2,1,"",plain,,\n',
        encoding="utf-8",
    )
    got = rows(csv_reader(spark, str(tmp_path))("order_reviews"))
    assert got == [
        ("r1", "o1", "5", None, 'She said "good"\nand left', "2018-01-01 00:00:00", None),
        ("r2", "o2", "1", "", "plain", None, None),
    ]
    typed = staging.order_reviews(csv_reader(spark, str(tmp_path))("order_reviews"))
    assert typed.filter("review_creation_date is null").count() == 1


def test_short_csv_row_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nx,y\nonly\n")
    with pytest.raises(Exception, match="Malformed"):
        read_extract(spark, "category_translation", str(tmp_path / "t.csv")).count()


def test_csv_round_trip_keeps_empty_and_null(raw, rows, spark, tmp_path):
    products = raw(
        "products",
        {"product_id": "1", "product_weight_g": "", "product_category_name": 'a "b", c'},
        {"product_id": "2"},
    )
    write_extract(products, str(tmp_path / "products.csv"))
    back = csv_reader(spark, str(tmp_path))("products")
    assert sorted(rows(back), key=str) == sorted(rows(products), key=str)
