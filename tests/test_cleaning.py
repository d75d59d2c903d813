from datetime import date
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyloom.operators import cleaning
from tallyloom.operators.ordinals import with_ordinal
from tallyloom.operators.enrichment import enrich_orders, enrich_products


def order(order_id="O1", quantity=1, price=10.0, status="completed", discount=0.0, day="2024-01-01",
          customer="K17", product="A10"):
    return (order_id, customer, product, quantity, price, discount, day, status)


def test_cancelled_duplicate_and_non_positive_orders_go(frame):
    df = frame("orders", [
        order("O1"), order("O1", quantity=9), order("O2", status="cancelled"),
        order("O3", quantity=0), order("O4", price=-1.0), order("O5", quantity=None),
    ])
    assert rows_of(cleaning.clean_orders(df), "order_id", "quantity") == [("O1", 1)]


def test_first_copy_cancelled_removes_the_order(frame):
    df = frame("orders", [order("O1", status="cancelled"), order("O1")])
    assert cleaning.clean_orders(df).count() == 0


def test_null_status_is_kept_and_null_ids_count_as_one(frame):
    df = frame("orders", [order("O1", status=None), order(None), order(None, quantity=2)])
    assert rows_of(cleaning.clean_orders(df), "order_id", "quantity") == [("O1", 1), (None, 1)]


def test_column_names_are_normalised(frame):
    df = frame("orders", [order()])
    df = df.toDF(*[f" {c.upper()} " for c in df.columns])
    got = cleaning.clean_orders(df)
    assert "order_id" in got.columns and got.first().order_date == date(2024, 1, 1)


def test_nan_quantity_is_not_positive(spark, frame):
    df = frame("orders", [order()]).withColumn("quantity", F.lit(float("nan")))
    assert cleaning.clean_orders(df).count() == 0


def test_bad_dates(frame):
    df = frame("orders", [order(day="soon")])
    with pytest.raises(Exception, match="(?i)date|cast|parse"):
        cleaning.clean_orders(df).collect()
    assert cleaning.clean_orders(df, bad_dates="null").first().order_date is None


def test_customers(frame):
    df = frame("customers", [
        ("C1", "\t Ida Brandt \n", " IDA@Shop.Example ", "r", "c", "B2C", "2024-01-15"),
        ("C1", "Other", "o", "r", "c", "B2C", "2024-01-16"),
    ])
    row = cleaning.clean_customers(df).collect()
    assert [(r.name, r.email, r.signup_date) for r in row] == [
        ("Ida Brandt", "ida@shop.example", date(2024, 1, 15))
    ]


@pytest.mark.parametrize(
    ("name", "clean"),
    [
        ("products", cleaning.clean_products),
        ("suppliers", cleaning.clean_suppliers),
        ("returns", cleaning.clean_returns),
    ],
)
def test_other_sources_drop_repeated_ids(frame, sources, name, clean):
    once = sources[name]
    assert clean(once.union(once)).count() == once.count()


def test_shipping_keeps_all_events(frame, sources):
    twice = sources["shipping"].union(sources["shipping"])
    assert cleaning.clean_shipping(twice).count() == 10


def enriched(sources, frame, orders=None, returns=None, shipping=None):
    return enrich_orders(
        cleaning.clean_orders(frame("orders", orders)),
        cleaning.clean_returns(frame("returns", returns)),
        cleaning.clean_shipping(frame("shipping", shipping)),
    )


def test_enriched_sample(sources, frame):
    got = rows_of(
        enriched(sources, frame), "order_id", "total_amount", "is_returned", "shipping_cost"
    )
    assert got == [
        ("B-101", Decimal("471.00"), False, Decimal("11.90")),
        ("B-102", Decimal("37.40"), True, Decimal("4.20")),
        ("B-103", Decimal("72.00"), True, Decimal("5.60")),
        ("B-105", Decimal("32.00"), False, Decimal("3.10")),
        ("B-106", Decimal("121.50"), False, Decimal("8.40")),
    ]


def test_last_event_wins_and_absent_events_cost_nothing(sources, frame):
    event = ("x", "2024-01-01", "2024-01-02")
    got = enriched(
        sources,
        frame,
        orders=[order("O1"), order("O2"), order("O3")],
        shipping=[("O1", *event, 4.0), ("O1", *event, 6.0), ("O2", *event, 5.0),
                  ("O2", *event, None)],
    )
    assert rows_of(got, "order_id", "shipping_cost") == [
        ("O1", Decimal("6.00")), ("O2", Decimal("0.00")), ("O3", Decimal("0.00")),
    ]


def test_amount_rounds_once(sources, frame):
    got = enriched(
        sources, frame,
        orders=[order("O1", 1, 0.01, discount=50.0), order("O2", 3, 33.33, discount=12.5),
                order("O3", 1, 10.0, discount=100.0), order("O4", 1, 10.0, discount=None)],
    )
    assert rows_of(got, "order_id", "total_amount") == [
        ("O1", Decimal("0.01")), ("O2", Decimal("87.49")), ("O3", Decimal("0.00")), ("O4", None),
    ]


def test_margin(frame, sources):
    products = enrich_products(cleaning.clean_products(sources["products"]))
    assert rows_of(products, "product_id", "margin_pct") == [
        ("A10", Decimal("54.2")), ("A20", Decimal("60.0")), ("A30", Decimal("62.5")), ("A40", Decimal("37.5")),
    ]
    free = frame("products", [("P", "n", "c", "s", "b", "S", 1.0, 0.0)])
    assert enrich_products(cleaning.clean_products(free)).first().margin_pct is None


def test_orders_are_not_shuffled_again_for_the_lookups(spark, sources):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, returns, shipping = (
            with_ordinal(sources[n]).repartition(3) for n in ("orders", "returns", "shipping")
        )
        plan = enrich_orders(
            cleaning.clean_orders(orders),
            cleaning.clean_returns(returns),
            cleaning.clean_shipping(shipping),
        )._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange for each of orders and shipping by order_id, two for returns
    # (by return_id, then by order_id).
    assert plan.count("Exchange hashpartitioning") == 4
