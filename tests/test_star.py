from datetime import date
from decimal import Decimal

from conftest import rows_of
from pyspark.sql import functions as F

from tallyloom.operators import cleaning, dimensions, facts
from tallyloom.operators.enrichment import enrich_orders, enrich_products
from tallyloom.schemas import STAR


def test_dim_date(spark):
    df = dimensions.build_dim_date(spark, date(2024, 12, 28), date(2025, 1, 5))
    rows = {r.date_key: r for r in df.collect()}
    assert len(rows) == 9
    monday, sunday = rows[20241230], rows[20250105]
    assert (monday.week, monday.day_of_week, monday.day_name, monday.is_weekend) == (
        1, 1, "Monday", False,
    )
    assert (sunday.week, sunday.day_of_week, sunday.is_weekend) == (1, 7, True)
    assert (monday.month_name, monday.quarter, monday.fiscal_quarter) == (
        "December", 4, "FQ4/2024",
    )


def test_dim_date_defaults_and_long_calendars(spark):
    assert dimensions.build_dim_date(spark).count() == 731
    assert dimensions.build_dim_date(spark, date(2024, 1, 2), date(2024, 1, 1)).count() == 0
    long = dimensions.build_dim_date(spark, date(800, 3, 1), date(2800, 2, 28))
    assert long.count() == (date(2800, 2, 28) - date(800, 3, 1)).days + 1
    assert long.agg(F.min("date_key"), F.max("date_key")).first()[:] == (8000301, 28000228)


def test_tables_have_their_declared_columns(star):
    for name, df in star.tables().items():
        assert df.columns == STAR[name].fieldNames()


def test_keys_follow_source_order(star):
    assert rows_of(star.dim_customer, "customer_key", "customer_id") == [
        (1, "K17"), (2, "K23"), (3, "K41"), (4, "K58"),
    ]
    assert rows_of(star.dim_product, "product_key", "product_id", "supplier_key") == [
        (1, "A10", 2), (2, "A20", 1), (3, "A30", 1), (4, "A40", 3),
    ]


def test_fact(star):
    got = rows_of(
        star.fact_sales, "order_key", "order_id", "date_key", "customer_key", "product_key",
        "supplier_key", "profit_margin", "is_returned",
    )
    assert got == [
        (1, "B-101", 20240222, 2, 1, 2, Decimal("50.8"), False),
        (2, "B-102", 20240309, 1, 2, 1, Decimal("40.6"), True),
        (3, "B-103", 20240502, 3, 3, 1, Decimal("50.6"), True),
        (4, "B-105", 20240811, 2, 3, 1, Decimal("52.8"), False),
        (5, "B-106", 20240830, 1, 2, 1, Decimal("48.6"), False),
    ]


def build(sources, frame, orders, products=None):
    dim_supplier = dimensions.build_dim_supplier(cleaning.clean_suppliers(sources["suppliers"]))
    dim_product = dimensions.build_dim_product(
        enrich_products(cleaning.clean_products(frame("products", products))), dim_supplier
    )
    enriched = enrich_orders(
        cleaning.clean_orders(frame("orders", orders)),
        cleaning.clean_returns(sources["returns"]),
        cleaning.clean_shipping(sources["shipping"]),
    )
    dim_customer = dimensions.build_dim_customer(cleaning.clean_customers(sources["customers"]))
    return dim_product, facts.build_fact_sales(enriched, dim_customer, dim_product)


def test_unknown_members_get_key_zero(sources, frame):
    dim_product, fact = build(
        sources, frame,
        [("O1", "C9", "P9", 1, 10.0, 0.0, "2024-01-01", "completed"),
         ("O2", "K17", "P8", 1, 10.0, 0.0, "2024-01-01", "completed")],
        [("P8", "n", "c", "s", "b", "L99", 4.0, 8.0)],
    )
    assert dim_product.first().supplier_key == 0
    assert rows_of(fact, "customer_key", "product_key", "supplier_key", "profit_margin") == [
        (0, 0, 0, Decimal("100.0")), (1, 1, 0, Decimal("60.0")),
    ]


def test_zero_amount_has_zero_margin(sources, frame):
    _, fact = build(
        sources, frame, [("O1", "K17", "A10", 1, 10.0, 100.0, "2024-01-01", "completed")]
    )
    assert fact.first().profit_margin == Decimal("0.0")


def test_known_members_keep_their_keys(frame):
    first = dimensions.build_dim_supplier(
        cleaning.clean_suppliers(frame("suppliers", [("B", "b", "DE", 1, 1.0),
                                                     ("A", "a", "DE", 1, 1.0)]))
    )
    later = dimensions.build_dim_supplier(
        cleaning.clean_suppliers(frame("suppliers", [("D", "d", "DE", 1, 1.0),
                                                     ("A", "changed", "DE", 1, 1.0),
                                                     ("C", "c", "DE", 1, 1.0)])),
        known=first,
    )
    assert rows_of(later, "supplier_key", "supplier_id", "name") == [
        (2, "A", "changed"), (3, "D", "d"), (4, "C", "c"),
    ]


def test_lazy_star_agrees_with_numbered_star(star, lazy_star):
    columns = ("order_id", "date_key", "total_amount", "profit_margin", "is_returned")
    assert rows_of(lazy_star.fact_sales, *columns) == rows_of(star.fact_sales, *columns)


def test_order_keys_in_any_order(sources, params):
    from tallyloom.operators.cleaning import clean_all
    from tallyloom.operators.star import enrich_all
    from tallyloom.plans.job import build_star

    fact = build_star(enrich_all(clean_all(sources)), params, order_keys="any").fact_sales
    assert rows_of(fact, "order_key") == [(1,), (2,), (3,), (4,), (5,)]
