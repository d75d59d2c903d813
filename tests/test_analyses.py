from datetime import date

import pytest
from conftest import rows_of

from tallyloom.params import MartParams
from tallyloom.plans import analyses, reports
from tallyloom.plans.named import (
    NAMED_QUERIES,
    UnknownQueryError,
    available_queries,
    run_named,
)


def records(df):
    return [tuple(r) for r in df.collect()]


def order(order_id, customer="K17", product="A10", day="2024-03-01", price=100.0, quantity=1,
          discount=0.0):
    return (order_id, customer, product, quantity, price, discount, day, "completed")


@pytest.fixture(params=["numbered", "lazy"])
def any_star(request):
    return request.getfixturevalue("star" if request.param == "numbered" else "lazy_star")


def test_registry(star):
    assert len(available_queries()) == 15
    assert available_queries() == sorted(NAMED_QUERIES)
    with pytest.raises(UnknownQueryError, match="Query not found: nope"):
        run_named("nope", star)
    assert isinstance(UnknownQueryError("x"), KeyError)


def test_revenue_trends(any_star):
    assert records(analyses.revenue_trends(any_star)) == [
        (2024, 2, "February", 471.0, 1, 471.0, None, None),
        (2024, 3, "March", 37.4, 1, 508.4, 471.0, -92.1),
        (2024, 5, "May", 72.0, 1, 580.4, 37.4, 92.5),
        (2024, 8, "August", 153.5, 2, 733.9, 72.0, 113.2),
    ]


def test_seasonal_index(lazy_star):
    got = records(analyses.seasonal_index(lazy_star))
    assert got[0] == (2, "February", 471.0, 183.48, 256.7)
    assert [r[0] for r in got] == [2, 3, 5, 8]


def test_kpis(any_star):
    row = analyses.kpi_snapshot(any_star).first()
    assert row.total_revenue == 733.9 and row.total_orders == 5
    assert row.avg_order_value == pytest.approx(146.78)
    assert row.unique_customers == 3 and row.return_rate == 40.0


def test_category_revenue(star):
    assert records(reports.category_revenue(star)) == [
        ("Tents", 471.0), ("Kitchen", 262.9),
    ]


def test_abc(any_star):
    got = records(analyses.abc_analysis(any_star))
    assert [(r[0], r[4], r[5]) for r in got] == [
        ("A10", 64.2, "A"), ("A20", 85.8, "B"), ("A30", 100.0, "C"),
    ]
    assert records(reports.abc_class_counts(any_star)) == [("A", 1), ("B", 1), ("C", 1)]


def test_abc_ties_share_a_value_and_missing_classes_are_null(make_star, frame):
    star = make_star(orders=frame("orders", [order("1"), order("2", product="A20")]))
    got = records(analyses.abc_analysis(star))
    assert [(r[0], r[4], r[5]) for r in got] == [("A10", 100.0, "C"), ("A20", 100.0, "C")]
    assert records(reports.abc_class_counts(star)) == [("A", None), ("B", None), ("C", 2)]


def test_churn(star):
    got = records(analyses.customer_churn(star))
    assert [(r[0], r[5], r[7], r[8]) for r in got] == [
        ("K41", 1, 609, "Churned"), ("K23", 2, 508, "Churned"), ("K17", 2, 489, "Churned"),
        ("K58", 0, None, "Never Purchased"),
    ]


def test_churn_limits_and_customer_without_sales(make_star, frame):
    star = make_star(orders=frame("orders", [order("1", "K17", day="2024-06-01"),
                                             order("2", "K23", day="2024-09-01")]))
    got = {r.customer_id: r for r in
           analyses.customer_churn(star, MartParams(asof=date(2024, 11, 28))).collect()}
    assert (got["K17"].days_since_last, got["K17"].churn_status) == (180, "At Risk")
    assert (got["K23"].days_since_last, got["K23"].churn_status) == (88, "Active")
    never = got["K41"]
    assert never.churn_status == "Never Purchased" and never.total_orders == 0
    assert never.lifetime_value is None and never.days_since_last is None


def test_discount_tiers(star, make_star, frame):
    got = records(analyses.discount_impact(star))
    assert [(r[0], r[1]) for r in got] == [("No Discount", 2), ("1-5%", 1), ("6-10%", 1), ("11-15%", 1)]
    star = make_star(orders=frame("orders", [order("1", discount=12.0), order("2", discount=20.0),
                                             order("3", discount=50.0),
                                             order("4", discount=None)]))
    got = {r[0]: r[1] for r in records(analyses.discount_impact(star))}
    assert got == {"11-15%": 1, "16-20%": 3}


def test_shipping_tiers(star, make_star, frame):
    got = records(analyses.shipping_efficiency(star))
    assert got == [
        ("Economy (< 5)", 2, 3.65, 34.7, 10.5), ("Standard (5-8)", 1, 5.6, 72.0, 7.8),
        ("Express (> 8)", 2, 10.15, 296.25, 3.4),
    ]
    event = ("x", "2024-01-01", "2024-01-02")
    star = make_star(
        orders=frame("orders", [order("1"), order("2")]),
        shipping=frame("shipping", [("1", *event, 8.0)]),
    )
    assert records(analyses.shipping_efficiency(star))[0][:2] == ("Express (> 8)", 1)


def test_supplier_scorecard(star):
    got = records(analyses.supplier_scorecard(star))
    assert [(r[0], r[4], r[5], r[7]) for r in got] == [
        ("L2", 1, 471.0, 0.0), ("L1", 4, 262.9, 50.0),
    ]


def test_return_rate(star):
    got = {r.category: r for r in analyses.return_rate_analysis(star).collect()}
    assert got["Kitchen"][1:] == (4, 2, 50.0, 40.0, 10.0)
    assert got["Tents"][1:] == (1, 0, 0.0, 40.0, -40.0)


def test_growth(make_star, frame, params):
    star = make_star(orders=frame("orders", [
        order("1", day="2023-05-01"), order("2", day="2024-05-01", price=150.0),
        order("3", product="A20", day="2024-05-01"),
    ]))
    star.dim_date = analyses_calendar(star, date(2023, 1, 1), date(2024, 12, 31))
    got = analyses.yoy_category_growth(star, MartParams(growth_years=(2023, 2024)))
    assert got.columns == ["category", "revenue_2023", "revenue_2024", "yoy_growth_pct"]
    assert records(got) == [
        ("Tents", 100.0, 150.0, 50.0), ("Kitchen", None, 100.0, None),
    ]


def analyses_calendar(star, start, end):
    from tallyloom.operators.dimensions import build_dim_date

    return build_dim_date(star.fact_sales.sparkSession, start, end)


def test_top_products_merge_names_and_keep_ties(make_star, frame):
    products = [(f"P{i}", name, "Cat", "s", "b", "L1", 1.0, 2.0)
                for i, name in enumerate(["x", "x", "y", "z", "w", "v"])]
    star = make_star(
        products=frame("products", products),
        orders=frame("orders", [
            order("1", product="P0", price=30.0), order("2", product="P1", price=30.0),
            order("3", product="P2", price=50.0), order("4", product="P3", price=40.0),
            order("5", product="P4", price=40.0), order("6", product="P5", price=10.0),
        ]),
    )
    assert records(analyses.top_products_by_category(star)) == [
        ("Cat", "x", 60.0, 2, 1), ("Cat", "y", 50.0, 1, 2),
        ("Cat", "w", 40.0, 1, 3), ("Cat", "z", 40.0, 1, 3),
    ]


def test_cohorts(any_star, params):
    got = records(analyses.cohort_retention(any_star))
    assert got == [
        ("2024-02", 0, 1), ("2024-02", 6, 1), ("2024-03", 0, 1), ("2024-03", 5, 1), ("2024-05", 0, 1),
    ]
    matrix = reports.cohort_matrix(any_star, params)
    assert matrix.columns == ["cohort_month"] + [str(m) for m in range(12)]
    assert records(matrix.select("cohort_month", "0", "1", "6"))[0] == ("2024-02", 1, None, 1)


def test_cohort_ignores_customers_who_started_outside_the_calendar(make_star, frame):
    star = make_star(orders=frame("orders", [
        order("1", "K17", day="2023-12-31"), order("2", "K17", day="2024-01-05"),
        order("3", "K23", day="2024-02-01"), order("4", "K23", day="2025-01-01"),
    ]))
    assert records(analyses.cohort_retention(star)) == [("2024-02", 0, 1)]


def test_ltv(star):
    got = records(analyses.customer_ltv(star))
    assert got[0] == (
        "K23", "Noor Haddad", "B2B", "Coast", 2, 503.0, 251.5,
        date(2024, 2, 22), date(2024, 8, 11), 171.0,
    )
    assert records(analyses.top_customers(star, limit=1)) == got[:1]


def test_rfm(any_star):
    got = {r.customer_id: r for r in analyses.rfm_segmentation(any_star).collect()}
    assert [got[c].r_score for c in ("K41", "K23", "K17")] == [1, 2, 3]
    assert [got[c].f_score for c in ("K41", "K17", "K23")] == [1, 2, 3]
    assert [got[c].m_score for c in ("K41", "K17", "K23")] == [1, 2, 3]
    assert got["K23"].recency_days == 508.0 and got["K23"].monetary == 503.0
    assert {c: r.segment for c, r in got.items()} == {
        "K23": "At Risk", "K41": "Lost", "K17": "Regular",
    }
    assert rows_of(reports.segment_counts(any_star), "segment", "customers") == [
        ("At Risk", 1), ("Lost", 1), ("Regular", 1),
    ]


def test_basket_and_weekdays(star):
    got = records(analyses.basket_analysis(star))
    assert got == [
        ("B2B", "2024-Q1", 1, 2.0, 471.0, 471.0), ("B2B", "2024-Q3", 1, 4.0, 32.0, 32.0),
        ("B2C", "2024-Q1", 1, 1.0, 37.4, 37.4), ("B2C", "2024-Q2", 1, 10.0, 72.0, 72.0),
        ("B2C", "2024-Q3", 1, 3.0, 121.5, 121.5),
    ]
    days = records(analyses.day_of_week_patterns(star))
    assert [(d[0], d[1], d[2], d[3]) for d in days] == [
        ("Thursday", 4, 2, 543.0), ("Friday", 5, 1, 121.5), ("Saturday", 6, 1, 37.4), ("Sunday", 7, 1, 32.0),
    ]
    assert [d[5] for d in days] == [195.9, -33.8, -79.6, -82.6]


def test_orphans_count_in_kpis_but_not_in_joined_analyses(make_star, frame):
    star = make_star(orders=frame("orders", [order("1"), order("2", "C9", "P9"),
                                             order("3", "C8", "P8")]))
    kpis = analyses.kpi_snapshot(star).first()
    assert (kpis.total_revenue, kpis.total_orders, kpis.unique_customers) == (300.0, 3, 2)
    assert records(reports.category_revenue(star)) == [("Tents", 100.0)]
    assert analyses.customer_ltv(star).count() == 1
    assert records(analyses.return_rate_analysis(star))[0][:2] == ("Tents", 1)


def test_empty_fact(make_star, frame):
    star = make_star(orders=frame("orders", []))
    for name in available_queries():
        run_named(name, star).collect()
    assert analyses.kpi_snapshot(star).first().total_orders == 0
