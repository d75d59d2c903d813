import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyloom.operators import validation
from tallyloom.sources import extract_all


def issues(sources, **kwargs):
    checked = validation.check_sources(sources, **kwargs)
    return rows_of(
        validation.issues_of(checked), "source", "row_index", "field", "value", "rule"
    )


def bad_order(**changes):
    base = dict(order_id="O1", customer_id="K17", product_id="A10", quantity=1,
                unit_price=10.0, discount_pct=0.0, order_date="2024-01-01", status="completed")
    return tuple({**base, **changes}.values())


def test_clean_sample_has_no_issues(sources):
    assert issues(sources) == []
    summary = validation.summarise(validation.check_sources(sources))
    assert {r.quality_score for r in summary.collect()} == {100.0}
    assert validation.overall(summary).first()[:] == (100.0, 0)


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({"order_id": None}, ("order_id", "NULL", "not_null")),
        ({"quantity": -5}, ("quantity", "-5", "positive_value")),
        ({"unit_price": -10.0}, ("unit_price", "-10.0", "positive_value")),
        ({"discount_pct": 150.0}, ("discount_pct", "150.0", "range_check")),
        ({"customer_id": "C9999"}, ("customer_id", "C9999", "referential_integrity")),
        ({"product_id": "P999"}, ("product_id", "P999", "referential_integrity")),
    ],
)
def test_order_rules(sources, frame, changes, expected):
    orders = frame("orders", [bad_order(), bad_order(**changes)])
    assert issues({**sources, "orders": orders}) == [("orders", 1, *expected)]


def test_repeated_customer_flags_later_rows_only(sources, frame):
    row = ("C1", "n", "e", "r", "c", "B2C", "2024-01-01")
    customers = frame("customers", [row, ("C2", *row[1:]), row, row])
    got = issues({"customers": customers})
    assert got == [
        ("customers", 2, "customer_id", "C1", "unique"),
        ("customers", 3, "customer_id", "C1", "unique"),
    ]


def test_cost_above_retail(sources, frame):
    products = frame("products", [("P1", "n", "c", "s", "b", "S", 100.0, 50.0)])
    assert issues({"products": products}) == [
        ("products", 0, "retail_price", "cost=100.0, retail=50.0", "business_rule")
    ]


def test_messages(sources, frame):
    orders = frame("orders", [bad_order(status=None, customer_id="C9")])
    checked = validation.check_sources({**sources, "orders": orders})
    assert rows_of(validation.issues_of(checked), "message") == [
        ("Customer ID not found in customers table",),
        ("Missing required field: status",),
    ]


def test_empty_parents(sources, frame):
    """No customers: every order is reported. No products: the check is off."""
    none = {"customers": frame("customers", []), "products": frame("products", [])}
    got = issues({**sources, **none})
    assert len(got) == 6 and {g[2] for g in got} == {"customer_id"}
    assert issues({"orders": sources["orders"]}) == []


def test_penalty_counts_each_broken_reference(sources, frame):
    orders = frame("orders", [
        bad_order(customer_id="C9", product_id="P9", quantity=0), bad_order(), bad_order(),
    ])
    checked = validation.check_sources({**sources, "orders": orders})
    row = validation.summarise(checked).filter("source_name = 'orders'").first()
    assert (row.total_rows, row.valid_rows, row.invalid_rows, row.quality_score) == (3, 0, 3, 0.0)
    row = validation.summarise(checked, "distinct_rows").filter("source_name = 'orders'").first()
    assert (row.valid_rows, row.invalid_rows, row.quality_score) == (2, 1, 66.7)


def test_score_may_fall_below_zero_and_mean_is_unweighted(sources, frame):
    orders = frame("orders", [bad_order(customer_id="C9", product_id="P9")])
    summary = validation.summarise(validation.check_sources({**sources, "orders": orders}))
    assert summary.filter("source_name = 'orders'").first().quality_score == -100.0
    assert validation.overall(summary).first()[:] == (66.7, 2)


def test_empty_source_scores_full(sources, frame):
    summary = validation.summarise(validation.check_sources({"returns": frame("returns", [])}))
    assert summary.first().quality_score == 100.0


def test_quarantine_split(sources, frame):
    orders = frame("orders", [bad_order(), bad_order(quantity=-1), bad_order(customer_id="C9")])
    checked = validation.check_sources({**sources, "orders": orders})["orders"]
    valid, quarantined = validation.split_quarantine(checked)
    assert valid.count() == 1 and quarantined.count() == 2
    assert "_row_issues" not in valid.columns


def test_declared_rules_are_opt_in(sources, frame):
    orders = frame("orders", [bad_order(status="lost")])
    suppliers = frame("suppliers", [("S", "n", "DE", 0, 5.5)])
    changed = {**sources, "orders": orders, "suppliers": suppliers}
    assert issues(changed) == []
    assert [g[2:] for g in issues(changed, declared=True)] == [
        ("status", "lost", "domain"),
        ("lead_time_days", "0", "positive_value"),
        ("reliability_rating", "5.5", "range_check"),
    ]


def test_reports(sources, frame, star):
    orders = frame("orders", [bad_order(quantity=-1)] * 60)
    found = validation.issues_of(validation.check_sources({**sources, "orders": orders}))
    assert rows_of(validation.issues_by_source(found), "source", "issues") == [("orders", 60)]
    assert validation.issue_sample(found).count() == 50
    score = validation.warehouse_score(found, star.fact_sales).first()
    assert score[:] == (7.7, 60, 5)
    empty = found.filter(F.lit(False))
    assert validation.warehouse_score(empty, star.fact_sales).first().quality_score == 100.0


def test_file_sources_report_file_positions(spark, data_dir):
    path = f"{data_dir}/raw/orders.csv"
    with open(path, "a") as out:
        out.write("ORD-9,K17,A10,-2,5.0,0,2024-01-01,completed\n")
    frames = {n: e.df for n, e in extract_all(spark, data_dir).items()}
    assert issues(frames) == [("orders", 6, "quantity", "-2", "positive_value")]
