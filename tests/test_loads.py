"""Loads beside each other, on other states, and in many small steps."""

import os
import threading

import pytest
from conftest import ROWS, rows_of
from pyspark.sql import functions as F

from tallyloom.operators.cleaning import clean_all
from tallyloom.operators.merge import new_rows
from tallyloom.operators.star import Star, enrich_all
from tallyloom.plans.analyses import rfm_segmentation
from tallyloom.plans.job import build_star, increment_star, of_orders, unseen_orders
from tallyloom.session import staging_root, staging_scope
from tallyloom.sinks.warehouse import Warehouse


@pytest.fixture
def loaded(spark, tmp_path, star):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.load_full(star)
    return warehouse


def increment(warehouse, sources, params):
    return warehouse.load_incremental(increment_star(sources, params, warehouse.star()), facts_checked=True)


def order(n, customer="K17", day="2024-08-01"):
    return (f"B-2{n:02d}", customer, "A10", 1, 100.0, 0.0, day, "completed")


def days(warehouse):
    return {str(r.date) for r in warehouse.table("agg_daily_sales").collect()}


def test_orders_without_a_date_leave_other_days_alone(loaded, sources, frame, params):
    before = days(loaded)
    orders = frame("orders", [order(50), order(51, day=None)])
    assert increment(loaded, {**sources, "orders": orders}, params) == 2
    assert days(loaded) == before | {"2024-08-01"}


def test_increments_at_once_lose_nothing(spark, loaded, sources, frame, params):
    root, results, errors = loaded.root, [], []
    gate = threading.Barrier(3)

    def load(n):
        try:
            orders = frame("orders", [order(n), order(n + 1, customer="K777")])
            customers = frame("customers", [(f"C1{n}", "New", "n@x", "Nord", "Kiel", "B2C", "2024-08-01")])
            warehouse = Warehouse(spark, root)
            known = warehouse.star()
            gate.wait(60)  # all have read the same state
            ready = enrich_all(clean_all(unseen_orders({**sources, "orders": orders, "customers": customers}, known)))
            results.append(warehouse.load_incremental(build_star(ready, params, known), facts_checked=True))
        except Exception as exc:  # noqa: BLE001 - collected for the assertion
            errors.append(exc)

    threads = [threading.Thread(target=load, args=(n,)) for n in (100, 200, 300)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert errors == [] and results == [2, 2, 2]
    fact = loaded.table("fact_sales")
    assert fact.count() == 11
    assert sorted(r.order_key for r in fact.collect()) == list(range(1, 12))
    customers = loaded.table("dim_customer")
    assert customers.count() == 7 and customers.select("customer_key").distinct().count() == 7


def test_a_batch_built_without_the_loaded_tables_is_keyed_anew(loaded, sources, frame, params):
    customers = frame("customers", [
        ("K90", "New", "n@x", "Nord", "Kiel", "B2C", "2024-08-01"),
        ("K23", "Anna", "a@x", "Sued", "Muenchen", "B2B", "2024-03-20"),
    ])
    products = frame("products", [
        ("A90", "Lamp", "Home", "Lamps", "Lux", "L9", 10.0, 20.0),
        ("A10", "Laptop", "Electronics", "Laptops", "Norvex", "L1", 400.0, 800.0),
    ])
    suppliers = frame("suppliers", [("L9", "Lux AG", "DE", 5, 4.0), ("L1", "Tech", "DE", 5, 4.5)])
    orders = frame("orders", [
        ("B-270", "K90", "A90", 1, 20.0, 0.0, "2024-08-01", "completed"),
        ("B-271", "K23", "A10", 1, 800.0, 0.0, "2024-08-02", "completed"),
        ("B-272", "K404", "A404", 1, 5.0, 0.0, "2024-08-03", "completed"),
    ])
    replaced = {"customers": customers, "products": products, "suppliers": suppliers, "orders": orders}
    batch = build_star(enrich_all(clean_all({**sources, **replaced})), params)
    assert batch.version is None
    assert loaded.load_incremental(batch, facts_checked=True) == 3
    assert rows_of(loaded.table("dim_customer"), "customer_key", "customer_id") == [
        (1, "K17"), (2, "K23"), (3, "K41"), (4, "K58"), (5, "K90"),
    ]
    star = loaded.star()
    lamp = star.dim_product.filter("product_id = 'A90'").first()
    lux = star.dim_supplier.filter("supplier_id = 'L9'").first()
    assert (lamp.product_key, lux.supplier_key, lamp.supplier_key) == (5, 4, 4)
    new = star.fact_sales.filter("order_key > 5")
    assert rows_of(new, "order_id", "customer_key", "product_key", "supplier_key") == [
        ("B-270", 5, 5, 4), ("B-271", 2, 1, 1), ("B-272", 0, 0, 0),
    ]


def test_many_increments_leave_earlier_facts_alone(loaded, sources, frame, params):
    for n in range(6):
        increment(loaded, {**sources, "orders": frame("orders", [order(80 + n, day=f"2024-0{n + 3}-09")])}, params)
    before = rows_of(loaded.table("fact_sales"), *loaded.table("fact_sales").columns)
    assert len(loaded._state().tables["fact_sales"]) == 7
    assert increment(loaded, {**sources, "orders": frame("orders", [order(99)])}, params) == 1
    after = rows_of(loaded.table("fact_sales"), *loaded.table("fact_sales").columns)
    assert set(before) < set(after)
    assert loaded.table("fact_sales").agg(F.max("order_key")).first()[0] == len(before) + 1


def test_unchanged_dimensions_are_not_written_again(loaded, sources, frame, params):
    before = loaded._state().tables
    assert increment(loaded, {**sources, "orders": frame("orders", [order(90)])}, params) == 1
    after = loaded._state().tables
    assert all(after[n] == before[n] for n in ("dim_date", "dim_customer", "dim_supplier", "dim_product"))
    counts = rows_of(loaded.table("load_metadata"), "table_name", "records_processed")
    assert ("dim_customer", 4) in counts and ("dim_product", 4) in counts  # looked at, all the same
    renamed = frame("suppliers", [("L1", "Elbe AG", "PL", 9, 4.1), ("L7", "New", "FR", 9, 4.0)])
    assert increment(loaded, {**sources, "suppliers": renamed, "orders": frame("orders", [order(91)])}, params) == 1
    last = loaded._state().tables
    assert last["dim_customer"] == before["dim_customer"] and last["dim_supplier"] != before["dim_supplier"]
    assert rows_of(loaded.table("dim_supplier"), "supplier_key", "supplier_id", "name") == [
        (1, "L1", "Elbe AG"), (2, "L2", "Orient Trade SE"), (3, "L3", "Fjord Gear AS"), (4, "L7", "New"),
    ]


def test_later_increments_on_one_state_leave_unchanged_dimensions_alone(loaded, sources, frame, params):
    """Of two batches built on one state the second is keyed anew only where the first changed a dimension."""
    before, known = loaded._state().tables, loaded.star()

    def batch(n, **changed):
        some = {**sources, "orders": frame("orders", [order(n), order(40, "C7"), order(n + 1)]), **changed}
        return build_star(enrich_all(clean_all(unseen_orders(some, known))), params, known)

    same = [batch(n) for n in (60, 62)]
    renamed = frame("suppliers", [("L1", "Elbe AG", "PL", 9, 4.1), ("L7", "New", "FR", 9, 4.0)])
    fresh = frame("suppliers", [("L8", "Newer", "FR", 9, 4.0)])
    customers = frame("customers", [("C7", "Seven", "7@x", "Nord", "Kiel", "B2C", "2024-08-01")])
    other = [batch(64, suppliers=renamed), batch(66, suppliers=fresh, customers=customers)]
    assert [loaded.load_incremental(b, facts_checked=True) for b in same] == [3, 2]
    after = loaded._state().tables
    assert all(after[n] == before[n] for n in ("dim_date", "dim_customer", "dim_supplier", "dim_product"))
    assert [loaded.load_incremental(b, facts_checked=True) for b in other] == [2, 2]
    last = loaded._state().tables
    assert last["dim_customer"] != before["dim_customer"] and last["dim_supplier"] != before["dim_supplier"]
    assert rows_of(loaded.table("dim_supplier"), "supplier_key", "supplier_id")[3:] == [(4, "L7"), (5, "L8")]
    fact = loaded.table("fact_sales")
    assert sorted(r.order_key for r in fact.collect()) == list(range(1, fact.count() + 1))


def test_full_load_between_building_and_loading_an_increment(loaded, sources, frame, params):
    """The full load gives other keys; unchanged members of the increment follow them too."""
    known = loaded.star()
    later = {**sources, "orders": frame("orders", [order(95)])}
    batch = build_star(enrich_all(clean_all(unseen_orders(later, known))), params, known)
    turned = frame("customers", [*reversed(ROWS["customers"])])
    loaded.load_full(build_star(enrich_all(clean_all({**sources, "customers": turned})), params))
    keys = dict(rows_of(loaded.table("dim_customer"), "customer_id", "customer_key"))
    assert keys != dict(rows_of(known.dim_customer, "customer_id", "customer_key"))
    assert loaded.load_incremental(batch, facts_checked=True) == 1
    new = loaded.table("fact_sales").filter("order_key > 5").first()
    who = later["orders"].first().customer_id
    assert new.customer_key == keys[who]


def test_a_claim_that_stays_is_reported(loaded, star, monkeypatch):
    from tallyloom.sinks import files, warehouse

    number = loaded._state().number + 1
    claim = loaded._number(number, "claim")
    assert files.claim(loaded.spark, claim)
    monkeypatch.setattr(warehouse, "_WAIT_SECONDS", 1)
    with pytest.raises(warehouse.ConcurrentLoadError, match="claim"):
        loaded.load_full(star)
    files.remove(loaded.spark, claim)
    assert loaded.load_full(star)["fact_sales"] == 5


def test_copies_of_a_return_stay_together(frame):
    returns = frame("returns", [
        ("R1", "ORD-1", "2024-01-01", "a"), ("R1", "ORD-2", "2024-01-02", "b"), ("R2", "ORD-3", "2024-01-03", "c"),
    ])
    orders = returns.select("order_id").filter("order_id = 'ORD-2'")
    assert rows_of(of_orders(returns, orders, "return_id"), "return_id", "order_id") == [
        ("R1", "ORD-1"), ("R1", "ORD-2"),
    ]


def test_new_rows_shuffles_each_side_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = spark.range(100).selectExpr("cast(id as string) AS k", "id AS v")
        loaded = spark.range(50).selectExpr("cast(id as string) AS k")
        new = new_rows(batch, loaded, "k").dropDuplicates(["k"])
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert new.count() == 50
        small = new_rows(batch, loaded, "k", small_batch=True)
        assert "LeftSemi" in small._jdf.queryExecution().executedPlan().toString()
        assert small.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_keys_are_equal(spark):
    batch = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    loaded = spark.createDataFrame([("a",)], "k string")
    assert rows_of(new_rows(batch, loaded, "k"), "v") == [(1,), (3,)]
    both = loaded.unionByName(spark.createDataFrame([(None,)], "k string"))
    assert rows_of(new_rows(batch, both, "k"), "v") == [(3,)]


def test_scoped_analysis_leaves_nothing_staged(spark, lazy_star, params):
    root = staging_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with staging_scope(spark):
        assert rfm_segmentation(lazy_star, params).count() == 3
    assert set(os.listdir(root)) == before


def test_first_loads_at_once_fall_back_once(spark, tmp_path, star):
    warehouse = Warehouse(spark, str(tmp_path / "fresh"))
    assert warehouse.load_incremental(star) is None
    assert warehouse.load_incremental(Star(**star.tables())) == 0
