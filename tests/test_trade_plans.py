"""How the trade tables are dealt: copies go where the join leaves them, and nothing is computed twice."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import timeline_queries
from tallyloom.operators import cleaning, dealt
from tallyloom.operators.ordinals import DEALT, HOME, ORDINAL
from tallyloom.operators.star import enrich_all
from tallyloom.plans.job import build_star, of_orders, unseen_orders
from tallyloom.sources.trade import TRADE_PARAMS, raw_orders, trade_sources

LINES = [  # order, line, day shipped, part, quantity, price; the copy shipped first counts
    (1, 1, date(2000, 3, 2), 7, 2.0, 20.0), (1, 1, date(2000, 3, 1), 8, 1.0, 30.0), (1, 2, date(2000, 3, 5), 7, 1.0, 9.0),
    (1, None, date(2000, 3, 6), 8, 4.0, 8.0), (1, None, date(2000, 3, 4), 8, 2.0, 8.0), (2, 1, date(2001, 5, 1), 7, 1.0, 5.0),
    (3, 1, date(2001, 6, 1), 7, 1.0, 5.0), (None, 1, date(2001, 6, 1), 7, 1.0, 5.0), (4, 1, None, 8, 3.0, 6.0),
    (4, 1, date(2001, 1, 1), 8, 3.0, 9.0),
]
WANT = {("1-1", 30.0), ("1-2", 9.0), ("1", 4.0), ("2-1", 5.0), ("4-1", 2.0)}  # order 3 is cancelled


@pytest.fixture()
def folder(spark, tmp_path):
    tables = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date",
                   [(k, 5, "P" if k == 3 else "F", date(2000 + (k > 1), 2, 1)) for k in (1, 2, 3, 4)]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_shipdate date, l_partkey long, l_suppkey long, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
                     [(o, n, day, part, 9, q, p, 0.0, 0.01, "N", "O") for o, n, day, part, q, p in LINES]),
        "customer": ("c_custkey long, c_name string, c_nationkey long, c_mktsegment string", [(5, "C#5", 1, "M")]),
        "part": ("p_partkey long, p_name string, p_type string, p_size int, p_brand string, p_retailprice double",
                 [(k, "p", "t", 1, "b", 9.0) for k in (7, 8)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey long", [(9, "S", 1)]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(1, "N", 1)]),
        "region": ("r_regionkey long, r_name string", [(1, "R")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture()
def shuffled(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_of_an_order_go_where_the_join_leaves_them(spark, folder, shuffled):
    clean = cleaning.clean_orders(raw_orders(spark, folder))
    assert plan_of(clean).count("Exchange hashpartitioning") == 2  # both sides of the join, and no more
    assert {(r["order_id"], float(r["unit_price"])) for r in clean.collect()} == WANT
    assert HOME not in clean.columns and clean.count() == len(WANT)


def test_orders_without_a_home_lose_their_copies_too(spark, folder):
    clean = cleaning.clean_orders(raw_orders(spark, folder).drop(HOME))
    assert {(r["order_id"], float(r["unit_price"])) for r in clean.collect()} == WANT


def test_ordinals_are_staged_only_for_keys_in_source_order(spark, folder):
    ready = enrich_all(cleaning.clean_all(trade_sources(spark, folder)))
    for order_keys, staged in (("any", False), ("source", True)):
        fact = build_star(ready, TRADE_PARAMS, order_keys=order_keys).fact_sales
        columns = {c for f in fact.inputFiles() for c in spark.read.parquet(f).columns}
        assert (ORDINAL in columns) == staged
        assert sorted(r[0] for r in fact.select("order_key").collect()) == [1, 2, 3, 4, 5]


def test_facts_in_source_order_move_little(spark, folder, shuffled):
    """Lines are dealt once, and the ordinal is gone before customers and products are looked up."""
    fact = registered.queries()["fact_sales"](spark, folder)
    got = [tuple(r) for r in fact.orderBy("order_key").select("order_key", "order_id", "customer_key", "shipping_cost").collect()]
    ids = ["4-1", "1-1", "1", "1-2", "2-1"]  # by the day that the first copy was shipped
    assert got == [(k, i, 1, 4.99) for k, i in enumerate(ids, 1)]
    assert plan_of(fact).count("Exchange hashpartitioning(customer_id") == 2
    staged = [set(spark.read.parquet(f).columns) for f in fact.inputFiles()]
    of_facts = [columns for columns in staged if "order_id" in columns]
    assert of_facts and all("order_key" not in c and ORDINAL not in c and "_slot" in c for c in of_facts)


def test_copies_go_before_known_orders_are_looked_up(spark, folder):
    sources = trade_sources(spark, folder)
    early = {**sources, "orders": sources["orders"].filter("order_date < '2001-01-01'")}
    known = build_star(enrich_all(cleaning.clean_all(early)), TRADE_PARAMS)
    fresh = unseen_orders(sources, known)["orders"]
    assert sorted(r["order_id"] for r in fresh.collect()) == ["2-1", "3-1", "4-1"]
    assert HOME not in fresh.columns


def test_new_facts_are_computed_once(spark, folder):
    new = registered.queries()["incremental_new_facts"](spark, folder)
    assert "l_orderkey" not in plan_of(new)
    assert sorted(r["order_id"] for r in new.filter(F.col("date_key") > 0).collect()) == ["2-1", "4-1"]


def test_dealt_sources_hold_the_same_rows(spark, folder):
    plain, dealt = trade_sources(spark, folder, dirty=True), trade_sources(spark, folder, dirty=True, dealt=True)
    for name in ("orders", "returns", "shipping"):
        assert DEALT in dealt[name].columns
        columns = [c for c in plain[name].columns if c != HOME]
        assert plain[name].count() > 0 or name == "returns"
        assert plain[name].select(columns).exceptAll(dealt[name].select(columns)).isEmpty()
        assert dealt[name].count() == plain[name].count()


def test_dealt_orders_meet_their_events_without_an_exchange(spark, folder, shuffled):
    ready = {d: enrich_all(cleaning.clean_all(trade_sources(spark, folder, dealt=d)))["orders"] for d in (False, True)}
    assert plan_of(ready[False]).count("Exchange hashpartitioning") > 2
    assert "Exchange hashpartitioning" not in plan_of(ready[True])
    columns = [c for c in ready[True].columns if c != ORDINAL]
    assert columns == [c for c in ready[False].columns if c != ORDINAL]
    both = [sorted(map(repr, ready[d].select(columns).collect())) for d in (False, True)]
    assert both[0] == both[1] and len(both[0]) == 5


def test_a_line_without_order_key_still_meets_the_order_of_its_id(spark, folder, tmp_path):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    lone = lines.filter("l_orderkey = 4").limit(1).withColumns(
        {"l_orderkey": F.lit(None).cast("long"), "l_linenumber": F.lit(1), "l_returnflag": F.lit("R"), "l_tax": F.lit(0.07)}
    )
    lines.unionByName(lone).write.parquet(f"{tmp_path}/more/lineitem.parquet")
    for name in ("orders", "customer", "part", "supplier", "nation", "region"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/more/{name}.parquet")
    for dealt in (False, True):
        orders = enrich_all(cleaning.clean_all(trade_sources(spark, f"{tmp_path}/more", dealt=dealt)))["orders"]
        assert [r[0] for r in orders.filter("is_returned").select("order_id").collect()] == ["1"]


def test_events_of_dealt_orders_stay_where_they_are(spark, folder, shuffled):
    sources = trade_sources(spark, folder, dealt=True)
    early = {**sources, "orders": sources["orders"].filter("order_date < '2001-01-01'")}
    known = build_star(enrich_all(cleaning.clean_all(early)), TRADE_PARAMS)
    fresh = unseen_orders(sources, known)
    assert sorted(r["order_id"] for r in fresh["orders"].collect()) == ["2-1", "4-1"]  # a cancelled one is not loaded
    assert plan_of(fresh["shipping"]).count("Exchange hashpartitioning") == 1  # the ids of the new orders
    assert sorted(r["order_id"] for r in fresh["shipping"].collect()) == ["2-1", "4-1", "4-1"]
    fact = build_star(enrich_all(cleaning.clean_all(fresh)), TRADE_PARAMS, known).fact_sales
    assert sorted((r["order_id"], float(r["shipping_cost"])) for r in fact.collect()) == [("2-1", 4.99), ("4-1", 4.99)]


def test_buckets_follow_the_number_of_lines(spark, folder, shuffled, monkeypatch):
    monkeypatch.setattr(dealt, "BUCKET_ROWS", 1)
    sources = trade_sources(spark, folder, dealt=True)
    ready = plan_of(enrich_all(cleaning.clean_all(sources))["orders"])
    assert f"SelectedBucketsCount: {len(LINES)} out of {len(LINES)}" in ready
    assert "Exchange hashpartitioning" not in ready
    early = {**sources, "orders": sources["orders"].filter("order_date < '2001-01-01'")}
    known = build_star(enrich_all(cleaning.clean_all(early)), TRADE_PARAMS)
    fresh = unseen_orders(sources, known)
    assert plan_of(fresh["shipping"]).count("Exchange hashpartitioning") == 1  # the ids, into as many buckets
    assert sorted(r["order_id"] for r in fresh["shipping"].collect()) == ["2-1", "4-1", "4-1"]


def test_buckets_of_the_fact_follow_the_number_of_lines(spark, folder, tmp_path, shuffled, monkeypatch):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    lines.unionByName(lines).write.parquet(f"{tmp_path}/more/lineitem.parquet")
    for name in ("orders", "customer", "part", "supplier", "nation", "region"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/more/{name}.parquet")
    monkeypatch.setattr(timeline_queries, "BUCKET_ROWS", 1)
    churn = timeline_queries.bucketed_churn(spark, f"{tmp_path}/more")
    assert f"SelectedBucketsCount: {2 * len(LINES)} out of {2 * len(LINES)}" in plan_of(churn)
    assert [(r["customer_id"], r["total_orders"]) for r in churn.collect()] == [("5", 5)]


def test_copies_of_a_return_stay_together(spark):
    returns = spark.createDataFrame([(1, "R1", "a"), (1, "R1", "b"), (1, "R2", "c"), (2, "R3", None)], f"{DEALT} long, return_id string, order_id string")
    orders = spark.createDataFrame([(1, "b"), (2, "d")], f"{DEALT} long, order_id string")
    found = of_orders(returns, orders, "return_id")
    assert found.columns == returns.columns
    assert sorted((r["return_id"], r["order_id"]) for r in found.collect()) == [("R1", "a"), ("R1", "b")]
