"""What the queries on landed files, loads and time joins write on their way."""

import landed_queries
import timeline_queries
from conftest import ROWS

from tallyloom.operators import validation
from tallyloom.schemas import RAW
from tallyloom.sources import trade
from tallyloom.sources.registry import read_source


def test_landed_lists_are_few(spark, tmp_path):
    rows = spark.createDataFrame([(str(k), *ROWS["products"][0][1:]) for k in range(600)], RAW["products"])
    landed_queries._json_lists(rows, f"{tmp_path}/lists", "product_id", landed_queries.LIST_SPAN)
    assert len(list(tmp_path.glob("lists/part-*"))) == 1
    back = read_source(spark, "products", "json", f"{tmp_path}/lists")
    assert sorted(int(r[0]) for r in back.select("product_id").collect()) == list(range(600))


class Stopped(Exception):
    pass


def test_issues_are_found_once_and_loaded_twice(spark, sources, monkeypatch):
    def load(spark, folder, issues, clean):
        raise Stopped(issues.inputFiles())

    class Given(dict):
        def without_flaws(self):
            return self

    frames = Given(sources) | {}
    monkeypatch.setattr(landed_queries, "trade_sources", lambda *args, **kwargs: Given(frames))
    monkeypatch.setattr(landed_queries, "_first_load", load)
    try:
        landed_queries.loaded_issues(spark, "nowhere")
    except Stopped as stopped:
        files = stopped.args[0]
    assert files and all("/issues-" in f for f in files)
    assert spark.read.parquet(*files).count() == validation.issues_of(validation.check_sources(sources)).count()


def test_tiers_are_looked_up_once(spark, monkeypatch):
    seen = []
    orders = "order_id string, customer_id string, product_id string, order_date date, unit_price double"
    rows = "SELECT '1-1', '7', '3', DATE '2000-02-03', 5.0"
    frame = spark.sql(rows).toDF(*(c.split()[0] for c in orders.split(", ")))
    history = "customer_id string, tier string, valid_from date, valid_to date, opens boolean, row_hash string"
    monkeypatch.setattr(timeline_queries, "_clean_orders", lambda spark, folder: frame)
    monkeypatch.setattr(timeline_queries, "_tier_history", lambda spark, folder: spark.createDataFrame([], history))
    joined = timeline_queries.as_of_join

    def as_of_join(left, *args):
        seen.append(left.inputFiles())
        return joined(left, *args)

    monkeypatch.setattr(timeline_queries, "as_of_join", as_of_join)
    found = timeline_queries.facts_as_of(spark, "nowhere")
    assert all("/tiered-" in f for f in seen[1]) and seen[1]
    assert [r[0] for r in found.select("order_id").collect()] == ["1-1"]


def test_loads_read_products_written_once(spark, tmp_path):
    """Suppliers of products are looked up in all lines once, not by each load."""
    folder = str(tmp_path)
    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame([(1, 5, 9, 1, 1.0, 2.0, 0.0, 0.0, "N", "O", None), (2, 5, 8, 1, 1.0, 2.0, 0.0, 0.0, "N", "O", None)], lines).write.parquet(f"{folder}/lineitem.parquet")
    parts = "p_partkey long, p_name string, p_type string, p_size int, p_brand string, p_retailprice double"
    spark.createDataFrame([(5, "n", "t", 3, "b", 7.5), (None, "n", "t", None, "b", None)], parts).write.parquet(f"{folder}/part.parquet")
    kept = landed_queries.load_sources(spark, folder)["products"]
    assert "lineitem" not in "".join(kept.inputFiles()) and kept.inputFiles()
    plain = trade.raw_products(spark, folder)
    assert kept.schema.names == plain.schema.names
    assert sorted(kept.collect(), key=str) == sorted(plain.collect(), key=str)
    assert sorted(r.supplier_id or "" for r in kept.collect()) == ["", "8"]
