"""Raw sources derived from TPC-H-like trade tables.

Maps ``lineitem, orders, part, supplier, customer, nation, region`` to the six raw
sources, so that the whole chain runs on such tables. An order line becomes an
order; the pair (order key, line number) is not unique in these tables, which puts
de-duplication to work, so the ordinal is a total order over the line's attributes.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.dealt import buckets_for, dealing
from tallyloom.operators.ordinals import DEALT, HOME, ORDINAL
from tallyloom.params import MartParams
from tallyloom.session import staging_root
from tallyloom.sinks.bucketed import save_bucketed

TRADE_PARAMS = MartParams(
    date_start=date(1995, 1, 1),
    date_end=date(2001, 12, 31),
    asof=date(2001, 8, 2),
    growth_years=(1999, 2000),
)

# Line attributes in the order that decides which copy is first.
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


_schemas: dict[str, T.StructType] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A trade table; its schema is looked up in the files only once."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def dealt_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Lines and orders in the same hash buckets by order key, for jobs that read them several times.

    Written once. Orders, returns and events taken from them then meet bucket by bucket, without an
    exchange of any. A line without order key is dealt by its number, which its order id consists of then.
    The number of buckets follows the number of lines, which the file footers tell.
    """
    lines = _table(spark, folder, "lineitem")
    buckets = buckets_for(spark, lines.count())
    name = f"trade_{uuid.uuid4().hex}"
    home = F.coalesce("l_orderkey", F.col("l_linenumber").cast("bigint"))
    lines = lines.select("*", dealing(home, buckets))
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return {
        "lineitem": save_bucketed(lines, f"{name}_lineitem", DEALT, buckets),
        "orders": save_bucketed(orders, f"{name}_orders", "o_orderkey", buckets),
    }


def _dealt(lines: DataFrame) -> list[str]:
    return [DEALT] if DEALT in lines.columns else []


def _order_id():
    return F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))


def _line_ordinal(*more: str):
    return F.struct(*LINE_ORDER, *more).alias(ORDINAL)


def raw_orders(
    spark: SparkSession, folder: str, dirty: bool = False, dealt: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One order per line; ``dirty`` plants rule violations by order key.

    The join deals the lines by order key, which is the first part of the order id, unless they are
    ``dealt`` (:func:`dealt_tables`).
    """
    tables = dealt or {n: _table(spark, folder, n) for n in ("lineitem", "orders")}
    key = DEALT if dealt else "l_orderkey"
    lines = tables["lineitem"].filter("l_orderkey IS NOT NULL").join(
        tables["orders"], F.col(key) == F.col("o_orderkey")
    )
    quantity = F.col("l_quantity").cast("int")
    price = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100
    discount = F.round(F.col("l_discount") * 100).cast("double")
    customer, product = F.col("o_custkey"), F.col("l_partkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("cancelled")
    )
    if dirty:
        def every(n: int):
            return F.col("l_orderkey") % n == 0

        quantity = F.when(every(97), -quantity).otherwise(quantity)
        price = F.when(every(101), None).when(every(127), -price).otherwise(price)
        discount = F.when(every(103), F.lit(150.0)).otherwise(discount)
        customer = F.when(every(107), customer + 1_000_000_000).otherwise(customer)
        product = F.when(every(109), product + 1_000_000_000).otherwise(product)
        status = F.when(~every(113), status)
    return lines.select(
        _order_id().alias("order_id"),
        customer.cast("string").alias("customer_id"),
        product.cast("string").alias("product_id"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        discount.alias("discount_pct"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        status.alias("status"),
        _line_ordinal("l_orderkey", "l_linenumber"),
        F.col(key).alias(DEALT if dealt else HOME),
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    places = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        _table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias(
                "email"
            ),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("segment"),
            F.date_add(F.lit(date(1995, 1, 1)), (F.col("c_custkey") % 365).cast("int")).alias(
                "signup_date"
            ),
            F.struct("c_custkey").alias(ORDINAL),
        )
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = (
        _table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("supp"))
    )
    retail = F.col("p_retailprice").cast("decimal(18,2)")
    cost_share = ((F.lit(40) + F.col("p_size") % 5 * 10) * F.lit(0.01).cast("decimal(3,2)"))
    return (
        _table(spark, folder, "part")
        .join(suppliers, F.col("p_partkey") == F.col("l_partkey"), "left")
        .select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_size").cast("string").alias("subcategory"),
            F.col("p_brand").alias("brand"),
            F.col("supp").cast("string").alias("supplier_id"),
            F.round(retail * cost_share, 2).cast("double").alias("cost_price"),
            F.col("p_retailprice").alias("retail_price"),
            F.struct("p_partkey").alias(ORDINAL),
        )
    )


def raw_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "supplier")
        .join(_table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("supplier_id"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("country"),
            (F.col("s_suppkey") % 28 + 3).cast("int").alias("lead_time_days"),
            ((F.col("s_suppkey") % 26 + 25) / 10).alias("reliability_rating"),
            F.struct("s_suppkey").alias(ORDINAL),
        )
    )


def raw_returns(
    spark: SparkSession, folder: str, dealt: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Returned lines; copies of a line share a return id, so cleaning drops them."""
    lines = dealt["lineitem"] if dealt else _table(spark, folder, "lineitem")
    return (
        lines
        .filter(F.col("l_returnflag") == "R")
        .select(
            F.concat(F.lit("R"), _order_id()).alias("return_id"),
            _order_id().alias("order_id"),
            F.col("l_shipdate").cast("date").alias("return_date"),
            F.col("l_linestatus").alias("reason"),
            _line_ordinal("l_orderkey", "l_linenumber"),
            *_dealt(lines),
        )
    )


def raw_shipping(
    spark: SparkSession, folder: str, dealt: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Shipping events of taxed lines; several copies of a line give several events."""
    lines = dealt["lineitem"] if dealt else _table(spark, folder, "lineitem")
    cost = F.round(F.col("l_tax") * 100).cast("int") + F.lit(3.99).cast("decimal(18,2)")
    shipped = F.col("l_shipdate").cast("date")
    return (
        lines
        .filter(F.col("l_tax") > 0)
        .select(
            _order_id().alias("order_id"),
            F.concat(F.lit("carrier-"), F.col("l_suppkey") % 5).alias("carrier"),
            shipped.alias("shipped_date"),
            F.date_add(shipped, F.col("l_linenumber")).alias("delivered_date"),
            cost.cast("double").alias("shipping_cost"),
            _line_ordinal("l_orderkey", "l_linenumber"),
            *_dealt(lines),
        )
    )


class TradeSources(Mapping):
    """The six raw sources by name, each planned when it is first asked for.

    With ``dealt`` orders, returns and shipping events come from tables dealt by order key, which the
    first of them writes (:func:`dealt_tables`).
    """

    _PLANS = {
        "orders": raw_orders,
        "customers": raw_customers,
        "returns": raw_returns,
        "products": raw_products,
        "suppliers": raw_suppliers,
        "shipping": raw_shipping,
    }

    _DEALT = ("orders", "returns", "shipping")

    def __init__(self, spark: SparkSession, folder: str, dirty: bool = False, dealt: bool = False):
        self._spark, self._folder, self._dirty, self._deal = spark, folder, dirty, dealt
        self._planned: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] | None = None

    def without_flaws(self) -> TradeSources:
        """The sources that aren't dirty, from the same dealt tables."""
        clean = TradeSources(self._spark, self._folder, dealt=self._deal)
        clean._tables = self._tables
        return clean

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            more = {"dirty": self._dirty} if name == "orders" else {}
            if self._deal and name in self._DEALT:
                self._tables = self._tables or dealt_tables(self._spark, self._folder)
                more["dealt"] = self._tables
            self._planned[name] = self._PLANS[name](self._spark, self._folder, **more)
        return self._planned[name]

    def keep(self, name: str) -> None:
        """Write a source once, for jobs that read it several times."""
        rows, path = self[name], f"{staging_root(self._spark)}/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        self._planned[name] = self._spark.read.schema(rows.schema).parquet(path)

    def __iter__(self):
        return iter(self._PLANS)

    def __len__(self) -> int:
        return len(self._PLANS)


def trade_sources(
    spark: SparkSession, folder: str, dirty: bool = False, dealt: bool = False
) -> TradeSources:
    return TradeSources(spark, folder, dirty, dealt)
