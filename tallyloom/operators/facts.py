"""The sales fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import date_key, round_half_up
from tallyloom.operators.dimensions import unknown_key
from tallyloom.operators.global_order import row_index
from tallyloom.operators.ordinals import ORDINAL, source_order
from tallyloom.schemas import PERCENT, STAR


def build_fact_sales(
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    keys: str = "row_index",
    first_order_key: int = 1,
    order_keys: str = "any",
    order_parts: int | None = None,
) -> DataFrame:
    """One row per enriched order, with its dimension keys and profit margin.

    The lookups are left joins without hints: a dimension below the broadcast limit
    is broadcast, a larger one is sort-merge joined, where AQE splits the partition of
    a hot customer or product. A missing member gets key 0; a zero amount margin 0.

    With ``row_index`` keys the fact has a dense ``order_key``. By default rows are numbered
    as they are partitioned (no analysis looks at the order of the keys);
    ``order_keys="source"`` follows the source order, at the price of a range shuffle of
    the orders, in ``order_parts`` ranges at least. It comes before the lookups, which leave an order one row,
    so that they need not move the ordinal. With ``business`` keys there is no order_key.
    """
    if order_keys not in ("source", "any"):
        raise ValueError("order_keys must be 'source' or 'any'")
    customers = dim_customer.select("customer_id", "customer_key")
    products = dim_product.select("product_id", "product_key", "supplier_key", "cost_price")
    unknown = unknown_key(keys)
    columns = STAR["fact_sales"].fieldNames()
    numbered = keys != "business" and order_keys == "source"
    if numbered:
        own = [c for c in columns if c in orders.columns]
        orders = orders.select(*own, "customer_id", "product_id", "order_date", ORDINAL)
        order = [*source_order(orders), F.col("order_id").asc_nulls_first()]
        orders = row_index(orders, order, "order_key", first_order_key, order_parts, without=[ORDINAL])
    cost = F.coalesce("cost_price", F.lit(0).cast("decimal(18,2)")) * F.col("quantity").cast(
        "decimal(10,0)"
    )
    profit = (F.col("total_amount") - cost - F.col("shipping_cost")).cast("double")
    margin = round_half_up(
        F.try_divide(profit, F.col("total_amount").cast("double")) * 100, 1
    ).cast(PERCENT)
    fact = (
        orders.join(customers, "customer_id", "left")
        .join(products, "product_id", "left")
        .withColumns(
            {
                "date_key": date_key(F.col("order_date")),
                "customer_key": F.coalesce("customer_key", unknown),
                "product_key": F.coalesce("product_key", unknown),
                "supplier_key": F.coalesce("supplier_key", unknown),
                "profit_margin": F.coalesce(margin, F.lit(0).cast(PERCENT)),
            }
        )
    )
    if keys == "business":
        return fact.select(columns[1:])
    if numbered:
        return fact.select(columns)
    return row_index(fact.select(columns[1:]), None, out="order_key", start=first_order_key).select(columns)
