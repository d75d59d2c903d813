"""Derived columns of orders and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import money, round_half_up
from tallyloom.operators.dealt import dealt_by, look_up
from tallyloom.operators.dedup import keep_last
from tallyloom.operators.ordinals import DEALT, with_ordinal
from tallyloom.schemas import PERCENT


def order_amount() -> Column:
    """quantity * unit_price * (1 - discount_pct / 100), rounded to 2 places.

    Kept in DECIMAL: the product has at most 6 decimals and is exact; rounding it to
    whole hundredths before scaling down avoids rounding twice.
    """
    gross = F.col("quantity").cast("decimal(10,0)") * money(F.col("unit_price"))
    hundredfold = gross * (F.lit(100).cast("decimal(3,0)") - F.col("discount_pct").cast("decimal(9,4)"))
    return money(F.round(hundredfold, 0) * F.lit(0.01).cast("decimal(3,2)"))


def enrich_orders(orders: DataFrame, returns: DataFrame, shipping: DataFrame) -> DataFrame:
    """Add total_amount, is_returned and shipping_cost.

    All three inputs are hashed by order_id, on which the cleaned orders already are
    partitioned, so orders are not shuffled again. If all three are ``_dealt`` alike, they
    meet by that and none is shuffled. The lookups are reduced to one row
    per order before their shuffle, which also takes care of hot order ids. An order
    without a return or event gets FALSE and 0; of several events the last one by
    source order counts.
    """
    dealt = dealt_by(orders, returns, shipping)
    keys = [*dealt, "order_id"]
    returned = (
        returns.select(*keys)
        .filter(F.col("order_id").isNotNull())
        .distinct()
        .withColumn("_returned", F.lit(True))
    )
    last_cost = keep_last(
        with_ordinal(shipping).filter(F.col("order_id").isNotNull()), keys
    ).select(*keys, F.col("shipping_cost").alias("_cost"))
    if dealt:
        known = look_up(orders, "order_id", returned, last_cost)
    else:
        known = orders.join(returned, "order_id", "left").join(last_cost, "order_id", "left")
    return (
        known.withColumns(
            {
                "total_amount": order_amount(),
                "is_returned": F.coalesce("_returned", F.lit(False)),
                "shipping_cost": money(F.coalesce("_cost", F.lit(0).cast("decimal(18,2)"))),
            }
        )
        .drop("_returned", "_cost", DEALT)
    )


def enrich_products(products: DataFrame) -> DataFrame:
    """Add margin_pct; NULL where the retail price is 0."""
    margin = F.try_divide(
        (F.col("retail_price") - F.col("cost_price")).cast("double"),
        F.col("retail_price").cast("double"),
    )
    return products.withColumn("margin_pct", round_half_up(margin * 100, 1).cast(PERCENT))
