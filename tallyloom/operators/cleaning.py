"""Cleaning of the six raw sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import money, parse_date, strip
from tallyloom.operators.dealt import dealt_by
from tallyloom.operators.dedup import keep_first
from tallyloom.operators.ordinals import HOME
from tallyloom.schemas import DISCOUNT


def normalise(df: DataFrame) -> DataFrame:
    """Strip and lower-case column names; turn NaN into NULL."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    reals = {
        f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(reals) if reals else df


def first_orders(df: DataFrame) -> DataFrame:
    """The first copy of each order, without its home."""
    home = [HOME] if HOME in df.columns else []
    return keep_first(df, [*home, *dealt_by(df), "order_id"]).drop(HOME)


def sellable(df: DataFrame) -> DataFrame:
    """Orders that are not cancelled, with positive quantity and price."""
    return (
        df.filter(~F.col("status").eqNullSafe("cancelled"))
        .filter(F.col("quantity") > 0)
        .filter(F.col("unit_price") > 0)
    )


def clean_orders(df: DataFrame, bad_dates: str = "raise") -> DataFrame:
    """First copy of each order, not cancelled, with positive quantity and price.

    De-duplication comes first: if the first copy is cancelled, the order is gone. An
    unknown status is kept; an unknown quantity or price is not. Orders that come dealt by a
    ``_home`` are de-duplicated where they are; what is left of them is dealt by order id later.
    Those ``_dealt`` like their returns and events stay so.
    """
    df = first_orders(normalise(df).withColumn("order_date", parse_date(F.col("order_date"), bad_dates)))
    return sellable(df).withColumns(
        {
            "unit_price": money(F.col("unit_price")),
            "discount_pct": F.col("discount_pct").cast(DISCOUNT),
        }
    )


def clean_customers(df: DataFrame, bad_dates: str = "raise") -> DataFrame:
    df = normalise(df)
    df = df.withColumn("signup_date", parse_date(F.col("signup_date"), bad_dates))
    return keep_first(df, ["customer_id"]).withColumns(
        {"name": strip(F.col("name")), "email": strip(F.lower("email"))}
    )


def clean_products(df: DataFrame) -> DataFrame:
    return keep_first(normalise(df), ["product_id"]).withColumns(
        {"cost_price": money(F.col("cost_price")), "retail_price": money(F.col("retail_price"))}
    )


def clean_suppliers(df: DataFrame) -> DataFrame:
    return keep_first(normalise(df), ["supplier_id"])


def clean_returns(df: DataFrame, bad_dates: str = "raise") -> DataFrame:
    df = normalise(df)
    df = df.withColumn("return_date", parse_date(F.col("return_date"), bad_dates))
    return keep_first(df, [*dealt_by(df), "return_id"])


def clean_shipping(df: DataFrame, bad_dates: str = "raise") -> DataFrame:
    """Dates parsed; no de-duplication, since the last event of an order counts."""
    df = normalise(df)
    return df.withColumns(
        {
            "shipped_date": parse_date(F.col("shipped_date"), bad_dates),
            "delivered_date": parse_date(F.col("delivered_date"), bad_dates),
            "shipping_cost": money(F.col("shipping_cost")),
        }
    )


def clean_all(sources: dict[str, DataFrame], bad_dates: str = "raise") -> dict[str, DataFrame]:
    """All six sources, cleaned but not yet enriched."""
    return {
        "orders": clean_orders(sources["orders"], bad_dates),
        "customers": clean_customers(sources["customers"], bad_dates),
        "products": clean_products(sources["products"]),
        "suppliers": clean_suppliers(sources["suppliers"]),
        "returns": clean_returns(sources["returns"], bad_dates),
        "shipping": clean_shipping(sources["shipping"], bad_dates),
    }
