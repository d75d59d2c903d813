"""Frames behind the dashboard that are derived from the named analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.star import Star
from tallyloom.params import MartParams
from tallyloom.plans import analyses


def category_revenue(star: Star, params: MartParams | None = None) -> DataFrame:
    """Revenue per product category, largest first."""
    return (
        star.fact_sales.groupBy("product_key")
        .agg(F.sum("total_amount").alias("amount"))
        .join(star.dim_product.select("product_key", "category"), "product_key")
        .groupBy("category")
        .agg(F.sum("amount").alias("amount"))
        .orderBy(F.desc("amount"), "category")
        .select("category", F.col("amount").cast("double").alias("revenue"))
    )


def segment_counts(star: Star, params: MartParams | None = None) -> DataFrame:
    """Customers per RFM segment, largest first."""
    return (
        analyses.rfm_segmentation(star, params)
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "segment")
    )


def cohort_matrix(
    star: Star, params: MartParams | None = None, offsets: list[int] | None = None
) -> DataFrame:
    """Cohorts as rows, months since the first purchase as columns.

    Columns run over the whole calendar unless given: fixing them spares the extra
    pass that would look for the values that occur.
    """
    params = params or MartParams()
    offsets = list(range(params.calendar_months)) if offsets is None else offsets
    return (
        analyses.cohort_retention(star, params)
        .groupBy("cohort_month")
        .pivot("months_since_first", offsets)
        .agg(F.sum("active_customers"))
        .orderBy("cohort_month")
    )


def abc_class_counts(star: Star, params: MartParams | None = None) -> DataFrame:
    """Products per ABC class; a class without products shows NULL."""
    spark = star.fact_sales.sparkSession
    classes = spark.range(1).select(
        F.explode(F.array(F.lit("A"), F.lit("B"), F.lit("C"))).alias("abc_class")
    )
    counts = (
        analyses.abc_analysis(star, params)
        .groupBy("abc_class")
        .agg(F.count(F.lit(1)).alias("products"))
    )
    return classes.join(counts, "abc_class", "left").orderBy("abc_class")


def revenue_cube(star: Star, params: MartParams | None = None) -> DataFrame:
    """Revenue by category, customer segment and quarter, with all subtotals and the total.

    ``level`` is the grouping id: its bits (category 4, segment 2, quarter 1) say over which columns
    a row is a total, so a total is told apart from the members that are NULL (unknown products,
    customers, dates). The fact is summed by its own keys first; what is repeated for the
    eight grouping sets is one row per combination.
    """
    fact = star.fact_sales.groupBy("product_key", "customer_key", "date_key").agg(
        F.sum("total_amount").alias("amount"), F.count(F.lit(1)).alias("orders")
    )
    quarter = F.concat("year", F.lit("-Q"), "quarter").alias("quarter")
    by_member = (
        fact.join(star.dim_product.select("product_key", "category"), "product_key", "left")
        .join(star.dim_customer.select("customer_key", "segment"), "customer_key", "left")
        .join(star.dim_date.select("date_key", quarter), "date_key", "left")
        .groupBy("category", "segment", "quarter")
        .agg(F.sum("amount").alias("amount"), F.sum("orders").alias("orders"))
    )
    return (
        by_member.cube("category", "segment", "quarter")
        .agg(F.grouping_id().alias("level"), F.sum("amount").alias("amount"), F.sum("orders").alias("orders"))
        .select("category", "segment", "quarter", "level", F.col("amount").cast("double").alias("revenue"), "orders")
    )
