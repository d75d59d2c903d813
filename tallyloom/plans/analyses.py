"""The fifteen named analyses and the KPI snapshot.

Each takes a :class:`Star` and returns an uncollected DataFrame whose numbers are
BIGINT or DOUBLE. Two habits keep them cheap on a large fact table:

* The fact is aggregated by its own keys *before* it meets a dimension. The partial
  aggregation collapses each key within a map task, so a customer, product or day
  that owns a third of the sales becomes one row per task, and the join works on one
  row per key. Sums, counts, minima and maxima can be merged again afterwards.
* ``orders`` are counted as rows: order_id is unique in the fact (cleaning and the
  incremental anti-join see to that), so no distinct aggregation is needed.

Totals over a finished report of a few rows (months, weekdays, categories) are taken by
a window over these rows, so that the fact is read once. Only single-row totals are
broadcast by hint. Joins with dimensions and the calendar are left to the planner and AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions import average, ratio_pct, round_half_up
from tallyloom.operators.global_order import ntile_scores, running_total
from tallyloom.operators.star import Star
from tallyloom.params import MartParams
from tallyloom.session import stage


# Labels and limits of the reports. In each list the first match counts;
# the last label takes the rest.
RFM_TILES = 5
RFM_SEGMENTS = [
    ("Champions", "r_score >= 4 AND f_score >= 4 AND m_score >= 4"),
    ("Loyal Customers", "r_score >= 3 AND f_score >= 3"),
    ("New Customers", "r_score >= 4 AND f_score <= 2"),
    ("At Risk", "r_score <= 2 AND f_score >= 3"),
    ("Lost", "r_score <= 2 AND f_score <= 2"),
    ("Regular", None),
]
ABC_CLASSES = [("A", "cumulative_pct <= 80"), ("B", "cumulative_pct <= 95"), ("C", None)]
CHURN_STATES = [
    ("Never Purchased", "days_since_last IS NULL"),
    ("Churned", "days_since_last > 180"),
    ("At Risk", "days_since_last > 90"),
    ("Active", None),
]
DISCOUNT_TIERS = [
    ("No Discount", "discount_pct = 0"),
    ("1-5%", "discount_pct <= 5"),
    ("6-10%", "discount_pct <= 10"),
    ("11-15%", "discount_pct <= 15"),
    ("16-20%", None),
]
SHIPPING_TIERS = [
    ("Economy (< 5)", "shipping_cost < 5"),
    ("Standard (5-8)", "shipping_cost < 8"),
    ("Express (> 8)", None),
]
TOP_RANKS = 3


def _label(choices: list[tuple[str, str | None]]) -> Column:
    """The label of the first condition that holds."""
    return F.coalesce(
        *[
            F.lit(label) if condition is None else F.when(F.expr(condition), label)
            for label, condition in choices
        ]
    )


def _real(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def _count() -> Column:
    return F.count(F.lit(1))


def _returned() -> Column:
    return F.count_if(F.col("is_returned"))


def _calendar(star: Star, *columns: str) -> DataFrame:
    return star.dim_date.select("date_key", *columns)


def _report_total(column: str) -> Column:
    """Sum over all rows of a report that is already aggregated to a few rows."""
    return F.sum(column).over(W.partitionBy())


def _report_mean(column: str) -> Column:
    count = F.count(column).over(W.partitionBy())
    return average(_report_total(column), count, 2)


def _pre_aggregate(fact: DataFrame, *keys: str) -> DataFrame:
    """Mergeable measures per key: amount and its count, orders, units, returns, margin."""
    return fact.groupBy(*keys).agg(
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("amounts"),
        _count().alias("orders"),
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        F.count("quantity").alias("quantities"),
        _returned().alias("returns"),
        F.sum("profit_margin").alias("margin"),
        F.count("profit_margin").alias("margins"),
    )


def _merge(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def revenue_trends(star: Star, params: MartParams | None = None) -> DataFrame:
    """Monthly revenue, running total and growth over the previous month with sales."""
    monthly = (
        _pre_aggregate(star.fact_sales, "date_key")
        .join(_calendar(star, "year", "month", "month_name"), "date_key")
        .groupBy("year", "month", "month_name")
        .agg(*_merge("amount", "orders"))
    )
    # One row per calendar month from here on: a single partition is fine.
    order = W.orderBy("year", "month")
    previous = F.lag("amount").over(order)
    return (
        monthly.withColumn("previous", previous)
        .withColumn("running", F.sum("amount").over(order))
        .orderBy("year", "month")
        .select(
            F.col("year").cast("bigint").alias("year"),
            F.col("month").cast("bigint").alias("month"),
            "month_name",
            _real("amount").alias("revenue"),
            "orders",
            _real("running").alias("cumulative_revenue"),
            _real("previous").alias("prev_month_revenue"),
            round_half_up(
                ratio_pct(F.col("amount") - F.col("previous"), F.col("previous")), 1
            ).alias("mom_growth_pct"),
        )
    )


def seasonal_index(star: Star, params: MartParams | None = None) -> DataFrame:
    """Revenue per calendar month over all years against the mean month."""
    monthly = (
        _pre_aggregate(star.fact_sales, "date_key")
        .join(_calendar(star, "month", "month_name"), "date_key")
        .groupBy("month", "month_name")
        .agg(*_merge("amount"))
    )
    return (
        monthly.withColumn("mean", _report_mean("amount"))
        .orderBy("month")
        .select(
            F.col("month").cast("bigint").alias("month"),
            "month_name",
            _real("amount").alias("revenue"),
            F.col("mean").alias("avg_monthly_revenue"),
            round_half_up(F.try_divide(_real("amount"), F.col("mean")) * 100, 1).alias(
                "seasonal_index"
            ),
        )
    )


def _customer_activity(star: Star, calendar_join: str) -> DataFrame:
    """Per customer key: orders, amounts, first and last purchase date."""
    return (
        star.fact_sales.join(_calendar(star, "full_date"), "date_key", calendar_join)
        .groupBy("customer_key")
        .agg(
            _count().alias("total_orders"),
            F.sum("total_amount").alias("amount"),
            F.count("total_amount").alias("amounts"),
            F.min("full_date").alias("first_purchase"),
            F.max("full_date").alias("last_purchase"),
        )
    )


def rfm_segmentation(star: Star, params: MartParams | None = None) -> DataFrame:
    """Recency, frequency and monetary quintiles per customer, and their segment.

    Ties within a quintile order are broken by customer_id.
    """
    params = params or MartParams()
    names = star.dim_customer.select("customer_key", "customer_id")
    base = _customer_activity(star, "inner").join(names, "customer_key")
    recency = F.datediff(F.lit(params.asof), F.col("last_purchase"))
    scored = ntile_scores(
        base,
        "customer_id",
        {"recency": -recency, "frequency": F.col("total_orders"), "amount": F.col("amount")},
        {"recency": "r_score", "frequency": "f_score", "amount": "m_score"},
        RFM_TILES,
    )
    return (
        scored.join(star.dim_customer.select("customer_id", "name"), "customer_id")
        .orderBy(F.desc("amount"), "customer_id")
        .select(
            "customer_id",
            "name",
            (-F.col("recency").cast("bigint")).cast("double").alias("recency_days"),
            F.col("frequency").cast("bigint").alias("frequency"),
            _real("amount").alias("monetary"),
            *[F.col(s).cast("bigint").alias(s) for s in ("r_score", "f_score", "m_score")],
            _label(RFM_SEGMENTS).alias("segment"),
        )
    )


def abc_analysis(star: Star, params: MartParams | None = None) -> DataFrame:
    """Pareto classes of products by cumulative revenue share.

    Products of equal revenue share one cumulative value, as in a RANGE frame: the
    running total is taken over distinct revenues and joined back.
    """
    products = star.dim_product.select("product_key", "product_id", "name", "category")
    base = stage(
        _pre_aggregate(star.fact_sales, "product_key")
        .select("product_key", "amount")
        .join(products, "product_key")
        .drop("product_key"),
        "product-revenue",
    )
    tiers = (
        base.filter("amount IS NOT NULL")
        .groupBy("amount")
        .agg(F.sum("amount").alias("tier_total"))
    )
    cumulative = running_total(tiers, [F.desc("amount")], "tier_total", "cumulative")
    total = base.agg(F.sum("amount").alias("total"))
    share = round_half_up(
        ratio_pct(F.coalesce("cumulative", F.col("total")), F.col("total")), 1
    )
    return (
        base.join(cumulative.select("amount", "cumulative"), "amount", "left")
        .crossJoin(F.broadcast(total))
        .withColumn("cumulative_pct", share)
        .orderBy(F.desc("amount"), "product_id")
        .select(
            "product_id",
            "name",
            "category",
            _real("amount").alias("revenue"),
            "cumulative_pct",
            _label(ABC_CLASSES).alias("abc_class"),
        )
    )


def top_products_by_category(star: Star, params: MartParams | None = None) -> DataFrame:
    """The three best revenue ranks per category; products of one name count together.

    The rank filter is planned as a group limit before the shuffle, so a category with
    most of the products does not move into one task.
    """
    revenue = (
        _pre_aggregate(star.fact_sales, "product_key")
        .join(star.dim_product.select("product_key", "category", "name"), "product_key")
        .groupBy("category", "name")
        .agg(*_merge("amount", "units"))
    )
    rank = F.dense_rank().over(W.partitionBy("category").orderBy(F.desc("amount")))
    return (
        revenue.withColumn("rank", rank)
        .filter(F.col("rank") <= TOP_RANKS)
        .orderBy("category", "rank", "name")
        .select(
            "category",
            F.col("name").alias("product_name"),
            _real("amount").alias("revenue"),
            F.col("units").alias("units_sold"),
            F.col("rank").cast("bigint").alias("rank"),
        )
    )


def yoy_category_growth(star: Star, params: MartParams | None = None) -> DataFrame:
    """Revenue per category in two given years and the growth between them."""
    before, after = (params or MartParams()).growth_years
    by_year = (
        star.fact_sales.join(_calendar(star, "year"), "date_key")
        .groupBy("product_key", "year")
        .agg(F.sum("total_amount").alias("amount"))
        .join(star.dim_product.select("product_key", "category"), "product_key")
    )

    def in_year(year: int) -> Column:
        return F.sum(F.when(F.col("year") == year, F.col("amount")))

    return (
        by_year.groupBy("category")
        .agg(in_year(before).alias("a"), in_year(after).alias("b"))
        .select(
            "category",
            _real("a").alias(f"revenue_{before}"),
            _real("b").alias(f"revenue_{after}"),
            round_half_up(ratio_pct(F.col("b") - F.col("a"), F.col("a")), 1).alias(
                "yoy_growth_pct"
            ),
        )
        .orderBy(F.desc_nulls_last("yoy_growth_pct"), "category")
    )


def cohort_retention(star: Star, params: MartParams | None = None) -> DataFrame:
    """Active customers by month of first purchase and months since then.

    The fact is first reduced to one row per customer and month, so that the window
    per customer holds no more rows than the calendar has months, and active customers
    can be counted as rows. Sales outside the calendar form a group without a month:
    they count for the first purchase only.
    """
    monthly = (
        star.fact_sales.join(_calendar(star, "year", "month"), "date_key", "left")
        .groupBy("customer_key", "year", "month")
        .agg(F.min("date_key").alias("first_in_month"))
    )
    first = F.min("first_in_month").over(W.partitionBy("customer_key"))
    start = star.dim_date.select(
        F.col("date_key").alias("first_key"),
        F.col("year").alias("first_year"),
        F.col("month").alias("first_month"),
    )
    offset = (F.col("year") - F.col("first_year")) * 12 + F.col("month") - F.col("first_month")
    return (
        monthly.withColumn("first_key", first)
        .filter("year IS NOT NULL")
        .join(start, "first_key")
        .groupBy(
            F.format_string("%d-%02d", "first_year", "first_month").alias("cohort_month"),
            offset.cast("bigint").alias("months_since_first"),
        )
        .agg(_count().alias("active_customers"))
        .orderBy("cohort_month", "months_since_first")
    )


def _ltv(star: Star) -> DataFrame:
    customers = star.dim_customer.select("customer_key", "customer_id", "name", "segment", "region")
    return (
        _customer_activity(star, "inner")
        .join(customers, "customer_key")
        .select(
            "customer_id",
            "name",
            "segment",
            "region",
            "total_orders",
            _real("amount").alias("lifetime_value"),
            average(F.col("amount"), F.col("amounts"), 2).alias("avg_order_value"),
            "first_purchase",
            "last_purchase",
            F.datediff("last_purchase", "first_purchase")
            .cast("double")
            .alias("customer_tenure_days"),
        )
    )


def customer_ltv(star: Star, params: MartParams | None = None) -> DataFrame:
    """Lifetime value of the customers with sales."""
    return _ltv(star).orderBy(F.desc("lifetime_value"), "customer_id")


def top_customers(star: Star, params: MartParams | None = None, limit: int = 20) -> DataFrame:
    """The best customers by lifetime value: a top-k, not a full sort."""
    return _ltv(star).orderBy(F.desc("lifetime_value"), "customer_id").limit(limit)


def customer_churn(star: Star, params: MartParams | None = None) -> DataFrame:
    """Activity status of every customer, including those who never bought."""
    asof = F.lit((params or MartParams()).asof)
    days = F.datediff(asof, F.col("last_purchase"))
    return (
        star.dim_customer.select("customer_key", "customer_id", "name", "segment", "region")
        .join(_customer_activity(star, "left"), "customer_key", "left")
        .select(
            "customer_id",
            "name",
            "segment",
            "region",
            F.col("last_purchase").alias("last_purchase_date"),
            F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
            _real("amount").alias("lifetime_value"),
            days.cast("bigint").alias("days_since_last"),
        )
        .withColumn("churn_status", _label(CHURN_STATES))
        .orderBy(F.desc_nulls_last("days_since_last"), "customer_id")
    )


def basket_analysis(star: Star, params: MartParams | None = None) -> DataFrame:
    """Basket size and value per customer segment and quarter."""
    dated = star.fact_sales.join(_calendar(star, "year", "quarter"), "date_key")
    return (
        _pre_aggregate(dated, "customer_key", "year", "quarter")
        .join(star.dim_customer.select("customer_key", "segment"), "customer_key")
        .groupBy("segment", "year", "quarter")
        .agg(*_merge("orders", "units", "quantities", "amount", "amounts"))
        .orderBy("segment", "year", "quarter")
        .select(
            "segment",
            F.concat("year", F.lit("-Q"), "quarter").alias("quarter"),
            "orders",
            average(F.col("units"), F.col("quantities"), 1).alias("avg_items_per_order"),
            average(F.col("amount"), F.col("amounts"), 2).alias("avg_order_value"),
            _real("amount").alias("total_revenue"),
        )
    )


def day_of_week_patterns(star: Star, params: MartParams | None = None) -> DataFrame:
    """Sales per weekday and their deviation from the mean weekday."""
    daily = (
        _pre_aggregate(star.fact_sales, "date_key")
        .join(_calendar(star, "day_name", "day_of_week"), "date_key")
        .groupBy("day_name", "day_of_week")
        .agg(*_merge("amount", "amounts", "orders"))
    )
    gap = F.try_divide(_real("amount") - F.col("mean"), F.col("mean")) * 100
    return (
        daily.withColumn("mean", _report_mean("amount"))
        .orderBy("day_of_week")
        .select(
            "day_name",
            F.col("day_of_week").cast("bigint").alias("day_of_week"),
            F.col("orders").alias("total_orders"),
            _real("amount").alias("total_revenue"),
            average(F.col("amount"), F.col("amounts"), 2).alias("avg_order_value"),
            round_half_up(gap, 1).alias("pct_vs_avg"),
        )
    )


def discount_impact(star: Star, params: MartParams | None = None) -> DataFrame:
    """Orders, value and margin per discount tier; the last tier takes the rest."""
    return (
        star.fact_sales.groupBy(_label(DISCOUNT_TIERS).alias("discount_tier"))
        .agg(
            _count().alias("orders"),
            F.sum("total_amount").alias("amount"),
            F.count("total_amount").alias("amounts"),
            F.sum("profit_margin").alias("margin"),
            F.count("profit_margin").alias("margins"),
            F.min("discount_pct").alias("lowest"),
        )
        .orderBy("lowest")
        .select(
            "discount_tier",
            "orders",
            average(F.col("amount"), F.col("amounts"), 2).alias("avg_order_value"),
            average(F.col("margin"), F.col("margins"), 1).alias("avg_margin_pct"),
            _real("amount").alias("total_revenue"),
        )
    )


def shipping_efficiency(star: Star, params: MartParams | None = None) -> DataFrame:
    """Shipping cost against order value per cost tier, for orders with a cost."""
    return (
        star.fact_sales.filter("shipping_cost > 0")
        .groupBy(_label(SHIPPING_TIERS).alias("shipping_tier"))
        .agg(
            _count().alias("orders"),
            F.sum("shipping_cost").alias("cost"),
            F.sum("total_amount").alias("amount"),
            F.count("total_amount").alias("amounts"),
        )
        .select(
            "shipping_tier",
            "orders",
            average(F.col("cost"), F.col("orders"), 2).alias("avg_shipping_cost"),
            average(F.col("amount"), F.col("amounts"), 2).alias("avg_order_value"),
            round_half_up(ratio_pct(F.col("cost"), F.col("amount")), 1).alias("shipping_pct"),
        )
        .orderBy("avg_shipping_cost")
    )


def return_rate_analysis(star: Star, params: MartParams | None = None) -> DataFrame:
    """Return rate per category against the rate of all facts, unknown products included.

    The left join keeps the facts of unknown products in a group of their own until the
    company rate is taken.
    """
    products = star.dim_product.select("product_key", "category", F.lit(True).alias("known"))
    rate = ratio_pct(F.col("returns"), F.col("orders"))
    company = ratio_pct(_report_total("returns"), _report_total("orders"))
    return (
        star.fact_sales.groupBy("product_key")
        .agg(_count().alias("orders"), _returned().alias("returns"))
        .join(products, "product_key", "left")
        .groupBy("known", "category")
        .agg(*_merge("orders", "returns"))
        .withColumn("company_rate", company)
        .filter("known")
        .select(
            "category",
            F.col("orders").alias("total_orders"),
            "returns",
            round_half_up(rate, 1).alias("return_rate_pct"),
            round_half_up(F.col("company_rate"), 1).alias("company_avg_pct"),
            round_half_up(rate - F.col("company_rate"), 1).alias("vs_avg"),
        )
        .orderBy(F.desc("return_rate_pct"), "category")
    )


def supplier_scorecard(star: Star, params: MartParams | None = None) -> DataFrame:
    """Revenue, margin and return rate per supplier."""
    suppliers = star.dim_supplier.select(
        "supplier_key", "supplier_id", "name", "country", "reliability_rating"
    )
    return (
        _pre_aggregate(star.fact_sales, "supplier_key")
        .join(suppliers, "supplier_key")
        .orderBy(F.desc("amount"), "supplier_id")
        .select(
            "supplier_id",
            F.col("name").alias("supplier_name"),
            "country",
            "reliability_rating",
            F.col("orders").alias("total_orders"),
            _real("amount").alias("total_revenue"),
            average(F.col("margin"), F.col("margins"), 1).alias("avg_margin"),
            round_half_up(ratio_pct(F.col("returns"), F.col("orders")), 1).alias(
                "return_rate_pct"
            ),
        )
    )


def kpi_snapshot(star: Star, params: MartParams | None = None) -> DataFrame:
    """Five headline figures over all facts; unknown customers count as one.

    Grouping by customer first makes the distinct count a row count.
    """
    return (
        _pre_aggregate(star.fact_sales, "customer_key")
        .agg(*_merge("amount", "amounts", "orders", "returns"), _count().alias("customers"))
        .select(
            _real("amount").alias("total_revenue"),
            F.coalesce("orders", F.lit(0)).alias("total_orders"),
            average(F.col("amount"), F.col("amounts"), 2).alias("avg_order_value"),
            F.col("customers").alias("unique_customers"),
            round_half_up(ratio_pct(F.col("returns"), F.col("orders")), 1).alias("return_rate"),
        )
    )


def daily_sales(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The daily aggregate table.

    Grouping by day and customer first splits a hot day over many tasks and makes the
    number of customers a row count.
    """
    calendar = dim_date.select("date_key", "full_date")
    return (
        _pre_aggregate(fact_sales, "date_key", "customer_key")
        .groupBy("date_key")
        .agg(*_merge("amount", "amounts", "orders"), _count().alias("customers"))
        .join(calendar, "date_key")
        .select(
            F.col("full_date").alias("date"),
            F.col("amount").alias("total_revenue"),
            F.col("orders").alias("total_orders"),
            average(F.col("amount"), F.col("amounts"), 2).alias("avg_order_value"),
            F.col("customers").alias("unique_customers"),
        )
    )
