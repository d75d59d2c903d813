"""Daily sketches of customers and order values, merged to any longer period.

Distinct customers and quantiles can't be added up from daily numbers. Sketches can: each day
stores one of some kilobytes, and a month or year is the union of its days', without a look at the
facts. Estimates have stated errors, so exact figures are for reports that need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relative standard error of distinct counts: 1.04 / sqrt(2^12) = 1.6 %.
HLL_BITS = 12
#: Rank error of quantiles below 1 % with 99 % confidence.
KLL_K = 400


def daily_sketches(fact: DataFrame, day: str = "date_key") -> DataFrame:
    """One row per day: orders, a sketch of its customers and one of its order values."""
    return fact.groupBy(day).agg(
        F.count(F.lit(1)).alias("orders"),
        F.hll_sketch_agg("customer_key", HLL_BITS).alias("customers"),
        F.kll_sketch_agg_double(F.col("total_amount").cast("double"), KLL_K).alias("amounts"),
    )


def merged(sketches: DataFrame, *period: Column) -> DataFrame:
    """The sketches of longer periods; they may be merged again."""
    return sketches.groupBy(*period).agg(
        F.sum("orders").alias("orders"),
        F.hll_union_agg("customers").alias("customers"),
        F.kll_merge_agg_double("amounts", KLL_K).alias("amounts"),
    )


def estimates(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """Estimated distinct customers, and order values at some ranks, in the place of the sketches."""
    values = F.array(*(F.kll_sketch_get_quantile_double("amounts", F.lit(q)) for q in quantiles))
    return sketches.withColumns(
        {"unique_customers": F.hll_sketch_estimate("customers"), "amount_quantiles": values}
    ).drop("customers", "amounts")
