"""Registry of the named analyses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tallyloom.operators.star import Star
from tallyloom.params import MartParams
from tallyloom.plans import analyses

NamedQuery = Callable[[Star, MartParams | None], DataFrame]

NAMED_QUERIES: dict[str, NamedQuery] = {
    plan.__name__: plan
    for plan in (
        analyses.abc_analysis,
        analyses.basket_analysis,
        analyses.cohort_retention,
        analyses.customer_churn,
        analyses.customer_ltv,
        analyses.day_of_week_patterns,
        analyses.discount_impact,
        analyses.return_rate_analysis,
        analyses.revenue_trends,
        analyses.rfm_segmentation,
        analyses.seasonal_index,
        analyses.shipping_efficiency,
        analyses.supplier_scorecard,
        analyses.top_products_by_category,
        analyses.yoy_category_growth,
    )
}


class UnknownQueryError(KeyError):
    """No analysis has this name."""

    def __str__(self) -> str:
        return f"Query not found: {self.args[0]}"


def available_queries() -> list[str]:
    return sorted(NAMED_QUERIES)


def run_named(name: str, star: Star, params: MartParams | None = None) -> DataFrame:
    """The uncollected result of a named analysis."""
    if name not in NAMED_QUERIES:
        raise UnknownQueryError(name)
    return NAMED_QUERIES[name](star, params)
