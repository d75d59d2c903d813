"""Quality rules as column predicates.

A rule is a predicate that is true for a bad value. All rules of a source compile to
one array column, so a source is checked in a single narrow pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.ordinals import data_columns

ISSUE_TYPE = "array<struct<field:string,value:string,rule:string,message:string>>"


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a bad row; ``shown`` is the reported value."""

    field: str
    name: str
    message: str
    broken: Callable[[], Column]
    shown: Callable[[], Column]
    needs: tuple[str, ...]


def _rule(field: str, name: str, message: str, broken, shown=None, needs=None) -> Rule:
    return Rule(
        field,
        name,
        message,
        broken,
        shown or (lambda: F.col(field).cast("string")),
        needs or (field,),
    )


def _not_positive(field: str, label: str) -> Rule:
    return _rule(field, "positive_value", f"{label} must be positive", lambda: F.col(field) <= 0)


# The rules every load runs, per source. Rule names and messages.
PIPELINE_RULES: dict[str, list[Rule]] = {
    "orders": [
        _not_positive("quantity", "Quantity"),
        _not_positive("unit_price", "Unit price"),
        _rule(
            "discount_pct",
            "range_check",
            "Discount must be between 0 and 100",
            lambda: ~F.col("discount_pct").between(0, 100),
        ),
    ],
    "products": [
        _rule(
            "retail_price",
            "business_rule",
            "Cost price exceeds retail price",
            lambda: F.col("cost_price") > F.col("retail_price"),
            lambda: F.concat(
                F.lit("cost="),
                F.col("cost_price").cast("string"),
                F.lit(", retail="),
                F.col("retail_price").cast("string"),
            ),
            ("cost_price", "retail_price"),
        ),
    ],
}


def _one_of(field: str, *values: str) -> Rule:
    return _rule(
        field,
        "domain",
        f"{field} must be one of: {', '.join(values)}",
        lambda: ~F.col(field).isin(*values),
    )


def _at_least_zero(field: str) -> Rule:
    return _rule(field, "range_check", f"{field} must not be negative", lambda: F.col(field) < 0)


def _a_date(field: str) -> Rule:
    return _rule(
        field,
        "type",
        f"{field} must be a date",
        lambda: F.col(field).isNotNull() & F.try_to_date(F.col(field).cast("string")).isNull(),
    )


# Opt-in rules: the declared constraints of a record, with fixed limits and domains.
# Required fields are covered by the not_null rule.
DECLARED_RULES: dict[str, list[Rule]] = {
    "orders": [
        _one_of("status", "completed", "cancelled", "pending"),
        _a_date("order_date"),
    ],
    "customers": [_one_of("segment", "B2B", "B2C"), _a_date("signup_date")],
    "products": [
        _not_positive("cost_price", "Cost price"),
        _not_positive("retail_price", "Retail price"),
    ],
    "suppliers": [
        _not_positive("lead_time_days", "Lead time"),
        _rule(
            "reliability_rating",
            "range_check",
            "Reliability rating must be between 1 and 5",
            lambda: ~F.col("reliability_rating").between(1, 5),
        ),
    ],
    "returns": [_a_date("return_date")],
    "shipping": [
        _at_least_zero("shipping_cost"),
        _a_date("shipped_date"),
        _a_date("delivered_date"),
    ],
}


def _not_null(df: DataFrame, field: str) -> Rule:
    absent = F.col(field).isNull()
    if isinstance(df.schema[field].dataType, (T.DoubleType, T.FloatType)):
        absent = absent | F.isnan(field)
    return _rule(
        field,
        "not_null",
        f"Missing required field: {field}",
        lambda: absent,
        lambda: F.lit("NULL"),
    )


def issue(field: str, value: Column, rule: str, message: str) -> Column:
    return F.struct(
        F.lit(field).alias("field"),
        value.alias("value"),
        F.lit(rule).alias("rule"),
        F.lit(message).alias("message"),
    )


def compile_rules(
    df: DataFrame, source: str, declared: bool = False, extra: list[Rule] | None = None
) -> Column:
    """The array of issues of one row of ``source``.

    The not_null rule covers every column of every source. Other rules apply only if
    their columns are there, and a NULL never breaks them.
    """
    columns = data_columns(df)
    rules = [_not_null(df, c) for c in columns]
    rules += PIPELINE_RULES.get(source, [])
    if declared:
        rules += DECLARED_RULES.get(source, [])
    rules += extra or []
    checks = [
        F.when(r.broken(), issue(r.field, r.shown(), r.name, r.message))
        for r in rules
        if all(n in columns for n in r.needs)
    ]
    if not checks:
        return F.array().cast(ISSUE_TYPE)
    return F.array_compact(F.array(*checks)).cast(ISSUE_TYPE)
