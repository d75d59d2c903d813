"""Validation of the raw sources: issues, scores and quarantine.

Each source becomes one frame with its rows and two issue arrays: ``_row_issues``
(rules on the row itself and uniqueness) and ``_link_issues`` (references to other
sources). Issues, scores and the quarantine split are all read from these arrays, so
no rule costs an extra join on row numbers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import round_half_up
from tallyloom.operators.ordinals import ORDINAL, with_ordinal, with_row_index
from tallyloom.operators.rules import ISSUE_TYPE, compile_rules, issue
from tallyloom.session import stage

_ROW, _LINK = "_row_issues", "_link_issues"


def _no_issues():
    return F.array().cast(ISSUE_TYPE)


def _repeated(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with the ordinal of their first row."""
    repeated = (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(ORDINAL).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .select("_key", "_first")
    )
    return stage(repeated, "repeated")


def _missing(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``child`` without a row in ``parent``.

    Reduced to distinct keys before the shuffle, so a hot key costs nothing. Staged,
    because the planner then knows how small the result is and need not shuffle the
    child to flag its rows.
    """
    keys = child.select(F.col(key).alias("_key")).filter("_key IS NOT NULL").distinct()
    known = parent.select(F.col(key).alias("_key"))
    return stage(keys.join(known, "_key", "left_anti"), "missing")


def _flag(df: DataFrame, marked: DataFrame, key: str, broken, found) -> DataFrame:
    """Append the issue ``found`` to rows whose key is in ``marked`` (left join)."""
    column = found[0]
    return (
        df.join(marked, F.col(key) == F.col("_key"), "left")
        .withColumn(
            column,
            F.when(broken, F.concat(column, F.array(found[1]).cast(ISSUE_TYPE))).otherwise(
                F.col(column)
            ),
        )
        .drop(*marked.columns)
    )


def check_sources(
    sources: dict[str, DataFrame], declared: bool = False, extra_rules: dict | None = None
) -> dict[str, DataFrame]:
    """Every source with its issue arrays."""
    sources = {name: with_ordinal(df) for name, df in sources.items()}
    checked = {
        name: df.withColumn(
            _ROW, compile_rules(df, name, declared, (extra_rules or {}).get(name))
        ).withColumn(_LINK, _no_issues())
        for name, df in sources.items()
    }
    # Fixed values below: rule names and messages.
    text = F.col("_key").cast("string")
    if "customers" in sources and "customer_id" in sources["customers"].columns:
        checked["customers"] = _flag(
            checked["customers"],
            _repeated(sources["customers"], "customer_id"),
            "customer_id",
            F.col(ORDINAL) > F.col("_first"),
            (_ROW, issue("customer_id", text, "unique", "Duplicate customer_id")),
        )
    if "orders" in sources and "customers" in sources:
        links = [("customers", "customer_id", "Customer ID not found in customers table")]
        if "products" in sources:
            # An empty product list switches its check off; an empty customer list
            # does not: every order is then reported.
            if not sources["products"].filter("product_id IS NOT NULL").isEmpty():
                links.append(("products", "product_id", "Product ID not found in products table"))
        for parent, key, message in links:
            checked["orders"] = _flag(
                checked["orders"],
                _missing(sources["orders"], sources[parent], key),
                key,
                F.col("_key").isNotNull(),
                (_LINK, issue(key, text, "referential_integrity", message)),
            )
    return checked


def issues_of(checked: dict[str, DataFrame], indexed: bool = True) -> DataFrame:
    """All issues in long form: source, row_index, field, value, rule, message.

    ``indexed=False`` leaves the row position out.
    """
    frames = []
    for name, df in checked.items():
        rows = df.select(ORDINAL, F.concat(_ROW, _LINK).alias("_issues"))
        bad = F.size("_issues") > 0
        if indexed:
            rows = with_row_index(rows, bad)
        else:
            rows = rows.filter(bad)
        index = ["row_index"] if indexed else []
        frames.append(
            rows.select(F.lit(name).alias("source"), *index, F.inline("_issues"))
        )
    return reduce(DataFrame.unionByName, frames)


def _score(valid, total):
    return F.coalesce(
        round_half_up(F.try_divide(valid.cast("double"), total.cast("double")) * 100, 1),
        F.lit(100.0),
    )


def summarise(checked: dict[str, DataFrame], penalty: str = "per_issue") -> DataFrame:
    """Totals and score per source, in one pass per source.

    With ``per_issue`` every broken reference counts as one invalid row on top of the
    rows that break another rule, so a row may count twice and a score may fall below
    0; ``distinct_rows`` counts a row once.
    """
    row_bad, link_bad = F.size(_ROW) > 0, F.size(_LINK) > 0
    if penalty == "per_issue":
        invalid = F.when(row_bad, 1).otherwise(0) + F.size(_LINK)
    elif penalty == "distinct_rows":
        invalid = F.when(row_bad | link_bad, 1).otherwise(0)
    else:
        raise ValueError("penalty must be 'per_issue' or 'distinct_rows'")
    frames = [
        df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.coalesce(F.sum(invalid), F.lit(0)).alias("invalid_rows"),
        ).select(
            F.lit(name).alias("source_name"),
            "total_rows",
            (F.col("total_rows") - F.col("invalid_rows")).alias("valid_rows"),
            "invalid_rows",
            _score(F.col("total_rows") - F.col("invalid_rows"), F.col("total_rows")).alias(
                "quality_score"
            ),
        )
        for name, df in checked.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def overall(summary: DataFrame) -> DataFrame:
    """Mean of the source scores (not weighted by rows) and total invalid rows."""
    tenths = F.sum(F.round(F.col("quality_score") * 10).cast("bigint"))
    return summary.agg(
        F.coalesce(
            round_half_up(F.try_divide(tenths.cast("double"), F.count(F.lit(1)) * 10.0), 1),
            F.lit(100.0),
        ).alias("overall_score"),
        F.coalesce(F.sum("invalid_rows"), F.lit(0)).alias("total_quarantined"),
    )


def split_quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows with at least one issue) of one checked source."""
    clean = (F.size(_ROW) == 0) & (F.size(_LINK) == 0)
    plain = checked.drop(_ROW, _LINK)
    return (
        checked.filter(clean).select(plain.columns),
        checked.filter(~clean).select(plain.columns),
    )


def issues_by_source(issues: DataFrame) -> DataFrame:
    return issues.groupBy("source").agg(F.count(F.lit(1)).alias("issues"))


def warehouse_score(issues: DataFrame, fact_sales: DataFrame) -> DataFrame:
    """Score of the loaded warehouse: issues against rows loaded plus issues."""
    found = issues.agg(F.count(F.lit(1)).alias("total_issues"))
    loaded = fact_sales.agg(F.count(F.lit(1)).alias("rows_loaded"))
    share = F.col("total_issues").cast("double") / F.greatest(
        F.col("rows_loaded") + F.col("total_issues"), F.lit(1)
    )
    return found.crossJoin(F.broadcast(loaded)).select(
        round_half_up((F.lit(1.0) - share) * 100, 1).alias("quality_score"),
        "total_issues",
        "rows_loaded",
    )


def issue_sample(issues: DataFrame, limit: int = 50) -> DataFrame:
    """The first issues by source and row."""
    return (
        issues.orderBy("source", "row_index", "field", "rule")
        .limit(limit)
        .select("source", "field", "rule", "message", "value")
    )
