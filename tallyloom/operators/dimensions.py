"""Dimension tables of the star schema."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import date_key
from tallyloom.operators.global_order import row_index
from tallyloom.operators.ordinals import ORDINAL, source_order, with_ordinal
from tallyloom.params import MartParams
from tallyloom.schemas import STAR
from tallyloom.session import stage

UNKNOWN_KEY = 0  # fixed value: the surrogate key of a member that is not in the dimension
UNKNOWN_ID = "(unknown)"


def build_dim_date(
    spark: SparkSession,
    start: date = MartParams.date_start,
    end: date = MartParams.date_end,
) -> DataFrame:
    """One row per day, both ends included, with ISO week and ISO day of week."""
    if end < start:
        return spark.createDataFrame([], STAR["dim_date"])
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    days = (end - start).days + 1
    first = F.lit(start.isoformat()).cast("date")
    return (
        spark.range(0, days, numPartitions=1 + days // 200_000)
        .select(F.date_add(first, F.col("id").cast("int")).alias("full_date"))
        .select(
            date_key(d).alias("date_key"),
            d,
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.weekofyear(d).alias("week"),
            iso_day.alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_name"),
            (iso_day >= 6).alias("is_weekend"),
            F.concat(F.lit("FQ"), F.quarter(d), F.lit("/"), F.year(d)).alias("fiscal_quarter"),
        )
    )


def assign_keys(
    rows: DataFrame, business_key: str, surrogate: str, known: DataFrame | None = None
) -> DataFrame:
    """Add a dense BIGINT surrogate key in source order.

    Without ``known`` keys run 1..N. With the dimension already loaded, a business key
    keeps the surrogate it has there, and new members continue after the largest one,
    so facts loaded earlier never change their meaning.
    """
    rows = with_ordinal(rows)
    order = source_order(rows)
    if known is None:
        return row_index(rows, order, out=surrogate, start=1)
    held = known.select(F.col(business_key).alias("_held"), F.col(surrogate))
    same = F.col(business_key).eqNullSafe(F.col("_held"))
    kept = rows.join(held, same, "inner").drop("_held")
    new = rows.join(held.drop(surrogate), same, "left_anti")
    top = known.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("_top"))
    new = (
        row_index(new, order, out=surrogate, start=1)
        .crossJoin(F.broadcast(top))
        .withColumn(surrogate, F.col(surrogate) + F.col("_top"))
        .drop("_top")
    )
    return kept.unionByName(new)


def changed_members(rows: DataFrame, known: DataFrame, business_key: str, surrogate: str) -> DataFrame:
    """The members of a batch that the loaded dimension lacks or has otherwise, with their keys.

    One join; what it leaves is staged, which is little or nothing for a usual increment. Loaded
    members keep their key, new ones are numbered after the largest.
    """
    kinds = {f.name: f.dataType for f in known.schema.fields if f.name != surrogate}
    rows = with_ordinal(rows).select(*(F.col(c).cast(k).alias(c) for c, k in kinds.items()), ORDINAL)
    held = known.select(*(F.col(c).alias(f"_held_{c}") for c in known.columns))
    same = F.col(business_key).eqNullSafe(F.col(f"_held_{business_key}"))
    differs = reduce(
        lambda a, b: a | b,
        (~F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in kinds if c != business_key),
        F.col(f"_held_{surrogate}").isNull(),
    )
    changed = rows.join(held, same, "left").filter(differs)
    changed = stage(changed.select(*kinds, ORDINAL, F.col(f"_held_{surrogate}").alias(surrogate)), "changed")
    new = changed.filter(F.col(surrogate).isNull()).drop(surrogate)
    if new.isEmpty():
        return changed.select(known.columns)
    top = known.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
    numbered = row_index(new, source_order(new), out=surrogate, start=top + 1)
    kept = changed.filter(F.col(surrogate).isNotNull())
    return kept.select(known.columns).unionByName(numbered.select(known.columns))


def _keyed(rows, business_key, surrogate, known, keys):
    if keys == "row_index":
        return assign_keys(rows, business_key, surrogate, known)
    if keys == "business":
        return rows.withColumn(surrogate, F.col(business_key))
    raise ValueError("keys must be 'row_index' or 'business'")


def unknown_key(keys: str):
    """Key that stands for a missing member."""
    return F.lit(UNKNOWN_KEY).cast("bigint") if keys == "row_index" else F.lit(UNKNOWN_ID)


def build_dim_customer(
    customers: DataFrame, known: DataFrame | None = None, keys: str = "row_index"
) -> DataFrame:
    keyed = _keyed(customers, "customer_id", "customer_key", known, keys)
    return keyed.select(STAR["dim_customer"].fieldNames())


def build_dim_supplier(
    suppliers: DataFrame, known: DataFrame | None = None, keys: str = "row_index"
) -> DataFrame:
    keyed = _keyed(suppliers, "supplier_id", "supplier_key", known, keys)
    return keyed.select(STAR["dim_supplier"].fieldNames())


def build_dim_product(
    products: DataFrame,
    dim_supplier: DataFrame,
    known: DataFrame | None = None,
    keys: str = "row_index",
) -> DataFrame:
    """Enriched products with the key of their supplier (unknown supplier: key 0)."""
    keyed = _keyed(products, "product_id", "product_key", known, keys)
    return with_supplier_key(keyed, dim_supplier, keys).select(STAR["dim_product"].fieldNames())


def with_supplier_key(products: DataFrame, dim_supplier: DataFrame, keys: str = "row_index") -> DataFrame:
    suppliers = dim_supplier.select("supplier_id", "supplier_key")
    return products.join(suppliers, "supplier_id", "left").withColumn(
        "supplier_key", F.coalesce("supplier_key", unknown_key(keys))
    )
