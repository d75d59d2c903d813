"""The star schema as a set of DataFrames, built from cleaned sources."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from tallyloom.operators.cleaning import clean_all
from tallyloom.operators.dimensions import (
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    build_dim_supplier,
)
from tallyloom.operators.enrichment import enrich_orders, enrich_products
from tallyloom.operators.facts import build_fact_sales
from tallyloom.params import MartParams


@dataclass
class Star:
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_supplier: DataFrame
    dim_product: DataFrame
    fact_sales: DataFrame

    # Of a star that was read from a warehouse, or built on such tables: not fields. The latter holds
    # changed members only; ``known`` is what it was built on, ``members`` counts those looked at.
    # ``batches`` are the folders of a star that was read, by table.
    version = None
    batches = None
    top_order_key = None
    known = None
    members = None

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def enrich_all(clean: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Cleaned sources with enriched orders and products."""
    return {
        **clean,
        "orders": enrich_orders(clean["orders"], clean["returns"], clean["shipping"]),
        "products": enrich_products(clean["products"]),
    }


def star_of(
    sources: dict[str, DataFrame], params: MartParams | None = None, bad_dates: str = "raise"
) -> Star:
    """A lazy star straight from raw sources.

    Business keys serve as dimension keys, so nothing has to be numbered and the
    whole star stays one lazy plan: a query on it reads and shuffles only what it
    needs. A warehouse load numbers the members instead (:mod:`tallyloom.sinks`).
    """
    params = params or MartParams()
    ready = enrich_all(clean_all(sources, bad_dates))
    spark = ready["orders"].sparkSession
    dim_customer = build_dim_customer(ready["customers"], keys="business")
    dim_supplier = build_dim_supplier(ready["suppliers"], keys="business")
    dim_product = build_dim_product(ready["products"], dim_supplier, keys="business")
    return Star(
        dim_date=build_dim_date(spark, params.date_start, params.date_end),
        dim_customer=dim_customer,
        dim_supplier=dim_supplier,
        dim_product=dim_product,
        fact_sales=build_fact_sales(ready["orders"], dim_customer, dim_product, keys="business"),
    )
