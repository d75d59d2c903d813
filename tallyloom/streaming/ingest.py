"""Micro-batch ingest of newly arrived order files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.cleaning import clean_orders, clean_returns, clean_shipping
from tallyloom.operators.enrichment import enrich_orders
from tallyloom.operators.facts import build_fact_sales
from tallyloom.operators.star import Star
from tallyloom.plans.job import top_order_key, unseen_orders
from tallyloom.schemas import STAR
from tallyloom.session import stage, staging_scope
from tallyloom.sinks.warehouse import Warehouse
from tallyloom.sources.registry import read_source


_FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_batch(
    warehouse: Warehouse, orders: DataFrame, returns: DataFrame, shipping: DataFrame
) -> int:
    """Append the new orders of one batch to a loaded warehouse; returns their number."""
    loaded = warehouse.star()
    sources = {"orders": stage(orders, "arrived"), "returns": returns, "shipping": shipping}
    sources = unseen_orders(sources, loaded, small_batch=True)
    enriched = enrich_orders(
        clean_orders(sources["orders"]),
        clean_returns(sources["returns"]),
        clean_shipping(sources["shipping"]),
    )
    fact = build_fact_sales(
        enriched,
        loaded.dim_customer,
        loaded.dim_product,
        first_order_key=top_order_key(loaded) + 1,
    )
    spark = warehouse.spark
    unchanged = {
        name: spark.createDataFrame([], STAR[name]) for name in STAR if name != "fact_sales"
    }
    star = Star(fact_sales=fact, **unchanged)
    star.version, star.known = loaded.version, loaded
    return warehouse.load_incremental(star, facts_checked=True)


def stream_orders(
    spark: SparkSession,
    root: str,
    orders_path: str,
    checkpoint: str,
    sources: Mapping[str, DataFrame],
    kind: str = "csv",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Load all order files that have arrived since the last call, then stop.

    The stream follows the files; each batch of them is read by the same reader as any
    other source, so headers, quotes and numbers mean the same. ``sources`` gives the
    returns and shipping events. The warehouse must have been loaded before. A batch that
    is repeated after a failure adds nothing, since known order ids are left out. A batch has
    ``files_per_batch`` files at most, whose names pass the driver.
    """
    names = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_batch)
    names = names.load(orders_path)
    arriving = names.select("path")  # the contents are not read here

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # at most files_per_batch names
        if not paths:
            return
        session = batch.sparkSession
        with staging_scope(session):
            orders = read_source(session, "orders", kind, sorted(paths))
            warehouse = Warehouse(session, root)
            ingest_batch(warehouse, orders, sources["returns"], sources["shipping"])

    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
