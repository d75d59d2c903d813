"""The warehouse job: extract, validate, transform, build, load, analyse."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators import merge, validation
from tallyloom.operators.cleaning import clean_all, first_orders, normalise, sellable
from tallyloom.operators.dealt import deal, dealt_by, look_up
from tallyloom.operators.dimensions import (
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    build_dim_supplier,
    changed_members,
    with_supplier_key,
)
from tallyloom.operators.facts import build_fact_sales
from tallyloom.operators.ordinals import DEALT, HOME
from tallyloom.operators.star import Star, enrich_all
from tallyloom.params import MartParams
from tallyloom.plans import analyses
from tallyloom.plans.named import available_queries, run_named
from tallyloom.plans.runs import RunLog
from tallyloom.schemas import BUSINESS_KEYS, QUALITY_ISSUES, SURROGATE_KEYS
from tallyloom.session import in_parallel, stage, staging_scope
from tallyloom.sinks.warehouse import Warehouse
from tallyloom.sources.registry import extract_all

log = logging.getLogger(__name__)

PHASES = ("extract", "validate", "transform", "build_dimensions", "load", "analyze")


@dataclass
class JobResult:
    quality: dict
    kpis: dict
    row_counts: dict[str, int] = field(default_factory=dict)
    phase_timings: dict[str, float] = field(default_factory=dict)
    duration_seconds: float = 0.0
    queries: dict[str, DataFrame] = field(default_factory=dict)
    failed_queries: dict[str, str] = field(default_factory=dict)
    new_facts: int | None = None


def of_orders(events: DataFrame, orders: DataFrame, key: str | None = None) -> DataFrame:
    """The events of some orders; with ``key`` all copies of an event one of which is of them.

    A first copy decides for all copies of a return, so these must stay together. Where both are
    dealt alike, the orders go to the events, which stay where they are.
    """
    if dealt_by(events, orders):
        wanted = deal(orders.select(DEALT, "order_id"), events).withColumn("_mine", F.lit(True))
        mine = look_up(events, "order_id", wanted)
        if key is not None:
            mine = mine.withColumn("_mine", F.max("_mine").over(W.partitionBy(DEALT, key)))
        return mine.filter("_mine").drop("_mine")
    orders = orders.select("order_id")
    mine = events.join(orders, "order_id", "left_semi")
    if key is None:
        return mine
    return events.join(mine.select(key).distinct(), key, "left_semi")


def unseen_orders(
    sources: Mapping[str, DataFrame], known: Star, small_batch: bool = False
) -> dict[str, DataFrame]:
    """The sources without the orders that the fact already holds.

    Done on the raw orders, so that known ones are not de-duplicated, enriched and joined
    only to be dropped in the end. The new orders are staged; returns and shipping events are
    cut down to theirs before anything of them is shuffled, which is a broadcast join as long
    as the new ids are below the broadcast limit.
    """
    orders = normalise(sources["orders"])
    if HOME in orders.columns:  # copies go before they are dealt anew, and each order stays with its first
        orders = first_orders(orders)
    if dealt_by(orders):
        fresh = _unseen_dealt(sellable(first_orders(orders)), known, small_batch)
    else:
        fresh = merge.new_rows(orders, known.fact_sales, "order_id", small_batch)
    fresh = stage(fresh, "new-orders")
    ids = fresh.select(*dealt_by(fresh), "order_id").filter("order_id is not null")
    return {
        **sources,
        "orders": fresh,
        "returns": of_orders(normalise(sources["returns"]), ids, "return_id"),
        "shipping": of_orders(normalise(sources["shipping"]), ids),
    }


def _unseen_dealt(orders: DataFrame, known: Star, small_batch: bool) -> DataFrame:
    """New orders of those that are dealt: ids alone are sent to the loaded ones, and new ids back."""
    ids = merge.new_rows(orders.select(DEALT, "order_id"), known.fact_sales, "order_id", small_batch)
    ids = deal(stage(ids, "new-ids"), orders).withColumn("_new", F.lit(True))
    return look_up(orders, "order_id", ids).filter("_new").drop("_new")


def build_star(
    ready: Mapping[str, DataFrame],
    params: MartParams,
    known: Star | None = None,
    order_keys: str = "any",
    order_parts: int | None = None,
) -> Star:
    """Star tables with surrogate keys from cleaned and enriched sources.

    With ``known``, the tables already loaded, the dimensions are those members that are new or
    changed; members keep their keys, lookups see loaded and new members, and order keys continue
    after the largest one. The orders are then expected to be new (:func:`unseen_orders`).
    """
    spark = ready["orders"].sparkSession
    dim_date = build_dim_date(spark, params.date_start, params.date_end)
    if known is not None:
        dimensions = _changed_dimensions(ready, known)
        return _increment_star(ready["orders"], dimensions, known, dim_date, order_keys)
    dim_supplier = build_dim_supplier(ready["suppliers"])
    dim_customer = build_dim_customer(ready["customers"])
    dim_product = build_dim_product(ready["products"], dim_supplier)
    fact_sales = build_fact_sales(
        ready["orders"], dim_customer, dim_product, order_keys=order_keys, order_parts=order_parts
    )
    return Star(dim_date, dim_customer, dim_supplier, dim_product, fact_sales)


def _changed_dimensions(ready: Mapping[str, DataFrame], known: Star) -> dict:
    """Per dimension: its changed members, the whole of it with them, and the members looked at."""

    def changed(name: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        held, key = getattr(known, name), BUSINESS_KEYS[name]
        some = changed_members(rows, held, key, SURROGATE_KEYS[name])
        return some, held if some.isEmpty() else merge.upsert(held, some, key)

    def products() -> tuple:
        supplier = changed("dim_supplier", ready["suppliers"])
        return supplier, changed("dim_product", with_supplier_key(ready["products"], supplier[1]))

    customer, (supplier, product), *counts = in_parallel(
        ready["customers"].sparkSession,
        lambda: changed("dim_customer", ready["customers"]),
        products,
        *(ready[n].count for n in ("customers", "suppliers", "products")),
    )
    names = ("dim_customer", "dim_supplier", "dim_product")
    return {n: (*d, c) for n, d, c in zip(names, (customer, supplier, product), counts, strict=True)}


def _increment_star(
    orders: DataFrame, dimensions: dict, known: Star, dim_date: DataFrame, order_keys: str
) -> Star:
    """New facts, and the members that are new or changed."""
    changed, whole = ({n: d[k] for n, d in dimensions.items()} for k in (0, 1))
    fact_sales = build_fact_sales(
        orders, whole["dim_customer"], whole["dim_product"],
        first_order_key=top_order_key(known) + 1, order_keys=order_keys,
    )
    star = Star(dim_date=dim_date, fact_sales=fact_sales, **changed)
    star.version, star.known = known.version, known
    star.members = {n: d[2] for n, d in dimensions.items()}
    return star


def increment_star(
    sources: Mapping[str, DataFrame], params: MartParams, known: Star, bad_dates: str = "raise",
    order_keys: str = "any",
) -> Star:
    """What raw sources add to a loaded star. New orders and changed members are looked for beside each other."""
    spark = sources["orders"].sparkSession
    masters = enrich_all(clean_all(sources, bad_dates))  # its orders are not used
    fresh, dimensions = in_parallel(
        spark, lambda: unseen_orders(sources, known), lambda: _changed_dimensions(masters, known)
    )
    orders = enrich_all(clean_all(fresh, bad_dates))["orders"]
    dim_date = build_dim_date(spark, params.date_start, params.date_end)
    return _increment_star(orders, dimensions, known, dim_date, order_keys)


def top_order_key(star: Star) -> int:
    """The largest order key; a star read from a warehouse has it from the manifest."""
    if star.top_order_key is not None:
        return star.top_order_key
    return star.fact_sales.agg(F.coalesce(F.max("order_key"), F.lit(0))).first()[0]


class WarehouseJob:
    """Loads a warehouse from its sources and records the run."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        data_dir: str | None = None,
        sources: Mapping[str, DataFrame] | None = None,
        mode: str = "full",
        params: MartParams | None = None,
        declared_rules: bool = False,
        bad_dates: str = "raise",
        order_keys: str = "any",
    ):
        if (data_dir is None) == (sources is None):
            raise ValueError("give either data_dir or sources")
        if mode not in ("full", "incremental"):
            raise ValueError("mode must be 'full' or 'incremental'")
        self.spark, self.mode = spark, mode
        self.params = params or MartParams()
        self.data_dir, self.sources = data_dir, sources
        self.declared_rules, self.bad_dates = declared_rules, bad_dates
        self.order_keys = order_keys
        self.warehouse = Warehouse(spark, root)
        self.run_log = RunLog(spark, root)

    def run(self) -> JobResult:
        """Run all phases. A fault of the run log never stops the job."""
        result = JobResult(quality={}, kpis={})
        started = time.monotonic()
        run_id = self._log(self.run_log.start, self.mode)
        try:
            self._execute(result)
        except Exception as exc:
            self._finish(run_id, result, status="failed", error_message=str(exc))
            raise
        result.duration_seconds = time.monotonic() - started
        self._finish(
            run_id, result, status="success", quality_score=result.quality["overall_score"]
        )
        return result

    def _finish(self, run_id: int | None, result: JobResult, **state) -> None:
        if run_id is not None:
            self._log(
                self.run_log.finish,
                run_id,
                phase_timings=result.phase_timings,
                row_counts=result.row_counts,
                **state,
            )

    def _log(self, action, *args, **kwargs):
        try:
            return action(*args, **kwargs)
        except Exception:  # noqa: BLE001 - observability must not stop a load
            log.warning("run log not written", exc_info=True)
            return None

    @contextmanager
    def _phase(self, name: str, result: JobResult):
        started = time.monotonic()
        yield
        result.phase_timings[name] = time.monotonic() - started
        log.info("%s done in %.2fs", name, result.phase_timings[name])

    def _execute(self, result: JobResult) -> None:
        with staging_scope(self.spark):
            self._extract_to_load(result)

        with self._phase("analyze", result):
            loaded = self.warehouse.star()
            result.kpis = analyses.kpi_snapshot(loaded, self.params).first().asDict()
            for name in available_queries():
                try:
                    frame = run_named(name, loaded, self.params)
                    frame.write.format("noop").mode("overwrite").save()
                    result.queries[name] = frame
                except Exception as exc:  # noqa: BLE001 - one query must not stop the rest
                    log.warning("query %s failed: %s", name, exc)
                    result.failed_queries[name] = str(exc)

    def _extract_to_load(self, result: JobResult) -> None:
        with self._phase("extract", result):
            sources = self.sources
            if sources is None:
                sources = {n: e.df for n, e in extract_all(self.spark, self.data_dir).items()}

        with self._phase("validate", result):
            checked = validation.check_sources(sources, declared=self.declared_rules)
            summary = stage(validation.summarise(checked).coalesce(1), "quality")
            # Six rows and one row.
            flawed = {}
            for row in summary.collect():
                if row["invalid_rows"]:
                    flawed[row["source_name"]] = checked[row["source_name"]]
                result.row_counts[f"raw_{row['source_name']}"] = row["total_rows"]
                result.quality[row["source_name"]] = row.asDict()
            result.quality.update(validation.overall(summary).first().asDict())
            # Sources without issues need not be read again to list them.
            if flawed:
                issues = stage(validation.issues_of(flawed), "issues")
            else:
                issues = self.spark.createDataFrame([], QUALITY_ISSUES)

        with self._phase("transform", result):
            known = None
            if self.mode == "incremental" and self.warehouse.last_load("fact_sales"):
                known = self.warehouse.star()
                # Counted before the returns are cut down to those of new orders.
                kept = clean_all(sources, self.bad_dates)["returns"].count()
            else:
                ready = enrich_all(clean := clean_all(sources, self.bad_dates))
                kept = clean["returns"].count()
            result.row_counts["clean_returns"] = kept
            result.row_counts["clean_shipping"] = result.row_counts["raw_shipping"]

        with self._phase("build_dimensions", result):
            if known is None:
                star = build_star(ready, self.params, order_keys=self.order_keys)
            else:
                star = increment_star(sources, self.params, known, self.bad_dates, self.order_keys)

        with self._phase("load", result):
            if known is not None:
                result.new_facts = self.warehouse.load_incremental(
                    star, issues, facts_checked=True
                )
                rows = {r["table_name"]: r["records_processed"]
                        for r in self.warehouse.table("load_metadata").collect()}
            else:
                rows = self.warehouse.load_full(star, issues)
            result.row_counts.update(rows)
            for source in ("customers", "products", "suppliers"):
                result.row_counts[f"clean_{source}"] = rows[f"dim_{source[:-1]}"]
            # Each cleaned order gives exactly one fact (each new one, if incremental).
            result.row_counts["clean_orders"] = rows["fact_sales"]
