"""Benchmark: load the warehouse from raw tables, then run the analyses on it.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]`` and prints
one JSON line. ``queries`` holds first-run seconds; ``warm`` repeats the analyses in the
same session. Results are computed in full and discarded by the noop sink.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import Window as W  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallyloom.operators import validation  # noqa: E402
from tallyloom.operators.cleaning import clean_all  # noqa: E402
from tallyloom.operators.global_order import row_index  # noqa: E402
from tallyloom.operators.star import enrich_all  # noqa: E402
from tallyloom.plans import analyses, reports  # noqa: E402
from tallyloom.plans.job import build_star, increment_star  # noqa: E402
from tallyloom.plans.named import NAMED_QUERIES  # noqa: E402
from tallyloom.session import build_session, release_staged  # noqa: E402
from tallyloom.sinks.warehouse import Warehouse  # noqa: E402
from tallyloom.sources.trade import TRADE_PARAMS, trade_sources  # noqa: E402


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="bench-")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    sources = trade_sources(spark, folder)
    queries: dict[str, float] = {}

    # 99% of the orders first, then an incremental load of all of them.
    late = F.pmod(F.xxhash64("order_id"), F.lit(100)) == 0
    early = {**sources, "orders": sources["orders"].filter(~late)}

    def full_load() -> None:
        warehouse.load_full(build_star(enrich_all(clean_all(early)), TRADE_PARAMS))

    def incremental_load() -> None:
        star = increment_star(sources, TRADE_PARAMS, warehouse.star())
        warehouse.load_incremental(star, facts_checked=True)

    queries["full_load"] = timed(full_load)
    queries["incremental_load_1pct"] = timed(incremental_load)
    dirty = trade_sources(spark, folder, dirty=True)
    queries["quality_summary"] = timed(
        lambda: run(validation.summarise(validation.check_sources(dirty)))
    )

    plans = {
        **NAMED_QUERIES,
        "kpi_snapshot": analyses.kpi_snapshot,
        "top20_ltv": analyses.top_customers,
        "category_revenue": reports.category_revenue,
        "cohort_matrix": reports.cohort_matrix,
    }
    for name, plan in plans.items():
        queries[name] = timed(lambda p=plan: run(p(warehouse.star(), TRADE_PARAMS)))
    queries["agg_daily_sales"] = timed(
        lambda: run(
            analyses.daily_sales(warehouse.table("fact_sales"), warehouse.table("dim_date"))
        )
    )
    warm = {
        name: timed(lambda p=plan: run(p(warehouse.star(), TRADE_PARAMS)))
        for name, plan in plans.items()
    }
    fact = warehouse.table("fact_sales").select("order_id", "total_amount")
    order = [F.desc("total_amount"), F.col("order_id")]
    compare = {
        "row_number_single_partition": timed(
            lambda: run(fact.withColumn("n", F.row_number().over(W.orderBy(*order))))
        ),
        "row_index_two_pass": timed(lambda: run(row_index(fact, order))),
    }
    print(
        json.dumps(
            {
                "metric": "load and analyses, first run",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "warm": warm,
                "warm_total": round(sum(warm.values()), 3),
                "ordering": compare,
                "facts": warehouse.table("fact_sales").count(),
                "cpus": int(cpus),
            }
        )
    )
    release_staged(spark)
    spark.stop()
    shutil.rmtree(root, ignore_errors=True)


if __name__ == "__main__":
    main()
