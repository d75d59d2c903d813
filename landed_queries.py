"""Queries on landed files, loads, streams and runs, with their oracle SQL.

The given tables are landed in other formats, or loaded in several steps, and read back; the
oracle states the result from the tables alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries as oracle
from tallyloom.operators import cleaning, dimensions, validation
from tallyloom.operators.enrichment import enrich_products
from tallyloom.operators.ordinals import ORDINAL
from tallyloom.operators.star import enrich_all
from tallyloom.plans import runs
from tallyloom.plans.job import WarehouseJob, build_star, unseen_orders
from tallyloom.schemas import RAW, RUN_EVENTS
from tallyloom.session import in_parallel, stage, staging_root
from tallyloom.sinks.warehouse import Warehouse
from tallyloom.sources import trade
from tallyloom.sources.registry import SOURCES, extract_all, read_source
from tallyloom.sources.trade import TRADE_PARAMS, TradeSources, trade_sources
from tallyloom.streaming.ingest import stream_orders

Query = Callable[[SparkSession, str], DataFrame]
SPLIT = "2001-01-01"
LIST_SPAN = 2_000  # keys in a landed list: some MB of shipping events, so files don't get too many
QUOTED = 'on "hold", late'


def _place(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def _line_key() -> F.Column:
    """The order key of a line's order id."""
    return F.split_part("order_id", F.lit("-"), F.lit(1)).cast("bigint")


# --- landed files --------------------------------------------------------------------------


def _land_orders(orders: DataFrame, path: str) -> None:
    """CSV in two column orders, whole numbers as 1.0, and quoted fields."""
    rows = orders.select(
        *(F.col(c) for c in RAW["orders"].fieldNames() if c not in ("quantity", "status")),
        F.col("quantity").cast("double").alias("quantity"),
        F.when(_line_key() % 113 == 0, QUOTED).otherwise(F.col("status")).alias("status"),
    )
    for name, part, columns in (
        ("a", _line_key() % 2 == 0, rows.columns),
        ("b", _line_key() % 2 == 1, rows.columns[::-1]),
    ):
        writer = rows.filter(part).select(columns).write.option("header", True)
        writer.option("escape", '"').csv(f"{path}/{name}")


def csv_orders(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark, "csv-orders")
    _land_orders(cleaning.clean_orders(trade.raw_orders(spark, folder)), path)
    return cleaning.clean_orders(read_source(spark, "orders", "csv", f"{path}/*"))


def _json_lists(rows: DataFrame, path: str, key: str, span: int = 50) -> None:
    """Files that are JSON lists, each of the objects of ``span`` keys at most, with keys in another case."""
    names = {c: f" {c.upper()}" for c in rows.columns}
    lists = (
        rows.select(*(F.col(c).alias(names[c]) for c in rows.columns))
        .groupBy(F.floor(F.col(f"`{names[key]}`").cast("bigint") / span))
        .agg(F.to_json(F.collect_list(F.struct(*(f"`{n}`" for n in names.values())))).alias("value"))
    )
    lists.select("value").write.option("maxRecordsPerFile", 1).text(path)


def json_list_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark, "json-suppliers")
    rows = trade.raw_suppliers(spark, folder).select(RAW["suppliers"].fieldNames())
    _json_lists(rows, path, "supplier_id")
    return cleaning.clean_suppliers(read_source(spark, "suppliers", "json", path))


def json_shipping(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark, "json-shipping")
    rows = trade.raw_shipping(spark, folder).select(RAW["shipping"].fieldNames())
    odd = rows.filter(_line_key() % 2 == 1).toDF(*(c.title() for c in rows.columns))
    rows.filter(_line_key() % 2 == 0).write.json(f"{path}/a")
    odd.write.json(f"{path}/b")
    return cleaning.clean_shipping(read_source(spark, "shipping", "jsonl", f"{path}/*"))


def _land_sources(spark: SparkSession, folder: str) -> str:
    """All six sources in the layout that a job reads."""
    root = _place(spark, "landed")
    for name, (kind, file_name) in SOURCES.items():
        rows = trade_sources(spark, folder)[name].select(RAW[name].fieldNames())
        path = f"{root}/raw/{file_name}"
        if kind == "csv":
            rows.write.option("header", True).option("escape", '"').csv(path)
        elif name == "shipping":
            key = _line_key().cast("string")
            _json_lists(rows.withColumn("batch_key", key), path, "batch_key", LIST_SPAN)
        else:
            _json_lists(rows, path, f"{name[:-1]}_id", LIST_SPAN)
    return root


def extracted_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all six sources, counted by a query on each."""
    root = _land_sources(spark, folder)
    parts = [
        e.df.agg(F.count(F.lit(1)).alias("total_rows")).select(
            F.lit(e.name).alias("source"), "total_rows"
        )
        for e in extract_all(spark, root).values()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def observed_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all six sources, observed while they are read for something else, and their columns."""
    counts = []
    for e in extract_all(spark, _land_sources(spark, folder)).values():
        rows, watch = e.observed()
        stage(rows.drop(ORDINAL), "observed")
        counts.append((e.name, watch.get["rows"], ",".join(c for c in e.columns if c in RAW[e.name].fieldNames())))
    return spark.createDataFrame(counts, "source string, total_rows long, columns string")


def first_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Customers landed in files with copies that only their place tells apart: the first one stays."""
    path = _place(spark, "copied-customers")
    rows = trade.raw_customers(spark, folder).select(RAW["customers"].fieldNames())
    key = F.col("customer_id").cast("bigint")
    old = rows.filter(key % 3 != 0)
    again = rows.withColumn("name", F.concat(F.lit("copy of "), "name"))
    for place, part in (("a", old), ("b", again), ("c", rows)):
        part.coalesce(1).write.option("header", True).csv(f"{path}/{place}")
    return cleaning.clean_customers(read_source(spark, "customers", "csv", f"{path}/*")).select("customer_id", "name", "city")


# --- flawed master data --------------------------------------------------------------------


def _flawed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Repeated and padded customers, costs above retail, ratings out of range, copies."""
    customers = trade.raw_customers(spark, folder)
    again = customers.filter(F.col("customer_id").cast("bigint") % 40 == 0).withColumns(
        {"name": F.lit("copy"), ORDINAL: F.struct((F.col(f"{ORDINAL}.c_custkey") + 10**9).alias("c_custkey"))}
    )
    customers = customers.withColumn("name", F.concat(F.lit("  "), "name", F.lit("\t")))
    products = trade.raw_products(spark, folder)
    costly = F.col("product_id").cast("bigint") % 31 == 0
    products = products.withColumn(
        "cost_price", F.when(costly, F.col("retail_price") + 1).otherwise(F.col("cost_price"))
    )
    suppliers = trade.raw_suppliers(spark, folder)
    rating = F.when(F.col("supplier_id").cast("bigint") % 7 == 0, 9.5).otherwise(F.col("reliability_rating"))
    suppliers = suppliers.withColumn("reliability_rating", rating)
    twice = suppliers.withColumns(
        {"name": F.lit("copy"), ORDINAL: F.struct((F.col(f"{ORDINAL}.s_suppkey") + 10**9).alias("s_suppkey"))}
    )
    return {
        "customers": customers.unionByName(again),
        "products": products,
        "suppliers": suppliers.unionByName(twice),
    }


def master_data_issues(spark: SparkSession, folder: str) -> DataFrame:
    checked = validation.check_sources(_flawed(spark, folder), declared=True)
    issues = validation.issues_of(checked, indexed=False)
    wanted = issues.filter("rule IN ('unique', 'uniqueness', 'business_rule') OR field = 'reliability_rating'")
    return wanted.groupBy("source", "field", "message").agg(F.count(F.lit(1)).alias("issues"))


def dim_customer_dirty(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.build_dim_customer(cleaning.clean_customers(_flawed(spark, folder)["customers"]))


def dim_supplier_dirty(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.build_dim_supplier(cleaning.clean_suppliers(_flawed(spark, folder)["suppliers"]))


# --- loads ---------------------------------------------------------------------------------


def _early(sources) -> dict[str, DataFrame]:
    return {**sources, "orders": sources["orders"].filter(F.col("order_date") < SPLIT)}


def _increment(warehouse: Warehouse, sources) -> None:
    known = warehouse.star()
    ready = enrich_all(cleaning.clean_all(unseen_orders(sources, known)))
    warehouse.load_incremental(build_star(ready, TRADE_PARAMS, known), facts_checked=True)


def load_sources(spark: SparkSession, folder: str) -> TradeSources:
    """Sources that several loads read: lines and orders dealt, and the products, whose suppliers
    are looked up in all lines, written once."""
    sources = trade_sources(spark, folder, dealt=True)
    sources.keep("products")
    return sources


def _first_load(spark: SparkSession, folder: str, issues: DataFrame | None = None, sources=None) -> Warehouse:
    warehouse = Warehouse(spark, _place(spark, "warehouse"))
    early = _early(sources or trade_sources(spark, folder, dealt=True))
    warehouse.load_full(build_star(enrich_all(cleaning.clean_all(early)), TRADE_PARAMS), issues)
    return warehouse


def loaded_daily_sales_undated(spark: SparkSession, folder: str) -> DataFrame:
    """An increment in which every fifth order has no date leaves the earlier days alone."""
    sources = dict(load_sources(spark, folder))
    warehouse = _first_load(spark, folder, sources=sources)
    lost = (F.col("order_date") >= SPLIT) & (_line_key() % 5 == 0)
    dated = F.when(~lost, F.col("order_date"))
    _increment(warehouse, {**sources, "orders": sources["orders"].withColumn("order_date", dated)})
    return warehouse.table("agg_daily_sales")


def compacted_daily_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Facts after three increments."""
    sources = dict(load_sources(spark, folder))
    warehouse = _first_load(spark, folder, sources=sources)
    for k in (1, 2, 3):
        some = sources["orders"].filter((F.col("order_date") < SPLIT) | (_line_key() % 3 < k))
        _increment(warehouse, {**sources, "orders": some})
    fact = warehouse.table("fact_sales")
    return fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("order_key").alias("order_keys"),
        F.sum("total_amount").cast("double").alias("revenue"),
    )


def loaded_issues(spark: SparkSession, folder: str) -> DataFrame:
    """Issues of a full load, and those that an increment adds."""
    dirty = trade_sources(spark, folder, dirty=True, dealt=True)
    issues = stage(validation.issues_of(validation.check_sources(dirty)), "issues")  # loaded twice
    warehouse = _first_load(spark, folder, issues, dirty.without_flaws())
    warehouse.load_incremental(warehouse.star(), issues)
    stored = warehouse.table("data_quality_issues")
    return stored.groupBy("source", "field", "rule").agg(F.count(F.lit(1)).alias("issues"))


def last_loads(spark: SparkSession, folder: str) -> DataFrame:
    """The time of the last load is the stored one, in ISO form, for each table."""
    warehouse = _first_load(spark, folder)
    names = ["dim_customer", "dim_date", "dim_product", "dim_supplier", "fact_sales"]
    times = [(n, warehouse.last_load(n)) for n in names] + [("none", warehouse.last_load("none"))]
    times = spark.createDataFrame(times, "table_name string, last_load string")
    stored = warehouse.table("load_metadata")
    return times.join(stored, "table_name", "left").select(
        "table_name",
        F.expr("try_to_timestamp(last_load) IS NOT NULL").alias("loaded"),
        (F.col("last_load") == F.col("last_load_at")).alias("same"),
        "records_processed",
    )


def ingested_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Two sets of order files, the second with orders of the first, through the stream."""
    sources = trade_sources(spark, folder, dealt=True)
    warehouse = _first_load(spark, folder, sources=sources)
    late = cleaning.clean_orders(sources["orders"]).filter(F.col("order_date") >= SPLIT)
    root = _place(spark, "arriving")
    events = {n: sources[n] for n in ("returns", "shipping")}
    for k in (1, 2):
        _land_orders(late.filter(_line_key() % 2 < k), f"{root}/orders/{k}")
        query = stream_orders(
            spark, warehouse.root, f"{root}/orders/*/*", f"{root}/checkpoint", events
        )
        query.awaitTermination()
    fact = warehouse.table("fact_sales")
    return fact.select(
        "order_id", "date_key", "customer_key", F.col("total_amount").cast("double").alias("total_amount"),
        F.col("shipping_cost").cast("double").alias("shipping_cost"), "is_returned",
    )


def loads_at_once(spark: SparkSession, folder: str) -> DataFrame:
    """Three increments published beside each other on one loaded state: none is lost, none counts twice."""
    sources = dict(load_sources(spark, folder))
    warehouse = _first_load(spark, folder, sources=sources)
    known = warehouse.star()

    def load(k: int) -> None:
        # parts overlap: orders of every second remainder are in two of the loads
        some = sources["orders"].filter((F.col("order_date") < SPLIT) | (_line_key() % 6).isin(2 * k, 2 * k + 1, (2 * k + 2) % 6))
        ready = enrich_all(cleaning.clean_all(unseen_orders({**sources, "orders": some}, known)))
        Warehouse(spark, warehouse.root).load_incremental(build_star(ready, TRADE_PARAMS, known), facts_checked=True)

    in_parallel(spark, *(lambda k=k: load(k) for k in range(3)))
    fact = warehouse.table("fact_sales")
    return fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("order_key").alias("order_keys"),
        F.sum("total_amount").cast("double").alias("revenue"),
    )


def job_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts that a full job records, read back from its run log."""
    job = WarehouseJob(
        spark, _place(spark, "job"), sources=trade_sources(spark, folder), params=TRADE_PARAMS
    )
    job.run()
    counts = job.run_log.recent().filter("status = 'success'")
    return counts.select(F.explode("row_counts").alias("name", "row_count"))


# --- runs ----------------------------------------------------------------------------------


def _run_log(spark: SparkSession, folder: str) -> runs.RunLog:
    """A run log with the orders as runs: some failed, some still running."""
    root = _place(spark, "runs")
    key = F.col("o_orderkey")
    begun = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=key % 86400)
    failed = key % 7 == 0
    some = F.lit(None)
    start = {"event": F.lit("start"), "at": begun, "status": F.lit("running"),
             "mode": F.when(key % 3 == 0, "incremental").otherwise("full")}
    finish = {
        "event": F.lit("finish"),
        "at": begun + F.make_dt_interval(secs=key % 1000),
        "status": F.when(failed, "failed").otherwise("success"),
        "error_message": F.when(failed, F.concat(F.lit("no file "), key.cast("string"))),
        "quality_score": F.when(~failed, (key % 1000) / 10),
        "phase_timings": F.create_map(F.lit("extract"), (key % 97) / 8, F.lit("load"), (key % 89) / 4),
        "row_counts": F.create_map(F.lit("fact_sales"), key),
    }
    table = spark.read.parquet(f"{folder}/orders.parquet")

    def events(values, rows):
        return rows.select(
            *(
                (key if f.name == "run_id" else values.get(f.name, some)).cast(f.dataType).alias(f.name)
                for f in RUN_EVENTS.fields
            )
        )

    both = events(start, table).unionByName(events(finish, table.filter(key % 11 != 0)))
    both.write.parquet(f"{root}/runs/events/event=landed")
    return runs.RunLog(spark, root)


def run_records(spark: SparkSession, folder: str) -> DataFrame:
    return _run_log(spark, folder).runs().select(
        "run_id", "mode", "status", "error_message", "quality_score", "duration_seconds",
        F.element_at("row_counts", "fact_sales").alias("facts"), F.size("phase_timings").cast("bigint").alias("phases"),
    )


def recent_runs(spark: SparkSession, folder: str) -> DataFrame:
    return _run_log(spark, folder).recent().select("run_id", "status", "mode")


def run_statistics(spark: SparkSession, folder: str) -> DataFrame:
    stats = runs.run_statistics(_run_log(spark, folder).runs())
    return stats.withColumns({c: F.round(c, 6) for c in ("success_rate", "avg_duration")})


def run_durations(spark: SparkSession, folder: str) -> DataFrame:
    trend = runs.duration_trend(_run_log(spark, folder).runs())
    return trend.groupBy(F.to_date("started_at").alias("day")).agg(
        F.count(F.lit(1)).alias("runs"), F.sum("duration_seconds").alias("seconds")
    )


def run_phases(spark: SparkSession, folder: str) -> DataFrame:
    finished = _run_log(spark, folder).runs().filter("finished_at IS NOT NULL")
    return runs.phase_breakdown(finished)


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            csv_orders, json_list_suppliers, json_shipping, extracted_sources, observed_sources, first_copies,
            loads_at_once, master_data_issues,
            dim_customer_dirty, dim_supplier_dirty, loaded_daily_sales_undated, compacted_daily_revenue,
            loaded_issues, last_loads, ingested_facts, job_row_counts, run_records, recent_runs,
            run_statistics, run_durations, run_phases,
        )
    }


def oracle_sql() -> dict[str, str]:
    base = oracle.oracle_sql()
    star, dirty = oracle._prefix(), oracle._prefix(dirty=True)
    status = f"CASE WHEN l_orderkey % 113 = 0 THEN '{QUOTED}' ELSE status END AS status"
    run_table = """
WITH runs AS (
    SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 3 = 0 THEN 'incremental' ELSE 'full' END AS mode,
           o_orderkey % 11 <> 0 AS ended, o_orderkey % 7 = 0 AS broken,
           CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS started_at
    FROM orders),
records AS (
    SELECT *, CASE WHEN NOT ended THEN 'running' WHEN broken THEN 'failed' ELSE 'success' END AS status,
           CASE WHEN ended THEN CAST(run_id % 1000 AS DOUBLE) END AS duration_seconds
    FROM runs)"""
    counts = ", ".join(
        f"('{name}', (SELECT count(*) FROM {table}))"
        for name, table in {
            "raw_orders": "raw_orders", "raw_customers": "customer", "raw_products": "part",
            "raw_suppliers": "supplier", "raw_returns": "(SELECT 1 FROM lineitem WHERE l_returnflag = 'R')",
            "raw_shipping": "(SELECT 1 FROM lineitem WHERE l_tax > 0)", "clean_orders": "fact_sales",
            "clean_customers": "dim_customer", "clean_products": "dim_product", "clean_suppliers": "dim_supplier",
            "clean_returns": "returned", "clean_shipping": "(SELECT 1 FROM lineitem WHERE l_tax > 0)",
            "dim_date": "dim_date", "dim_customer": "dim_customer", "dim_product": "dim_product",
            "dim_supplier": "dim_supplier", "fact_sales": "fact_sales",
        }.items()
    )
    sources = ", ".join(
        f"('{name}', (SELECT count(*) FROM {table}))"
        for name, table in {
            "orders": "lineitem JOIN orders ON l_orderkey = o_orderkey", "customers": "customer",
            "products": "part", "suppliers": "supplier",
            "returns": "lineitem WHERE l_returnflag = 'R'", "shipping": "lineitem WHERE l_tax > 0",
        }.items()
    )
    return {
        "csv_orders": star + f"""
SELECT order_id, customer_id, product_id, CAST(quantity AS BIGINT) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_pct AS DOUBLE) AS discount_pct,
       order_date, {status} FROM clean""",
        "json_list_suppliers": base["jsonl_suppliers"],
        "json_shipping": base["clean_shipping"],
        "extracted_sources": f"SELECT * FROM (VALUES {sources}) AS t(source, total_rows)",
        "observed_sources": "SELECT source, total_rows, columns FROM (VALUES " + sources + ") AS t(source, total_rows)"
        " JOIN (VALUES " + ", ".join(f"('{n}', '{','.join(RAW[n].fieldNames())}')" for n in SOURCES) + ") AS c(name, columns)"
        " ON source = name",
        "first_copies": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c_custkey % 3 = 0 THEN 'copy of ' || c_name ELSE c_name END AS name, n_name AS city
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "loads_at_once": star + """
SELECT date_key, count(*) AS orders, count(*) AS order_keys, CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM fact_sales GROUP BY date_key""",
        "master_data_issues": """
SELECT 'customers' AS source, 'customer_id' AS field, 'Duplicate customer_id' AS message, count(*) AS issues
FROM customer WHERE c_custkey % 40 = 0
UNION ALL SELECT 'products', 'retail_price', 'Cost price exceeds retail price', count(*)
FROM part WHERE p_partkey % 31 = 0
UNION ALL SELECT 'suppliers', 'reliability_rating', 'Reliability rating must be between 1 and 5', 2 * count(*)
FROM supplier WHERE s_suppkey % 7 = 0""",
        "dim_customer_dirty": base["dim_customer"],
        "dim_supplier_dirty": base["dim_supplier"].replace(
            "SELECT * FROM dim_supplier", "SELECT * REPLACE (CASE WHEN CAST(supplier_id AS BIGINT) % 7 = 0"
            " THEN 9.5::DOUBLE ELSE reliability_rating END AS reliability_rating) FROM dim_supplier"),
        "loaded_daily_sales_undated": base["agg_daily_sales"].replace(
            "WHERE full_date IS NOT NULL", f"WHERE full_date IS NOT NULL AND NOT (full_date >= DATE '{SPLIT}'"
            " AND CAST(split_part(order_id, '-', 1) AS BIGINT) % 5 = 0)"),
        "compacted_daily_revenue": star + """
SELECT date_key, count(*) AS orders, count(*) AS order_keys, CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM fact_sales GROUP BY date_key""",
        "loaded_issues": dirty + oracle._SUMMARY + """
SELECT source, field, rule, 2 * count(*) AS issues FROM (
    SELECT source, field, rule FROM row_issues
    UNION ALL SELECT source, field, rule FROM link_issues
    UNION ALL SELECT 'products', 'supplier_id', 'not_null' FROM priced WHERE supp IS NULL
) GROUP BY ALL""",
        "last_loads": star + f"""
SELECT * FROM (VALUES ('dim_customer', true, true, (SELECT count(*) FROM dim_customer)),
    ('dim_date', true, true, (SELECT count(*) FROM dim_date)),
    ('dim_product', true, true, (SELECT count(*) FROM dim_product)),
    ('dim_supplier', true, true, (SELECT count(*) FROM dim_supplier)),
    ('fact_sales', true, true, (SELECT count(*) FROM fact_sales WHERE order_date < DATE '{SPLIT}')),
    ('none', false, NULL, NULL)) AS t(table_name, loaded, same, records_processed)""",
        "ingested_facts": star + """
SELECT order_id, date_key, customer_key, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(shipping_cost AS DOUBLE) AS shipping_cost, is_returned FROM fact_sales""",
        "job_row_counts": star + f"\nSELECT * FROM (VALUES {counts}) AS t(name, row_count)",
        "run_records": run_table + """
SELECT run_id, mode, status, CASE WHEN status = 'failed' THEN 'no file ' || run_id END AS error_message,
       CASE WHEN status = 'success' THEN (run_id % 1000) / 10.0::DOUBLE END AS quality_score, duration_seconds,
       CASE WHEN ended THEN run_id END AS facts, CASE WHEN ended THEN 2 ELSE 0 END::BIGINT AS phases
FROM records""",
        "recent_runs": run_table + "\nSELECT run_id, status, mode FROM records ORDER BY run_id DESC LIMIT 50",
        "run_statistics": run_table + """
SELECT count(*) AS total_runs, count(*) FILTER (status = 'success') AS success_runs,
       count(*) FILTER (status = 'failed') AS failed_runs,
       round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 6) AS success_rate,
       round(avg(duration_seconds), 6) AS avg_duration FROM records""",
        "run_durations": run_table + """
SELECT CAST(started_at AS DATE) AS day, count(*) AS runs, sum(duration_seconds) AS seconds
FROM records GROUP BY 1""",
        "run_phases": run_table + """,
latest AS (SELECT max(run_id) AS run_id FROM records WHERE ended)
SELECT run_id, 'extract' AS phase, round((run_id % 97) / 8.0::DOUBLE, 3) AS seconds FROM latest
UNION ALL SELECT run_id, 'load', round((run_id % 89) / 4.0::DOUBLE, 3) FROM latest""",
    }
