"""Queries on history, time joins and streams, with their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries as oracle
from tallyloom.operators import cleaning
from tallyloom.operators.dealt import BUCKET_ROWS
from tallyloom.operators.frames import trailing_days, trailing_rows
from tallyloom.operators.history import interval_faults, merge_history, versions
from tallyloom.operators.ordinals import ORDINAL
from tallyloom.operators.reconcile import reconcile
from tallyloom.operators.sketches import daily_sketches, estimates, merged
from tallyloom.operators.star import Star, enrich_all, star_of
from tallyloom.operators.timejoin import as_of_join, interval_join
from tallyloom.plans import analyses, reports
from tallyloom.session import stage, staging_root
from tallyloom.sinks.bucketed import save_bucketed
from tallyloom.sources import trade
from tallyloom.sources.trade import TRADE_PARAMS, trade_sources
from tallyloom.streaming import stateful, windows

Query = Callable[[SparkSession, str], DataFrame]
GOLD, SILVER = 400_000, 150_000
WATCH_DAYS = 30


def _place(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def _written(df: DataFrame) -> DataFrame:
    """Timestamps as text."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in times})


# --- history -------------------------------------------------------------------------------


def _observed_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """The tier that each month's spending gives a customer."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    month = F.trunc("o_orderdate", "month")
    spent = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
    tier = F.when(F.col("spent") >= GOLD, "gold").when(F.col("spent") >= SILVER, "silver").otherwise("bronze")
    return (
        orders.groupBy(F.col("o_custkey").cast("string").alias("customer_id"), month.alias("month"))
        .agg(spent.alias("spent"))
        .select("customer_id", "month", tier.alias("tier"))
    )


def _tier_history(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches, each with months before and after those of the others."""
    observed = stage(_observed_tiers(spark, folder), "observed")
    batch = F.pmod(F.col("customer_id").cast("bigint") + F.month("month"), F.lit(3))
    history = None
    for k in (2, 0, 1):
        merged = merge_history(history, observed.filter(batch == k), ["customer_id"], ["tier"], "month")
        history = stage(merged, "history")
    return history


def dim_customer_history(spark: SparkSession, folder: str) -> DataFrame:
    return versions(_tier_history(spark, folder), ["customer_id"])


def history_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Overlaps and gaps planted in the history are named; the history itself has none."""
    good = stage(dim_customer_history(spark, folder), "versions")
    key = F.col("customer_id").cast("bigint")
    shifted = F.when(key % 10 == 0, F.date_add("valid_to", 7)).when(key % 10 == 1, F.date_sub("valid_to", 7))
    bad = good.withColumn("valid_to", F.coalesce(shifted, "valid_to"))
    both = good.withColumn("version_of", F.lit("good")).unionByName(bad.withColumn("version_of", F.lit("bad")))
    faults = interval_faults(both, ["version_of", "customer_id"])
    return faults.groupBy("version_of", "fault").agg(F.count(F.lit(1)).alias("versions"))


# --- time joins ----------------------------------------------------------------------------


def _clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = cleaning.clean_orders(trade.raw_orders(spark, folder))
    return orders.select("order_id", "customer_id", "product_id", "order_date", "unit_price")


def facts_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the customer's tier and the product's list price of that day.

    A list price is the highest of a month and holds from the month after.
    """
    orders = stage(_clean_orders(spark, folder), "orders")
    tiers = versions(_tier_history(spark, folder), ["customer_id"])
    prices = orders.groupBy("product_id", F.add_months(F.trunc("order_date", "month"), 1).alias("listed_from")).agg(
        F.max("unit_price").alias("list_price")
    )
    tiered = as_of_join(orders, tiers, ["customer_id"], "order_date", "valid_from", ["tier", "version"])
    tiered = stage(tiered, "tiered")  # read twice
    priced = as_of_join(tiered, prices, ["product_id"], "order_date", "listed_from", ["list_price"])
    return priced.select(
        "order_id", "order_date", "tier", "version", "list_price", (F.col("list_price") - F.col("unit_price")).alias("below_list")
    )


def orders_on_watch(spark: SparkSession, folder: str) -> DataFrame:
    """Orders placed within a month after a return of the same customer, with the number of those."""
    orders = stage(_clean_orders(spark, folder), "orders")
    returns = cleaning.clean_returns(trade.raw_returns(spark, folder)).select(
        F.col("order_id").alias("returned_id"), F.col("return_date").alias("since"),
        F.date_add("return_date", WATCH_DAYS).alias("until"),
    )
    who = orders.select(F.col("order_id").alias("returned_id"), "customer_id")
    watched = returns.join(who, "returned_id")
    pairs = interval_join(orders, watched, ["customer_id"], "order_date", "since", "until")
    return pairs.groupBy("order_id", "customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("watches"), F.min("since").alias("first_return")
    )


# --- streams -------------------------------------------------------------------------------


def streamed_shipping_costs(spark: SparkSession, folder: str) -> DataFrame:
    """Last shipping cost of each order from three sets of files; the stream is stopped after two."""
    events = trade.raw_shipping(spark, folder).select(
        "order_id",
        F.col("shipped_date").cast("timestamp").alias("event_time"),
        F.row_number().over(_by_order()).cast("long").alias("position"),
        F.col("shipping_cost").cast("decimal(18,2)").alias("shipping_cost"),
    )
    root = _place(spark, "shipping-stream")
    events = stage(events, "events")
    arrival = F.pmod(F.xxhash64("order_id", "position"), F.lit(3))
    for k in range(3):  # events of one order come in any order
        events.filter(arrival == k).write.parquet(f"{root}/in/{k}")
        if k:
            stream = spark.readStream.schema(events.schema).parquet(f"{root}/in/*")
            changes = stateful.last_costs(stream, delay="20000 days")
            stateful.keep_updates(changes, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return stateful.latest_updates(spark, f"{root}/out", ["order_id"]).select("order_id", "shipping_cost")


def _by_order():
    from pyspark.sql import Window as W

    return W.partitionBy("order_id").orderBy(ORDINAL)


_FIRST_LATE = "2001-01-01"


def _timed_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = _clean_orders(spark, folder).select("order_id", F.col("order_date").cast("timestamp").alias("order_time"))
    returns = cleaning.clean_returns(trade.raw_returns(spark, folder)).select(
        "order_id", F.col("return_date").cast("timestamp").alias("return_time")
    )
    return orders, returns


def streamed_order_returns(spark: SparkSession, folder: str) -> DataFrame:
    """Orders joined with their returns as both arrive; some of either come too late and are left out.

    First come the rows before 2001, but for those of every 20th order, then the rows of 2001. The
    held-back rows come last: those before the watermark are late, those beyond it count.
    """
    orders, returns = (stage(x, "timed") for x in _timed_orders(spark, folder))
    held = F.split_part("order_id", F.lit("-"), F.lit(1)).cast("bigint") % 20 == 0
    root = _place(spark, "return-stream")
    parts = [
        lambda rows, time: rows.filter(~held & (F.col(time) < _FIRST_LATE)),
        lambda rows, time: rows.filter(~held & (F.col(time) >= _FIRST_LATE)),
        lambda rows, time: rows.filter(held),
        # the last rows move the watermark beyond all others, so that all of them are decided
        lambda rows, time: spark.range(1).select(F.lit("end").alias("order_id"), F.lit("2100-01-01").cast("timestamp").alias(time)),
        lambda rows, time: spark.range(1).select(F.lit("end").alias("order_id"), F.lit("2100-01-02").cast("timestamp").alias(time)),
    ]
    for k, part in enumerate(parts):
        part(orders, "order_time").write.parquet(f"{root}/orders/{k}")
        part(returns, "return_time").write.parquet(f"{root}/returns/{k}")
        joined = stateful.orders_with_returns(
            spark.readStream.schema(orders.schema).parquet(f"{root}/orders/*"),
            spark.readStream.schema(returns.schema).parquet(f"{root}/returns/*"),
        )
        with stateful.state_on_disk(spark):  # the first micro-batch holds most orders
            query = (
                joined.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
                .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
            )
        query.awaitTermination()
    return spark.read.parquet(f"{root}/out").filter("order_id <> 'end'")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"
    )


def user_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return windows.sessions(_events(spark, folder), "user_id", "ts")


def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    return windows.sliding_counts(_events(spark, folder), "event_type", "ts")


def _land_events(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """The events as files of ten days each, and one event long after them; read as a stream."""
    events = stage(_events(spark, folder), "events")
    days = F.floor(F.unix_date(F.to_date("ts")) / 10)
    for k in [r[0] for r in events.select(days.alias("k")).distinct().orderBy("k").collect()]:  # a few numbers
        events.filter(days == k).coalesce(1).write.mode("append").parquet(f"{root}/in")
    end = events.agg(F.lit(-1).cast("long").alias("user_id"), (F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"),
                     F.lit("end").alias("event_type"), F.lit(0.0).alias("value"))
    end.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    return stream.parquet(f"{root}/in")


def user_sessions_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """The same sessions from a stream, each given out once when it has ended."""
    root = _place(spark, "session-stream")
    found = windows.sessions(_land_events(spark, folder, root), "user_id", "ts")
    query = (
        found.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out").filter("user_id >= 0")


def event_windows_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """The same windows from a stream that gives out each change."""
    root = _place(spark, "window-stream")
    changes = windows.sliding_counts(_land_events(spark, folder, root), "event_type", "ts")
    stateful.keep_updates(changes, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    latest = stateful.latest_updates(spark, f"{root}/out", ["event_type", "begins_at", "ends_at"])
    return latest.filter("event_type <> 'end'").select("event_type", "begins_at", "ends_at", "events", "value")


# --- whole-table frames, cubes, sketches, reconciliation, buckets --------------------------


def _star(spark: SparkSession, folder: str, dirty: bool = False) -> Star:
    return star_of(trade_sources(spark, folder, dirty), TRADE_PARAMS)


def trailing_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Each order with the revenue of the last 7 and 28 days and of the last 100 orders."""
    sources = cleaning.clean_all(trade_sources(spark, folder))
    orders = enrich_all(sources)["orders"].select("order_id", "order_date", "total_amount")
    by_day = trailing_days(orders, "order_date", "total_amount", {"revenue_7d": 7, "revenue_28d": 28}, bin_days=180)
    order = [F.col("order_date").asc_nulls_first(), F.col("order_id")]
    return trailing_rows(by_day, order, "total_amount", 100, "last_100_orders", stretch=5_000)


def revenue_cube(spark: SparkSession, folder: str) -> DataFrame:
    return reports.revenue_cube(_star(spark, folder, dirty=True), TRADE_PARAMS)


def sketched_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Unique customers by month and year: exact, and whether merged daily sketches come close."""
    star = _star(spark, folder)
    fact = stage(star.fact_sales.select("date_key", "customer_key", "total_amount"), "fact")
    daily = stage(daily_sketches(fact), "sketches")
    monthly = stage(merged(daily, F.expr("date_key div 100").alias("period")), "sketches")
    yearly = merged(monthly, F.expr("period div 100").alias("period"))
    both = estimates(monthly.unionByName(yearly)).withColumnRenamed("unique_customers", "estimate")
    periods = F.explode(F.array(F.expr("date_key div 100"), F.expr("date_key div 10000"))).alias("period")
    exact = fact.select("customer_key", "total_amount", periods).join(
        both.select("period", "orders", "estimate", F.col("amount_quantiles")[0].alias("median")), "period"
    )
    low = F.count_if(F.col("total_amount") < F.col("median")) / F.count(F.lit(1))
    high = F.count_if(F.col("total_amount") <= F.col("median")) / F.count(F.lit(1))
    unique = F.countDistinct("customer_key")
    return exact.groupBy("period").agg(
        F.max("orders").alias("orders"),
        unique.alias("unique_customers"),
        (F.abs(F.max("estimate") - unique) <= 0.05 * unique + 1).alias("customers_close"),
        ((low <= 0.53) & (high >= 0.47)).alias("median_close"),
    )


def reconciled_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Lost, doubled, changed and added facts against the orders they come from."""
    sources = cleaning.clean_all(trade_sources(spark, folder))
    columns = ["customer_id", "product_id", "quantity", "total_amount", "is_returned", "shipping_cost"]
    source = stage(enrich_all(sources)["orders"].select("order_id", *columns), "orders")
    key = F.split_part("order_id", F.lit("-"), F.lit(1)).cast("bigint")
    loaded = source.filter(key % 97 != 0).withColumn(
        "total_amount", F.col("total_amount") + F.when(key % 89 == 0, F.lit(1)).otherwise(F.lit(0))
    )
    twice = source.filter((key % 83 == 0) & (key % 97 != 0) & (key % 89 != 0))
    more = source.filter(key % 79 == 0).withColumn("order_id", F.concat(F.lit("x"), "order_id"))
    return reconcile(source, loaded.unionByName(twice).unionByName(more), ["order_id"], columns)


def _bucketed(spark: SparkSession, folder: str) -> Star:
    """The star with fact and customers in the same buckets by customer: 16, or more for many lines."""
    star = star_of(trade_sources(spark, folder, dealt=True), TRADE_PARAMS)
    buckets = max(16, -(-spark.read.parquet(f"{folder}/lineitem.parquet").count() // BUCKET_ROWS))
    name = f"fact_{uuid.uuid4().hex}"
    fact = save_bucketed(star.fact_sales, name, "customer_key", buckets)
    customers = save_bucketed(star.dim_customer, f"{name}_customer", "customer_key", buckets)
    return Star(star.dim_date, customers, star.dim_supplier, star.dim_product, fact)


def bucketed_ltv(spark: SparkSession, folder: str) -> DataFrame:
    return analyses.customer_ltv(_bucketed(spark, folder), TRADE_PARAMS)


def bucketed_rfm(spark: SparkSession, folder: str) -> DataFrame:
    return analyses.rfm_segmentation(_bucketed(spark, folder), TRADE_PARAMS)


def bucketed_churn(spark: SparkSession, folder: str) -> DataFrame:
    return analyses.customer_churn(_bucketed(spark, folder), TRADE_PARAMS)


def queries() -> dict[str, Query]:
    return {
        f.__name__: lambda spark, folder, f=f: _written(f(spark, folder))
        for f in (
            dim_customer_history, history_faults, facts_as_of, orders_on_watch, streamed_shipping_costs,
            streamed_order_returns, user_sessions, event_windows, user_sessions_streamed, event_windows_streamed,
            trailing_revenue, revenue_cube, sketched_customers, reconciled_facts, bucketed_ltv, bucketed_rfm,
            bucketed_churn,
        )
    }


_TIERS = f"""
observed AS (
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= {GOLD} THEN 'gold'
                WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= {SILVER} THEN 'silver' ELSE 'bronze' END AS tier
    FROM orders GROUP BY ALL),
changes AS (
    SELECT * FROM (SELECT *, lag(tier) OVER (PARTITION BY customer_id ORDER BY month) AS before FROM observed)
    WHERE before IS DISTINCT FROM tier),
tiers AS (
    SELECT customer_id, tier, month AS valid_from,
           lead(month) OVER (PARTITION BY customer_id ORDER BY month) AS valid_to,
           CAST(row_number() OVER (PARTITION BY customer_id ORDER BY month) AS INTEGER)::BIGINT AS version
    FROM changes)"""

_SESSIONS = """
WITH marked AS (
    SELECT user_id, ts, coalesce(ts > lag(ts) OVER w + INTERVAL 30 MINUTES, true)::INT AS fresh
    FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM marked)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_at,
       strftime(max(ts) + INTERVAL 30 MINUTES, '%Y-%m-%d %H:%M:%S.%f') AS ends_at, count(*) AS events
FROM numbered GROUP BY user_id, k"""

_WINDOWS = """
SELECT event_type, strftime(begins_at, '%Y-%m-%d %H:%M:%S.%f') AS begins_at,
       strftime(begins_at + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ends_at, count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM (SELECT *, time_bucket(INTERVAL 15 MINUTES, ts) - to_minutes(CAST(15 * unnest(range(4)) AS BIGINT)) AS begins_at
      FROM events WHERE ts IS NOT NULL)
GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    base = oracle.oracle_sql()
    star, dirty = oracle._prefix(), oracle._prefix(dirty=True)
    returns = """
returns AS (
    SELECT order_id, return_date FROM (
        SELECT l_orderkey || '-' || l_linenumber AS order_id, CAST(l_shipdate AS DATE) AS return_date,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY """ + oracle.LINE_ORDER + """) AS rn
        FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1)"""
    ended = f"""
early AS (SELECT CAST(split_part(order_id, '-', 1) AS BIGINT) % 20 = 0 AS held, order_id, order_date FROM clean),
mark AS (
    SELECT least((SELECT max(order_date) FROM early WHERE NOT held),
                 (SELECT max(return_date) FROM returns
                  WHERE CAST(split_part(order_id, '-', 1) AS BIGINT) % 20 <> 0)) - INTERVAL 10 DAYS AS bound)"""
    return {
        "dim_customer_history": f"WITH {_TIERS}\nSELECT *, valid_to IS NULL AS is_current FROM tiers",
        "history_faults": f"""WITH {_TIERS}
SELECT 'bad' AS version_of, CASE WHEN CAST(customer_id AS BIGINT) % 10 = 0 THEN 'overlap' ELSE 'gap' END AS fault,
       count(*) AS versions
FROM tiers WHERE valid_to IS NOT NULL AND CAST(customer_id AS BIGINT) % 10 <= 1 GROUP BY ALL""",
        "facts_as_of": star + f""", {_TIERS},
listed AS (
    SELECT product_id, CAST(date_trunc('month', order_date) + INTERVAL 1 MONTH AS DATE) AS since, max(unit_price) AS list_price
    FROM clean GROUP BY ALL),
tiered AS (
    SELECT clean.*, tier, version FROM clean LEFT JOIN tiers
        ON tiers.customer_id = clean.customer_id AND order_date >= valid_from AND (valid_to IS NULL OR order_date < valid_to))
SELECT order_id, order_date, tier, version, CAST(list_price AS DOUBLE) AS list_price,
       CAST(list_price - unit_price AS DOUBLE) AS below_list
FROM tiered ASOF LEFT JOIN listed ON tiered.product_id = listed.product_id AND order_date >= since""",
        "orders_on_watch": star + f""", {returns}
SELECT a.order_id, a.customer_id, a.order_date, count(*) AS watches, min(return_date) AS first_return
FROM clean a JOIN clean b ON a.customer_id = b.customer_id JOIN returns ON returns.order_id = b.order_id
WHERE a.order_date >= return_date AND a.order_date < return_date + {WATCH_DAYS} GROUP BY ALL""",
        "streamed_shipping_costs": star + "\nSELECT order_id, CAST(cost AS DOUBLE) AS shipping_cost FROM shipped",
        "streamed_order_returns": star + f""", {returns}, {ended}
SELECT o.order_id, strftime(CAST(order_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS order_time,
       strftime(CAST(return_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS return_time
FROM (SELECT * FROM early, mark WHERE NOT held OR order_date >= bound) o
LEFT JOIN (SELECT * FROM returns, mark
           WHERE CAST(split_part(order_id, '-', 1) AS BIGINT) % 20 <> 0 OR return_date >= bound) r
    ON o.order_id = r.order_id AND return_date >= order_date AND return_date < order_date + 30""",
        "user_sessions": _SESSIONS,
        "user_sessions_streamed": _SESSIONS,
        "event_windows": _WINDOWS,
        "event_windows_streamed": _WINDOWS,
        "trailing_revenue": star + """
SELECT order_id, order_date, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(sum(total_amount) OVER (w RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_7d,
       CAST(sum(total_amount) OVER (w RANGE BETWEEN INTERVAL 27 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_28d,
       CAST(sum(total_amount) OVER (ORDER BY order_date, order_id ROWS 99 PRECEDING) AS DOUBLE) AS last_100_orders
FROM enriched WINDOW w AS (ORDER BY order_date)""",
        "revenue_cube": dirty + """
SELECT category, segment, quarter, GROUPING(category, segment, quarter) AS level,
       CAST(sum(total_amount) AS DOUBLE) AS revenue, count(*) AS orders
FROM (SELECT total_amount, category, segment, d.year || '-Q' || d.quarter AS quarter
      FROM fact_sales f LEFT JOIN dim_product p ON f.product_key = p.product_key
      LEFT JOIN dim_customer c ON f.customer_key = c.customer_key LEFT JOIN dim_date d ON f.date_key = d.date_key)
GROUP BY CUBE (category, segment, quarter)""",
        "sketched_customers": star + """
SELECT CAST(period AS BIGINT) AS period, count(*) AS orders, count(DISTINCT customer_id) AS unique_customers,
       true AS customers_close, true AS median_close
FROM (SELECT customer_id, unnest([year(order_date) * 100 + month(order_date), year(order_date)]) AS period FROM clean)
GROUP BY period""",
        "reconciled_facts": star + """
SELECT * FROM (
    SELECT order_id, CASE WHEN k % 97 = 0 THEN 'lost' WHEN k % 89 = 0 THEN 'changed' ELSE 'doubled' END AS fault,
           1::BIGINT AS in_source, CASE WHEN k % 97 = 0 THEN 0 WHEN k % 89 = 0 THEN 1 ELSE 2 END::BIGINT AS in_target
    FROM (SELECT order_id, CAST(split_part(order_id, '-', 1) AS BIGINT) AS k FROM clean)
    WHERE k % 97 = 0 OR k % 89 = 0 OR k % 83 = 0
    UNION ALL SELECT 'x' || order_id, 'added', 0, 1 FROM clean WHERE CAST(split_part(order_id, '-', 1) AS BIGINT) % 79 = 0)""",
        "bucketed_ltv": base["customer_ltv"],
        "bucketed_rfm": base["rfm_segmentation"],
        "bucketed_churn": base["customer_churn"],
    }
