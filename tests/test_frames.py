"""Trailing frames, cubes, sketches, reconciliation and bucketed tables."""

from __future__ import annotations

import random
import uuid
from datetime import date, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyloom.operators.frames import trailing_days, trailing_rows
from tallyloom.operators.reconcile import reconcile
from tallyloom.operators.sketches import daily_sketches, estimates, merged
from tallyloom.operators.star import Star
from tallyloom.plans import analyses, reports
from tallyloom.sinks.bucketed import save_bucketed

DAY = date(2020, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sales(spark, n, seed=1):
    rng = random.Random(seed)
    days = [None, *(DAY + timedelta(days=rng.randint(0, 90)) for _ in range(40))]
    rows = [(k, rng.choice(days), rng.choice([None, rng.randint(1, 99)])) for k in range(n)]
    return rows, spark.createDataFrame(rows, "id int, day date, amount int").withColumn("amount", F.col("amount").cast("decimal(18,2)"))


@pytest.mark.parametrize("bin_days", [28, 30, 400])
def test_trailing_days(spark, bin_days):
    rows, table = sales(spark, 200, bin_days)
    got = trailing_days(table, "day", "amount", {"week": 7, "month": 28}, bin_days)

    def total(day, width):
        mine = [a for _, d, a in rows if d and day and 0 <= (day - d).days < width and a is not None]
        return float(sum(mine)) if mine else None

    want = [(k, total(d, 7), total(d, 28)) for k, d, _ in rows]
    assert rows_of(got.selectExpr("id", "double(week) week", "double(month) month"), "id", "week", "month") == sorted(want, key=repr)
    assert "SinglePartition" not in plan_of(got)
    with pytest.raises(ValueError):
        trailing_days(table, "day", "amount", {"year": 366}, 365)


@pytest.mark.parametrize("stretch", [1, 17, 10_000])
def test_trailing_rows(spark, stretch):
    rows, table = sales(spark, 150)
    got = trailing_rows(table, [F.col("day").asc_nulls_first(), F.col("id")], "amount", 10, "ten", stretch)
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or DAY, r[0]))
    want = []
    for k, r in enumerate(order):
        mine = [a for _, _, a in order[max(0, k - 9) : k + 1] if a is not None]
        want.append((r[0], float(sum(mine)) if mine else None))
    assert rows_of(got.selectExpr("id", "double(ten) ten"), "id", "ten") == sorted(want, key=repr)
    assert got.columns == [*table.columns, "ten"]
    assert trailing_rows(table.limit(0), [F.col("id")], "amount", 5, "five").collect() == []


def test_trailing_rows_are_spread_though_one_day_holds_all(spark):
    table = spark.range(5000).select("id", F.lit(DAY).alias("day"), F.lit(1).cast("decimal(18,2)").alias("amount"))
    got = trailing_rows(table, [F.col("day"), F.col("id")], "amount", 100, "sum", stretch=500)
    assert got.filter("sum <> least(id + 1, 100)").isEmpty() and got.count() == 5000
    window = [line for line in plan_of(got).splitlines() if "Window [" in line]
    assert "_bin" in window[0] and all("sum(_rows" in line for line in window[1:])  # one row per partition there


def test_cube_tells_totals_from_unknown_members(spark):
    fact = spark.createDataFrame(
        [(1, 10, 20200101, 5), (1, 99, 20200101, 7), (8, 10, 20200401, 2)],
        "product_key long, customer_key long, date_key int, total_amount int",
    )
    star = Star(
        spark.createDataFrame([(20200101, 2020, 1), (20200401, 2020, 2)], "date_key int, year int, quarter int"),
        spark.createDataFrame([(10, "B2B")], "customer_key long, segment string"),
        None,
        spark.createDataFrame([(1, "toys")], "product_key long, category string"),
        fact,
    )
    got = {(r["category"], r["segment"], r["quarter"], r["level"]): r["revenue"] for r in reports.revenue_cube(star).collect()}
    assert got[None, None, None, 7] == 14.0
    assert got["toys", None, None, 3] == 12.0 and got["toys", None, "2020-Q1", 0] == 7.0
    assert got[None, "B2B", None, 5] == 7.0 and got[None, None, None, 5] == 7.0  # the unknown segment's total
    assert got[None, None, "2020-Q2", 6] == 2.0
    assert plan_of(reports.revenue_cube(star)).count("Expand") == 1


def test_sketches_merge_to_any_period(spark):
    rows = [(20200101 + k % 28, k * 7 % 3000, float(k % 1000)) for k in range(20_000)]
    fact = spark.createDataFrame(rows, "date_key int, customer_key long, total_amount double")
    daily = daily_sketches(fact)
    once = estimates(merged(daily, F.lit(1).alias("all")), (0.1, 0.5, 0.9)).first()
    twice = estimates(merged(merged(daily, F.expr("date_key % 5").alias("k")), F.lit(1).alias("all"))).first()
    assert once["orders"] == twice["orders"] == 20_000
    assert abs(once["unique_customers"] - 3000) <= 150 and abs(twice["unique_customers"] - 3000) <= 150
    assert all(abs(v - q) <= 30 for v, q in zip(once["amount_quantiles"], (100, 500, 900), strict=True))


def test_reconciliation_names_each_fault(spark):
    kinds = "id string, a int, b string"
    source = [("same", 1, None), ("lost", 1, "x"), ("twice", 1, "x"), ("thin", 1, "x"), ("thin", 1, "x"),
              ("other", 1, None), (None, 1, "x"), ("swap", 1, "x"), ("swap", 2, "y"), ("mixed", 1, "x"), ("mixed", 2, "x")]
    target = [("same", 1, None), ("twice", 1, "x"), ("twice", 1, "x"), ("thin", 1, "x"), ("other", 1, ""),
              ("new", 1, "x"), ("swap", 2, "y"), ("swap", 1, "x"), ("mixed", 1, "x"), ("mixed", 1, "x")]
    got = reconcile(spark.createDataFrame(source, kinds), spark.createDataFrame(target, kinds), ["id"], ["a", "b"])
    assert rows_of(got, "id", "fault", "in_source", "in_target") == sorted(
        [("lost", "lost", 1, 0), ("twice", "doubled", 1, 2), ("thin", "thinned", 2, 1), ("other", "changed", 1, 1),
         (None, "lost", 1, 0), ("new", "added", 0, 1), ("mixed", "changed", 2, 2)], key=repr,
    )
    empty = spark.createDataFrame([], kinds)
    assert reconcile(empty, empty, ["id"], ["a"]).collect() == []


@pytest.fixture(scope="module")
def bucketed(spark, lazy_star):
    name = f"t_{uuid.uuid4().hex}"
    fact = save_bucketed(lazy_star.fact_sales, name, "customer_key", 4)
    customers = save_bucketed(lazy_star.dim_customer, f"{name}_c", "customer_key", 4)
    yield Star(lazy_star.dim_date, customers, lazy_star.dim_supplier, lazy_star.dim_product, fact)
    for table in (name, f"{name}_c"):
        spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("analysis", [analyses.customer_ltv, analyses.rfm_segmentation, analyses.customer_churn])
def test_bucketed_fact_gives_the_same(spark, params, lazy_star, bucketed, analysis):
    columns = analysis(lazy_star, params).columns
    assert rows_of(analysis(bucketed, params), *columns) == rows_of(analysis(lazy_star, params), *columns)


def test_bucketed_fact_is_not_shuffled(spark, bucketed):
    grouped = bucketed.fact_sales.groupBy("customer_key").agg(F.sum("total_amount").alias("amount"))
    assert "Exchange" not in plan_of(grouped)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = bucketed.dim_customer.join(grouped, "customer_key", "left")
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    calendar = bucketed.dim_date.cache()  # its size is known then, so it is broadcast and the fact stays as it lies
    calendar.count()
    star = Star(calendar, bucketed.dim_customer, None, None, bucketed.fact_sales)
    for analysis in (analyses.customer_ltv, analyses.customer_churn):
        assert "hashpartitioning(customer_key" not in plan_of(analysis(star))
    calendar.unpersist()
