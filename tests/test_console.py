import threading
import time

import pytest

from tallyloom.plans.console import (
    Console,
    QueryRefusedError,
    QueryTimeoutError,
    run_with_deadline,
    validate_readonly_sql,
)
from tallyloom.plans.named import UnknownQueryError
from tallyloom.sinks.warehouse import Warehouse


@pytest.fixture(scope="module")
def console(spark, tmp_path_factory, star, params):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("console") / "wh"))
    warehouse.load_full(star)
    console = Console(warehouse, params)
    console.open()
    return console


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT order_id, total_amount FROM fact_sales ORDER BY 2 DESC LIMIT 3",
        "\n  select max(retail_price) from dim_product\n",
        "WITH big AS (SELECT * FROM fact_sales WHERE quantity > 2) SELECT count(*) FROM big",
        "SELECT name FROM dim_customer ;",
        "",
        "SELECT replace('update', 'a', 'delete') AS created -- drop table x",
        "SELECT f.*, d.* FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key",
    ],
)
def test_allowed(console, sql):
    assert validate_readonly_sql(console.session, sql) is None


@pytest.mark.parametrize(
    "sql",
    [
        "DROP VIEW dim_product",
        "DELETE FROM fact_sales WHERE quantity > 1",
        "SELECT name FROM dim_customer; DROP VIEW dim_customer",
        "UPDATE dim_supplier SET country = 'FR'",
        "PRAGMA database_list",
        "SELECT name FROM pragma_table_list()",
        "WITH RECURSIVE n(i) AS (SELECT 0 UNION ALL SELECT i + 1 FROM n) SELECT max(i) FROM n",
        "WITH t AS (SELECT 1) INSERT INTO dim_product SELECT * FROM t",
        "SET spark.sql.ansi.enabled=false",
        "SELECT reflect('java.lang.System', 'exit', 1)",
        "SELECT `java_method`('java.lang.System', 'nanoTime')",
        "SELECT IDENTIFIER('ref' || 'lect')('java.lang.System', 'nanoTime')",
        "SELECT 'it''s', try_reflect /* x */ ('java.lang.System', 'nanoTime')",
        "SELECT 'a\\'', reflect('java.lang.System', 'nanoTime') --'",
        "SELECT r'\\', reflect('java.lang.System', 'nanoTime'), 'b'",
        "SELECT 1 AS `'`, reflect('java.lang.System', 'nanoTime') AS `'`",
        "SELECT \"'\", reflect('java.lang.System', 'nanoTime'), \"'\"",
        "SELECT * FROM parquet.`/etc`",
        "SELECT 1) AS a CROSS JOIN (SELECT 2; SELECT 3",
        "CREATE TABLE x AS SELECT 1",
    ],
)
def test_refused(console, sql):
    assert validate_readonly_sql(console.session, sql) is not None
    with pytest.raises(QueryRefusedError):
        console.execute_raw(sql)


def test_raw_result_keeps_order_and_names(console):
    df = console.execute_raw("SELECT order_id, count(*) FROM fact_sales GROUP BY 1 ORDER BY 1 DESC;")
    assert df.columns == ["order_id", "count(1)"]
    assert [r.order_id for r in df.collect()][:2] == ["B-106", "B-105"]
    assert console.execute_raw("SELECT 1 AS x, NULL AS y").first()[:] == (1, None)
    assert console.execute_raw("  ").count() == 0


def test_all_tables_can_be_queried(console):
    for name in console.open():
        console.execute_raw(f"SELECT * FROM {name}").collect()


def test_julianday_text_runs(console):
    df = console.execute_raw(
        "SELECT d.year || '-Q' || d.quarter AS q, printf('%02d', d.month) AS m, "
        "julianday('2026-01-01') - julianday(MAX(d.full_date)) AS age "
        "FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key "
        "GROUP BY d.year, d.quarter, d.month ORDER BY q, m"
    )
    assert df.first()[:] == ("2024-Q1", "02", 679.0)


def test_invalid_sql_is_refused(console):
    with pytest.raises(QueryRefusedError):
        console.execute_raw("SELECT nope FROM fact_sales")


def test_runaway_query_is_cancelled(console):
    started = time.monotonic()
    with pytest.raises(QueryTimeoutError, match="cancelled after 1.0 seconds"):
        console.execute_raw(
            "SELECT count(*) FROM range(10000000) a JOIN range(10000000) b "
            "ON a.id % 7 < b.id % 11",
            timeout=1.0,
        )
    assert time.monotonic() - started < 30


def test_other_errors_pass_the_deadline(console):
    def fail():
        raise RuntimeError("x")

    with pytest.raises(RuntimeError):
        run_with_deadline(console.spark, 5, fail)
    assert console.spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_named_queries_and_kpis(console):
    assert len(console.available_queries()) == 15
    assert console.execute_query("revenue_trends").count() == 4
    assert console.kpis()["total_revenue"] == 733.9
    with pytest.raises(UnknownQueryError):
        console.execute_query("nonexistent_query")


def test_a_literal_that_looks_like_a_call_is_fine(console):
    assert console.execute_raw("SELECT 'reflect (x)' AS t").first().t == "reflect (x)"


def test_overlapping_queries_keep_to_themselves(spark, console, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "rows"))
    before = spark.conf.get("spark.sql.runSQLOnFiles")
    other, seen = Console(console.warehouse), {}

    def slow():
        text = "SELECT count(*) AS n FROM range(300000000) WHERE id % 7 = 1"
        seen["slow"] = console.execute_raw(text, timeout=120).first().n

    thread = threading.Thread(target=slow)
    thread.start()
    with pytest.raises(QueryRefusedError):
        other.execute_raw(f"SELECT * FROM parquet.`{tmp_path}/rows`")
    assert spark.sql(f"SELECT * FROM parquet.`{tmp_path}/rows`").count() == 3
    thread.join()
    assert seen["slow"] == 42857143
    assert spark.conf.get("spark.sql.runSQLOnFiles") == before
    assert not spark.catalog.tableExists("fact_sales")


def test_the_callers_job_group_is_put_back(spark, console):
    context = spark.sparkContext
    context.setJobGroup("mine", "my work")
    try:
        console.execute_raw("SELECT 1")
        assert context.getLocalProperty("spark.jobGroup.id") == "mine"
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            context.setLocalProperty(name, None)
