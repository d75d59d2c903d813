"""Read-only SQL on the warehouse tables, with a time limit."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tallyloom.params import MartParams
from tallyloom.plans import analyses
from tallyloom.plans.named import available_queries, run_named
from tallyloom.session import ensure_checkpoint_dir
from tallyloom.sinks.warehouse import Warehouse

QUERY_TIMEOUT_SECONDS = 5.0
_POLL_SECONDS = 0.2

# Functions that call arbitrary JVM code, and the clause that spells names from texts.
_JVM_CALLS = re.compile(r"\b(reflect|try_reflect|java_method|identifier)\b", re.IGNORECASE)
#: Quoted names, raw and plain text literals, and comments; words mean nothing but in the first.
_QUOTED = re.compile(
    r"""`(?:``|[^`])*`|(?<!\w)r'[^']*'|(?<!\w)r"[^"]*"|'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|--[^\n]*|/\*.*?\*/""",
    re.DOTALL | re.IGNORECASE,
)
_RECURSIVE = re.compile(r"\bWITH\s+RECURSIVE\b", re.IGNORECASE)
_STARTS = re.compile(r"\(*\s*(SELECT|WITH)\b", re.IGNORECASE)
_GROUP = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")


class QueryRefusedError(ValueError):
    """The text is not a single read-only SELECT."""


class QueryTimeoutError(ValueError):
    """The query ran longer than allowed."""


def tidy(sql: str) -> str:
    return sql.strip().rstrip(";").strip()


def own_session(spark: SparkSession) -> SparkSession:
    """A session of its own for SQL text: its views and settings are nobody else's.

    SQL cannot read files by path in it.
    """
    session = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    return session


def validate_readonly_sql(session: SparkSession, sql: str) -> str | None:
    """Why a text may not run, or None; an empty text is no error.

    The text is analysed, not run, as a subquery. Spark's own grammar allows nothing
    but a query there: DDL, INSERT, SET, a second statement and unbalanced brackets
    are syntax errors. No list of words is needed for that, so ``replace()`` may be used. The
    functions that call JVM methods are refused by name, wherever the name stands outside of
    literals and comments (a column of such a name can't be used).
    """
    text = tidy(sql)
    if not text:
        return None
    if not _STARTS.match(text):
        return "A query must begin with SELECT or WITH."
    if _RECURSIVE.search(text):
        return "WITH RECURSIVE has no bound and is refused."
    bare = _QUOTED.sub(lambda m: m.group() if m.group().startswith("`") else " ", text)
    if _JVM_CALLS.search(bare):
        return "Calling JVM methods is refused."
    try:
        session.sql(f"SELECT * FROM (\n{text}\n) AS _q")
    except PySparkException as exc:
        return f"This is not one valid query: {str(exc).splitlines()[0]}"
    return None


def run_with_deadline(spark: SparkSession, seconds: float, action: Callable):
    """Run a Spark action; cancel its jobs once the time is up.

    One cancellation only stops the jobs of that moment, and a query submits several,
    so a watcher repeats it until the action has returned.
    """
    context = spark.sparkContext
    group = f"deadline-{uuid.uuid4().hex}"
    done, late = threading.Event(), threading.Event()

    def watch() -> None:
        if done.wait(seconds):
            return
        late.set()
        while not done.wait(_POLL_SECONDS):
            context.cancelJobGroup(group)

    watcher = threading.Thread(target=watch, daemon=True)
    before = [context.getLocalProperty(name) for name in _GROUP]
    context.setJobGroup(group, "query with a deadline", interruptOnCancel=True)
    watcher.start()
    try:
        return action()
    except Exception as exc:
        if late.is_set():
            raise QueryTimeoutError(f"Query cancelled after {seconds} seconds.") from exc
        raise
    finally:
        done.set()
        watcher.join()
        for name, value in zip(_GROUP, before, strict=True):
            context.setLocalProperty(name, value)


class Console:
    """Named analyses, KPIs and ad-hoc SQL on a loaded warehouse."""

    def __init__(self, warehouse: Warehouse, params: MartParams | None = None):
        self.warehouse = warehouse
        self.spark = warehouse.spark
        self.params = params or MartParams()
        self.session = own_session(self.spark)
        self._tables = Warehouse(self.session, warehouse.root)

    def available_queries(self) -> list[str]:
        return available_queries()

    def execute_query(self, name: str) -> DataFrame:
        """A named analysis; an unknown name raises :class:`UnknownQueryError`."""
        return run_named(name, self.warehouse.star(), self.params)

    def kpis(self) -> dict:
        return analyses.kpi_snapshot(self.warehouse.star(), self.params).first().asDict()

    def open(self) -> list[str]:
        """Register the tables as views, and ``julianday``, in the console's own session."""
        self.session.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION julianday(day DATE) RETURNS DOUBLE "
            "RETURN unix_date(day) + 2440587.5D"
        )
        return self._tables.register_views()

    def execute_raw(self, sql: str, timeout: float | None = None) -> DataFrame:
        """The result of one read-only SELECT, computed within the time limit.

        The result is written to the checkpoint folder by the executors, in its own
        row order, and returned as a DataFrame: none of it passes the driver.
        """
        self.open()
        error = validate_readonly_sql(self.session, sql)
        if error:
            raise QueryRefusedError(error)
        text = tidy(sql)
        if not text:
            return self.session.createDataFrame([], "empty string")
        ensure_checkpoint_dir(self.spark)
        seconds = QUERY_TIMEOUT_SECONDS if timeout is None else timeout
        return run_with_deadline(
            self.session, seconds, lambda: self.session.sql(text).checkpoint(eager=True)
        )
