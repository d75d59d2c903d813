"""Session settings, and staging of intermediate tables in shared storage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_scope: ContextVar[str | None] = ContextVar("staging_scope", default=None)


def build_session(app_name: str = "tallyloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the plans in this package count on.

    AQE is what joins and aggregates rely on at scale: it coalesces small shuffle
    partitions, splits skewed join partitions and turns a sort-merge join into a
    broadcast join once the real size of a side is known.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k: str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """This application's folder in the shared checkpoint directory."""
    configured = spark.conf.get(_CHECKPOINT_CONF, None)
    if configured:
        return f"{configured.rstrip('/')}/tallyloom/{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            f"{_CHECKPOINT_CONF} is not set: a cluster needs a shared folder for staged tables"
        )
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tallyloom-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(staging_root(spark))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the planner
    the real size of the data, so that a later join is broadcast only if the table
    is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    folder = _scope.get() or staging_root(spark)
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_parallel(spark: SparkSession, *tasks: Callable) -> list:
    """Results of independent tasks; the jobs they submit run beside each other.

    Tasks see the caller's staging scope and job properties. The first failure is raised
    when all have ended.
    """
    contexts = [copy_context() for _ in tasks]
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        started = [
            pool.submit(c.run, inheritable_thread_target(spark)(task))
            for c, task in zip(contexts, tasks, strict=True)
        ]
    return [task.result() for task in started]


@contextmanager
def staging_scope(spark: SparkSession):
    """Tables staged inside the block are deleted at its end.

    For jobs that write their results inside the block: frames that still read a
    staged table must not leave it.
    """
    folder = f"{staging_root(spark)}/scope-{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        _delete(spark, folder)


def release_staged(spark: SparkSession) -> None:
    """Delete all staged tables of this application."""
    _delete(spark, staging_root(spark))
