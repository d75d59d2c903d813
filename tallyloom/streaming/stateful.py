"""Streams with state of their own: the last event of an order, orders with their returns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_LAST = "order_id string, position long, shipping_cost decimal(18,2)"
_STATE = "ids array<string>, positions array<long>, costs array<decimal(18,2)>, expiries array<long>"

_STORE = "spark.sql.streaming.stateStore"
_ON_DISK = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "256",  # of an executor, beside its heap
    "spark.sql.streaming.join.stateFormatVersion": "3",  # one store for a partition, not four
}


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams started inside the block hold their state on the executors' disks, in bounded memory.

    For streams of which one micro-batch may hold more rows than fit in memory. A stream takes the settings when it
    starts; a checkpoint keeps those of its first start.
    """
    before = {key: spark.conf.get(key, None) for key in _ON_DISK}
    for key, value in _ON_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _keep_last(days: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        held = {o: (p, c, e) for o, p, c, e in zip(*state.get, strict=True)} if state.exists else {}
        found: dict[str, list] = {}  # the top event of each order in this micro-batch, and its newest time
        for batch in () if state.hasTimedOut else batches:
            times = batch["event_time"].to_numpy("datetime64[ms]").astype("int64").tolist()
            rows = zip(batch["order_id"], batch["position"].tolist(), batch["shipping_cost"], times, strict=True)
            for order, position, cost, at in rows:
                top = found.setdefault(order, [position, cost, at])
                if position > top[0]:
                    top[:2] = position, cost
                if at > top[2]:
                    top[2] = at
        changed = []
        for order, (position, cost, newest) in found.items():
            was = held.get(order)
            if was is None or position > was[0]:
                changed.append((order, position, cost))
            else:
                position, cost, _ = was
            held[order] = position, cost, max(newest + days * 86_400_000, mark + 1)
        # the timer: no state for orders whose last event is long past
        held = {order: kept for order, kept in held.items() if kept[2] >= mark}
        if held:
            positions, costs, expiries = (list(column) for column in zip(*held.values(), strict=True))
            state.update((list(held), positions, costs, expiries))
            state.setTimeoutTimestamp(max(min(expiries), mark + 1))
        elif state.exists:
            state.remove()
        if changed:
            yield pd.DataFrame(changed, columns=["order_id", "position", "shipping_cost"])

    return run


def last_costs(
    events: DataFrame, delay: str = "30 days", forget_days: int = 365, buckets: int = 4096
) -> DataFrame:
    """A row for each order whose last shipping event changes in a micro-batch.

    ``events`` is a stream of order_id, event_time, position (the event's place in its source)
    and shipping_cost. An order is kept ``forget_days`` beyond its latest event. Orders are dealt to
    ``buckets`` by a hash, and a bucket is one state row and one call: a call costs milliseconds, an order
    in it microseconds. A micro-batch rewrites the buckets that it touches, so choose so many that the
    orders of one, all that are kept, are some ten thousand; a checkpoint keeps its number.
    The events of a hot order come in Arrow batches of bounded size and are not held together. Events
    without order id, position or time are ignored.
    """
    known = events.filter("order_id IS NOT NULL AND position IS NOT NULL AND event_time IS NOT NULL")
    return (
        known.withWatermark("event_time", delay)
        .withColumn("_bucket", F.pmod(F.xxhash64("order_id"), F.lit(buckets)))
        .groupBy("_bucket")
        .applyInPandasWithState(
            _keep_last(forget_days), _LAST, _STATE, "update", GroupStateTimeout.EventTimeTimeout
        )
    )


def keep_updates(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what each micro-batch changes to a folder of its own; a repeated batch replaces its own."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        changes.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The state after all micro-batches: of each key the row of the latest batch."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*columns), "batch").alias("_row")
    return rows.groupBy(*keys).agg(last).select(*keys, "_row.*")


def orders_with_returns(
    orders: DataFrame, returns: DataFrame, within_days: int = 30, delay: str = "10 days"
) -> DataFrame:
    """Orders with the returns made within some days, and orders without any once that is certain.

    Both sides keep state only as long as a partner within the bound can still arrive: orders for
    ``within_days`` and the delay, returns for the delay. A row that comes later than the delay behind
    the slower stream is left out. On tables the same condition is a plain left join. All rows of a micro-batch
    enter the state before any leaves it, so large micro-batches need :func:`state_on_disk`.
    """
    if orders.isStreaming:
        orders, returns = orders.withWatermark("order_time", delay), returns.withWatermark("return_time", delay)
    bound = F.expr(f"""
        order_id = returned_id AND return_time >= order_time
        AND return_time < order_time + INTERVAL {within_days} DAYS""")
    return orders.join(returns.withColumnRenamed("order_id", "returned_id"), bound, "left_outer").drop("returned_id")
