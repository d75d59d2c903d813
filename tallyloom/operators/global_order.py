"""Global positions, running totals and NTILE without a single partition.

A window without PARTITION BY moves all rows into one task. Here the rows are range
partitioned instead and the result is put together in two steps:

1. range-partition by a *unique* order, sort each partition, note ``(partition,
   slot)`` for each row, and write that layout once (:func:`tallyloom.session.stage`).
   Range bounds are sampled, so both later reads must see one and the same layout.
2. count (or sum) per partition, turn that into offsets - one row per partition, so
   it is always small enough to broadcast - and add the offset to the local value.

The order must be unique (add a tie-break column): then the ranges are even, however
many rows share one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import stage

_SLOT_BITS = 33  # fixed value: width of the row part of monotonically_increasing_id
_SLOT_MASK = (1 << _SLOT_BITS) - 1
_TEMPORARY = ["_part", "_slot", "_rows", "_offset"]
_WIDE = T.DecimalType(38, 2)


def _layout(df: DataFrame, label: str) -> DataFrame:
    """``df`` staged as it is partitioned, with the partition and slot of each row."""
    placed = (
        df.withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _SLOT_BITS))
        .withColumn("_slot", F.col("_at").bitwiseAND(F.lit(_SLOT_MASK)))
        .drop("_at")
    )
    return stage(placed, label)


def range_layout(
    df: DataFrame, order_by: Sequence[Column], label: str, parts: int | None = None, without: Sequence[str] = ()
) -> DataFrame:
    """``df`` staged in global order, but for the columns that only the order needs.

    With ``parts`` there are so many ranges at least, so that a sort fits a task.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = [parts] if parts and parts > usual else []
    return _layout(df.repartitionByRange(*number, *order_by).sortWithinPartitions(*order_by).drop(*without), label)


def _offsets(layout: DataFrame, value: Column, out: str) -> DataFrame:
    """Exclusive running total of ``value`` per partition: one row per partition."""
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return (
        layout.groupBy("_part")
        .agg(F.sum(value).alias("_rows"))
        .select("_part", F.sum("_rows").over(earlier).alias(out))
    )


def row_index(
    df: DataFrame, order_by: Sequence[Column] | None, out: str = "row_index", start: int = 1,
    parts: int | None = None, without: Sequence[str] = (),
) -> DataFrame:
    """Add a dense BIGINT index ``start, start+1, ...`` in the given order.

    Without an order the rows are numbered as they are partitioned: also dense and
    unique, but with no range shuffle and no sort. ``parts`` and ``without`` as in :func:`range_layout`.
    """
    layout = range_layout(df, order_by, "row-index", parts, without) if order_by else _layout(df, "row-index")
    offsets = _offsets(layout, F.lit(1), "_offset")
    begin = F.lit(start).cast("bigint")
    return (
        layout.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.coalesce("_offset", F.lit(0)) + F.col("_slot") + begin)
        .drop(*_TEMPORARY)
    )


def running_total(df: DataFrame, order_by: Sequence[Column], value: str, out: str) -> DataFrame:
    """Add the inclusive running sum of a decimal or integer column."""
    layout = range_layout(df, order_by, "running-total")
    offsets = _offsets(layout, F.col(value), "_offset")
    local = W.partitionBy("_part").orderBy("_slot").rowsBetween(W.unboundedPreceding, 0)
    return (
        layout.withColumn(out, F.sum(value).over(local))
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col(out) + F.coalesce("_offset", F.lit(0)))
        .drop(*_TEMPORARY)
    )


def ntile_of(position: Column, total: Column, tiles: int) -> Column:
    """NTILE of a 0-based position: the first ``total % tiles`` tiles get one row more."""
    size = (total - total % tiles) / tiles
    size = size.cast("bigint")
    extra = total % tiles
    in_large = extra * (size + 1)
    tile = F.when(
        position < in_large, F.floor(position / (size + 1)) + 1
    ).otherwise(extra + F.floor(F.try_divide(position - in_large, size)) + 1)
    return tile.cast("int")


def ntile_scores(
    df: DataFrame, key: str, measures: dict[str, Column], scores: dict[str, str], tiles: int = 5
) -> DataFrame:
    """NTILE by several measures at once, each ascending, ties broken by ``key``.

    ``df`` has one row per ``key``. ``measures`` maps a measure name to the value it
    is ranked by, ``scores`` maps it to the name of its score column. All measures
    are ranked in *one* range shuffle: a row per (measure, value, key) is laid out in
    order, and since every measure has the same number of rows, the position within
    a measure is the global position minus a multiple of that number. Returns the
    key, the ranked values (DECIMAL) and the scores.
    """
    names = list(measures)
    ranked = df.select(
        key, F.posexplode(F.array(*[measures[n].cast(_WIDE) for n in names])).alias("_m", "_v")
    )
    layout = range_layout(
        ranked,
        [F.col("_m"), F.col("_v").asc_nulls_first(), F.col(key).asc_nulls_first()],
        "ntile",
    )
    offsets = _offsets(layout, F.lit(1), "_offset")
    total = layout.agg(F.expr(f"count(1) div {len(names)}").alias("_total"))
    position = (
        F.coalesce("_offset", F.lit(0)) + F.col("_slot") - F.col("_m") * F.col("_total")
    )
    scored = (
        layout.join(F.broadcast(offsets), "_part")
        .crossJoin(F.broadcast(total))
        .withColumn("_tile", ntile_of(position, F.col("_total"), tiles))
    )
    pick = [
        F.max(F.when(F.col("_m") == i, F.col(source))).alias(target)
        for i, name in enumerate(names)
        for source, target in (("_v", name), ("_tile", scores[name]))
    ]
    return scored.groupBy(key).agg(*pick)
