"""Trailing sums over bounded frames of a whole table, without one task that holds it all.

A window without PARTITION BY moves all rows into one task. With a bounded frame, a row needs only
its neighbours: rows are dealt to stretches of the order, and those at the end of a stretch are
also sent to the next one (its *halo*), where they are in frames but give no result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.global_order import row_index

_WIDE = "decimal(38,2)"


def trailing_days(df: DataFrame, day: str, value: str, widths: Mapping[str, int], bin_days: int = 366) -> DataFrame:
    """``df`` with the sum of ``value`` over the last days, the row's own included, per width.

    All rows of a day have the same frame, so days are summed before any shuffle of rows; the halo
    is put to the table of days. Rows without a day get NULL. A day with a large share of
    the rows is one row here, and meets the rows by a join that AQE splits.
    """
    if max(widths.values()) > bin_days:
        raise ValueError("a frame must fit into a stretch")
    number = F.unix_date(F.col(day))
    totals = df.filter(F.col(day).isNotNull()).groupBy(F.col(day).alias("_day")).agg(F.sum(value).cast(_WIDE).alias("_sum"))
    at = F.unix_date("_day")
    home = F.floor(at / bin_days)
    last = F.floor((at + max(widths.values()) - 1) / bin_days)
    spread = totals.withColumn("_home", home).withColumn("_bin", F.explode(F.sequence(home, last)))
    order = W.partitionBy("_bin").orderBy(at)
    sums = {name: F.sum("_sum").over(order.rangeBetween(1 - width, 0)) for name, width in widths.items()}
    framed = spread.withColumns(sums).filter("_bin = _home").select(F.unix_date("_day").alias("_number"), *widths)
    return df.join(framed, number == F.col("_number"), "left").drop("_number")


def trailing_rows(
    df: DataFrame, order_by: Sequence[Column], value: str, rows: int, out: str, stretch: int = 1_000_000
) -> DataFrame:
    """``df`` with the sum of ``value`` over the last ``rows`` rows of a unique order, its own included.

    Rows are numbered by the range layout, and a stretch is so many numbers: equal stretches however
    the order's values are spread. The last rows of one go to the next as well.
    """
    stretch = max(stretch, rows)
    numbered = row_index(df, order_by, out="_n", start=0)
    home = F.floor(F.col("_n") / stretch)
    last = F.floor((F.col("_n") + rows - 1) / stretch)
    spread = numbered.withColumn("_home", home).withColumn("_bin", F.explode(F.sequence(home, last)))
    frame = W.partitionBy("_bin").orderBy("_n").rowsBetween(1 - rows, 0)
    return (
        spread.withColumn(out, F.sum(F.col(value)).over(frame))
        .filter("_bin = _home")
        .drop("_n", "_home", "_bin")
    )
