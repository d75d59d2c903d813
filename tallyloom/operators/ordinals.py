"""Row order of a source.

Spark tables have no row order, but two rules depend on one: "keep the first copy"
and "the last event wins". Every raw frame therefore carries an ``_ordinal`` struct
that sorts like the source. File sources take it from the scan itself, so no sort
or single partition is needed to know it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.global_order import row_index

ORDINAL = "_ordinal"
# Raw orders may carry it: a column of which each order id has one value and by which they are dealt already.
# The same for orders, returns and shipping events together: one value for an order id in all three, and for a return id.
DEALT = "_dealt"
HOME = "_home"
_FILE_FIELDS = ["file", "block", "pos"]


def scan_ordinal():
    """Ordinal of a file scan: file, split start, then position in the split.

    ``monotonically_increasing_id`` is only compared within one split, which one
    task reads from start to end, so retries and re-planning do not change the order.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    ).alias(ORDINAL)


def with_ordinal(df: DataFrame) -> DataFrame:
    """Give a frame without ``_ordinal`` its present row order as ordinal."""
    if ORDINAL in df.columns:
        return df
    return df.withColumn(ORDINAL, F.struct(F.monotonically_increasing_id().alias("pos")))


def source_order(df: DataFrame) -> list[Column]:
    """Sort keys of the source order for range partitioning."""
    return [F.col(f"{ORDINAL}.{f}") for f in df.schema[ORDINAL].dataType.fieldNames()]


def data_columns(df: DataFrame) -> list[str]:
    """The columns of the source itself."""
    return [c for c in df.columns if not c.startswith("_")]


def with_row_index(df: DataFrame, keep: Column, out: str = "row_index") -> DataFrame:
    """The rows of a whole source that satisfy ``keep``, with their 0-based position.

    For a file source only the rows per split are counted: a position is the rows in
    earlier splits plus the offset within the split, so nothing is sorted and only
    the kept rows are touched. Other sources are range-partitioned by their ordinal.
    """
    if df.schema[ORDINAL].dataType.fieldNames() != _FILE_FIELDS:
        return row_index(df, source_order(df), out=out, start=0).filter(keep)
    splits = df.groupBy(
        F.col("_ordinal.file").alias("_file"), F.col("_ordinal.block").alias("_block")
    ).agg(F.count(F.lit(1)).alias("_rows"), F.min("_ordinal.pos").alias("_first"))
    # One row per input split, so this window stays small at any table size.
    before = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return (
        df.filter(keep)
        .withColumn("_file", F.col("_ordinal.file"))
        .withColumn("_block", F.col("_ordinal.block"))
        .join(splits, ["_file", "_block"])
        .withColumn(out, F.col("_before") + F.col("_ordinal.pos") - F.col("_first"))
        .drop("_file", "_block", "_rows", "_first", "_before")
    )
