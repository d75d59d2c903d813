"""Dimension history with validity intervals (slowly changing dimension, type 2).

A history table has one row per observation of a member: the key, its attributes, the day from
which they hold, and a hash of the attributes. An observation with the attributes of the one before
opens no version, but stays: rows may come late, and one that falls between two equal
observations must split them. So the state after some batches doesn't depend on their order.

A batch is merged by rebuilding the intervals of the members it names, and of no others. Equal
(key, day) pairs are reduced before the shuffle, so a member has one row a day at most in the
window that finds the ends of its versions, however hot it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HISTORY_COLUMNS = ["valid_from", "valid_to", "opens", "row_hash"]


def row_hash(attributes: Sequence[str]) -> Column:
    """Hash of attributes; NULL differs from the empty text and from a value beside it."""
    return F.sha2(F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}), 256)


def _with_intervals(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mark the observations that open a version, and give these the day before which they hold."""
    order = W.partitionBy(*keys).orderBy("valid_from")
    before = F.lag("row_hash").over(order)
    marked = rows.withColumn("opens", ~before.eqNullSafe(F.col("row_hash")))
    opening = F.when(F.col("opens"), F.col("valid_from"))
    later = F.first(opening, ignorenulls=True).over(order.rowsBetween(1, W.unboundedFollowing))
    return marked.withColumn("valid_to", F.when(F.col("opens"), later))


def merge_history(
    history: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    at: str,
    order: str | None = None,
    forget_before: Column | None = None,
) -> DataFrame:
    """The history after a batch of observations, each with a day ``at`` from which it holds.

    Of several rows of one member and day in a batch, the one with the largest ``order`` counts (by
    default the largest hash), and a batch overrules what was known for that day. Rows without key
    or day are ignored, as they can't be placed. Observations before ``forget_before`` that open
    no version are dropped, which bounds the table where full snapshots come in; rows that come
    even later than that are then placed among the versions alone.
    """
    known = F.lit(True)
    for name in (*keys, at):
        known = known & F.col(name).isNotNull()
    rank = F.struct(*([order] if order else []), "row_hash")
    fresh = (
        batch.filter(known)
        .select(*keys, *attributes, F.col(at).alias("valid_from"), row_hash(attributes).alias("row_hash"),
                *([order] if order else []))
        .groupBy(*keys, "valid_from")
        .agg(F.max_by(F.struct(*attributes, "row_hash"), rank).alias("_row"))
        .select(*keys, "_row.*", "valid_from")
    )
    columns = [*keys, *attributes, "row_hash", "valid_from"]
    if history is None:
        merged, rest = fresh.select(columns), None
    else:
        named = fresh.select(*keys).distinct()
        touched = history.join(named, list(keys), "left_semi").select(columns)
        rest = history.join(named, list(keys), "left_anti")
        held = touched.join(fresh.select(*keys, "valid_from"), [*keys, "valid_from"], "left_anti")
        merged = held.unionByName(fresh.select(columns))
    merged = _with_intervals(merged, keys).select(*keys, *attributes, *HISTORY_COLUMNS)
    if rest is not None:
        merged = merged.unionByName(rest.select(merged.columns))
    if forget_before is not None:
        merged = merged.filter(F.col("opens") | (F.col("valid_from") >= forget_before))
    return merged


def versions(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per version: half-open validity, a running number per member, and the current one."""
    number = F.row_number().over(W.partitionBy(*keys).orderBy("valid_from"))
    return (
        history.filter("opens")
        .withColumn("version", number)
        .withColumn("is_current", F.col("valid_to").isNull())
        .drop("opens", "row_hash")
    )


def interval_faults(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions that overlap the next one of their member, leave a gap to it, or are empty."""
    order = W.partitionBy(*keys).orderBy("valid_from")
    following = F.lead("valid_from").over(order)
    fault = (
        F.when(F.col("valid_to") <= F.col("valid_from"), "empty")
        .when(~F.col("valid_to").eqNullSafe(following) & (F.coalesce("valid_to", following) > following), "overlap")
        .when(F.col("valid_to").isNull() & following.isNotNull(), "overlap")
        .when(~F.col("valid_to").eqNullSafe(following), "gap")
    )
    return versions.withColumn("fault", fault).filter("fault IS NOT NULL")
