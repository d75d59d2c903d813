"""Differences between a source and what was loaded from it, as multisets of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.history import row_hash


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A row per key whose rows differ: keys, fault, rows in the source and in the target.

    Rows are equal if all ``columns`` are, NULLs included; copies are counted. Faults are *lost* and
    *added* keys, *doubled* ones (all versions are there, some too often), *thinned* ones (some
    too rarely), and *changed* ones (other versions). Both sides are reduced to counts
    per key and row hash before the shuffle, and only keys with a difference go further.
    """
    def side(df: DataFrame, s: int, t: int) -> DataFrame:
        return df.select(*keys, row_hash(columns).alias("_hash"), F.lit(s).alias("_s"), F.lit(t).alias("_t"))

    counted = (
        side(source, 1, 0).unionByName(side(target, 0, 1))
        .groupBy(*keys, "_hash").agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    )
    by_key = counted.groupBy(*keys).agg(
        F.sum("_s").alias("in_source"),
        F.sum("_t").alias("in_target"),
        F.sum(F.greatest(F.col("_s") - F.col("_t"), F.lit(0))).alias("_short"),
        F.sum(F.greatest(F.col("_t") - F.col("_s"), F.lit(0))).alias("_over"),
        F.max((F.col("_s") == 0) | (F.col("_t") == 0)).alias("_other"),
    )
    fault = (
        F.when(F.col("in_target") == 0, "lost")
        .when(F.col("in_source") == 0, "added")
        .when(F.col("_other"), "changed")
        .when(F.col("_over") > 0, F.when(F.col("_short") > 0, "changed").otherwise("doubled"))
        .otherwise("thinned")
    )
    return by_key.filter("_short > 0 OR _over > 0").select(*keys, fault.alias("fault"), "in_source", "in_target")
