"""Merging a batch into tables that are already loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_rows(
    batch: DataFrame, loaded: DataFrame, key: str, small_batch: bool = False
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``loaded``; NULL keys are equal.

    One anti join on the plain key, so that a later de-duplication or join by it finds
    the batch partitioned already, and the loaded keys are shuffled once. Whether NULL is
    loaded is one look-up that the scan's statistics answer. A batch known to be small is
    best not met by all loaded keys: ``small_batch`` first cuts them down to those of the
    batch by a semi join, which is planned as a broadcast while the batch's keys are below its limit. Rows of one key stay or go
    together, so this may be done before the batch is de-duplicated.
    """
    held = loaded.select(F.col(key).alias("_held"))
    if not held.filter(F.col("_held").isNull()).isEmpty():
        batch = batch.filter(F.col(key).isNotNull())
    if small_batch:
        keys = batch.select(F.col(key).alias("_wanted"))
        held = held.join(keys, F.col("_held") == F.col("_wanted"), "left_semi")
    return batch.join(held, F.col(key) == F.col("_held"), "left_anti")


def upsert(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Type 1 merge: batch rows replace rows of their key, other rows stay."""
    keys = batch.select(F.col(key).alias("_key"))
    kept = existing.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    return kept.unionByName(batch.select(existing.columns))
