"""Keep one copy of each key, chosen by source order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.ordinals import ORDINAL, with_ordinal


def keep_first(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the first by source order; NULL keys count as equal.

    ``dropDuplicates`` would keep an arbitrary copy. The ``row_number() = 1`` form is
    planned with a partial group limit *before* the shuffle, so each map task sends
    at most one row per key and a key that holds a third of the table does no harm.
    """
    return _keep_one(df, keys, backwards=False)


def keep_last(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the last by source order."""
    return _keep_one(df, keys, backwards=True)


def _keep_one(df: DataFrame, keys: list[str], backwards: bool) -> DataFrame:
    df = with_ordinal(df)
    ordinal = F.col(ORDINAL).desc() if backwards else F.col(ORDINAL).asc()
    order = W.partitionBy(*keys).orderBy(ordinal)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
