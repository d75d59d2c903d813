"""Joins on time: the version valid at a moment, and all intervals that hold it.

Neither is an equality, so as plain conditions Spark would compare every pair of a key, or of
the whole tables. Both are brought to equalities on the key and a time bin here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _bin(time: Column, kind: T.DataType, days: int) -> Column:
    """Number of the stretch of ``days`` days that holds a date or timestamp."""
    day = time if isinstance(kind, T.DateType) else F.to_date(time)
    return F.floor(F.unix_date(day) / days)


def _present(df: DataFrame, names: Sequence[str]) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & df[name].isNotNull()
    return out


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    since: str,
    columns: Sequence[str],
    bin_days: int = 366,
) -> DataFrame:
    """``left`` with ``columns`` of the last row of ``right`` of its key that begins no later.

    Both sides are put into one table ordered by key and time, in which the last version seen is
    carried forward. Windows are by key and time bin, so a hot key is spread over as many tasks as
    it has bins. What a bin starts with comes from a table of the last version per key and bin,
    which is reduced before its shuffle. The rows themselves are shuffled once.

    Left rows without key or time, or before the first version, get NULL. Of several versions of one
    key and time the largest (by ``columns``) counts.
    """
    kind = left.schema[time].dataType
    value = F.struct(*columns)
    steps = (
        right.filter(_present(right, [*keys, since]))
        .groupBy(*keys, F.col(since).cast(kind).alias("_t"))
        .agg(F.max(value).alias("_v"))
        .withColumn("_bin", _bin(F.col("_t"), kind, bin_days))
    )
    known = _present(left, [*keys, time])
    row = F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("_row")
    rows = left.filter(known).select(*keys, F.col(time).alias("_t"), row)
    rows = rows.withColumn("_bin", _bin(F.col("_t"), kind, bin_days))
    by_bin = [*keys, "_bin"]

    last = steps.groupBy(*by_bin).agg(F.max_by("_v", "_t").alias("_v"))
    bins = last.unionByName(rows.select(*by_bin).distinct(), allowMissingColumns=True)
    bins = bins.groupBy(*by_bin).agg(F.max("_v").alias("_v"))
    earlier = W.partitionBy(*keys).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    carried = bins.select(*by_bin, F.last("_v", ignorenulls=True).over(earlier).alias("_carried"))

    both = rows.unionByName(steps, allowMissingColumns=True)
    within = W.partitionBy(*by_bin).orderBy("_t", F.col("_row").isNotNull())
    within = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = both.withColumn("_seen", F.last("_v", ignorenulls=True).over(within)).filter("_row IS NOT NULL")
    joined = seen.join(carried, by_bin, "left").withColumn("_seen", F.coalesce("_seen", "_carried"))
    out = joined.select("_row.*", *(F.col(f"_seen.{c}").alias(c) for c in columns))
    kinds = {c: right.schema[c].dataType for c in columns}
    lone = left.filter(~known).select("*", *(F.lit(None).cast(kinds[c]).alias(c) for c in columns))
    return out.unionByName(lone)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    since: str,
    until: str,
    bin_days: int = 31,
) -> DataFrame:
    """All pairs of a left row and a right interval of its key that holds its time.

    Intervals are half open and may overlap; one without an end holds all later times. Each is
    repeated for the time bins it meets (up to the last bin of ``left``), so the join is on key and
    bin, and a long interval meets the rows of its bins only. Rows without key, time or begin join
    nothing. Right columns other than the keys are kept; names must differ from those of ``left``.
    """
    kind = left.schema[time].dataType
    last = left.agg(F.max(_bin(F.col(time), kind, bin_days))).first()[0]  # one number, by a job of its own
    begin, end = F.col(since).cast(kind), F.col(until).cast(kind)
    upto = F.least(_bin(end, kind, bin_days), F.lit(last))  # the one that is not NULL, if an end is
    first = _bin(begin, kind, bin_days)
    spans = (
        right.filter(_present(right, [*keys, since]))
        .filter((upto >= first) & (end.isNull() | (end > begin)))
        .withColumn("_bin", F.explode(F.sequence(first, upto)))
    )
    rows = left.withColumn("_bin", _bin(F.col(time), kind, bin_days))
    pairs = rows.join(spans, [*keys, "_bin"])
    return pairs.filter((F.col(time) >= begin) & (end.isNull() | (F.col(time) < end))).drop("_bin")
