"""Orders, returns and shipping events that are dealt by one column meet without an exchange.

A join by that column and an id would shuffle both sides, as Spark joins only what is dealt by all
columns of the join. A union keeps the dealing that its parts share, and a window by more columns
is content with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.ordinals import DEALT

BUCKET_ROWS = 1 << 17  # wide rows of that number take some 40 MB in a sort, of which a task holds up to three
_BUCKETS = "buckets"


def dealt_by(*frames: DataFrame) -> list[str]:
    """The column by which all the frames are dealt, if there is one."""
    return [DEALT] if all(DEALT in df.columns for df in frames) else []


def buckets_for(spark: SparkSession, rows: int) -> int:
    """Number of buckets for so many rows: a bucket keeps its size, so that its sorts fit a task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))


def buckets_of(df: DataFrame) -> int | None:
    """Number of buckets that rows are dealt in."""
    return df.schema[DEALT].metadata.get(_BUCKETS)


def dealing(column: Column, buckets: int) -> Column:
    """``column`` as the one that rows are dealt by, with the number of buckets in its metadata."""
    return column.alias(DEALT, metadata={_BUCKETS: buckets})


def deal(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` dealt in as many buckets as the rows it is to meet."""
    return df.repartition(buckets_of(like) or buckets_for(df.sparkSession, 0), DEALT)


def look_up(rows: DataFrame, key: str, *others: DataFrame) -> DataFrame:
    """Dealt rows with the largest value that each of the others has for their ``key``, like left joins.

    The others consist of the dealt column, the key and a value. NULL keys are equal.
    """
    values = [c for other in others for c in other.columns if c not in (DEALT, key)]
    both = rows.withColumn("_own", F.lit(True))
    for other in others:
        both = both.unionByName(other, allowMissingColumns=True)
    same = W.partitionBy(DEALT, key)
    return both.withColumns({v: F.max(v).over(same) for v in values}).filter("_own").drop("_own")
