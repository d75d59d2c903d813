"""The fact bucketed by a key, so that analyses by that key need no shuffle of it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tallyloom.session import staging_root


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` hash buckets by ``key`` and return it.

    Rows are dealt by the key once, so each bucket is one file (more if a bucket exceeds
    ``spark.sql.files.maxRecordsPerFile``). Grouping and joining by the key then read bucket by bucket.
    Choose the number so that a bucket fits a task; two tables with equal numbers join
    without an exchange on either side. Files go to ``path``, a shared folder.
    """
    spark = df.sparkSession
    path = path or f"{staging_root(spark)}/bucketed-{uuid.uuid4().hex}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key).sortBy(key)
        .option("path", path).mode("overwrite").saveAsTable(name)
    )
    return spark.table(name)
