"""What the operators share: input columns, staging, split of labelled rows, partition counts."""

from __future__ import annotations

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import stage

__all__ = ["documents", "keyed_documents", "read", "remainder", "row_key", "stage", "text_size", "parts_for"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (and ``more``) alone, whatever else the table has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more)


def row_key() -> Column:
    """The doc_id; for a row without one a number below -2^62 that follows from its text.

    So rows without an id can be judged too: those of one text alike.
    """
    of_text = F.pmod(F.xxhash64("text"), F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), -of_text - F.lit((1 << 62) + 1))


def keyed_documents(docs: DataFrame) -> DataFrame:
    """``documents`` with the row key in the place of doc_id."""
    return docs.select(row_key().alias("doc_id"), "text")


def remainder(n: int) -> Column:
    """crc32 of the id's digits modulo ``n``: the fold of a document."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def send_model(spark: SparkSession, model: object) -> Broadcast:
    """A broadcast of a model's bytes, with its class in them; a task opens it with ``pickle.loads``.

    A plain broadcast would name the class only, and executors need not have this package.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def text_size(docs: DataFrame) -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts_for(size: int, each: int, least: int) -> int:
    """Number of parts of about ``each`` bytes, so that a part's size doesn't grow with the data."""
    return max(least, -(-size // each))


def _stretch(size: int) -> Column:
    """The text, or ``size`` bytes of a longer one, without the characters cut at its ends."""
    more = F.octet_length("text") - size
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), more + 1).cast("int") + 1
    part = F.substring(F.col("text").cast("binary"), place, F.lit(size)).cast("string")
    return F.when(more > 0, F.trim(F.make_valid_utf8(part), F.lit("\ufffd"))).otherwise(F.col("text"))


def labelled_sample(
    docs: DataFrame, known: DataFrame, folds: int, held: int, sample: int, size: int
) -> pa.Table:
    """At most ``sample`` documents of each label, at most ``size`` bytes of each: text and label.

    ``known`` has doc_id and label. Documents of the held-out fold, and rows without id or
    label, take no part. Rows of one document count once, with the largest label. Documents are
    chosen by a hash of their id, so the choice is the same on every run. First ids alone are
    chosen: a share of the hashes that leaves about twice the sample of each label, and the
    smallest of these; so the window sees a bounded number of rows. Then their texts are read, of
    a longer one a stretch of ``size`` bytes at a place given by the hash of its id.
    """
    known = (
        known.select(F.col("doc_id").cast("long").alias("doc_id"), "label")
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (remainder(folds) != held))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    known = known.join(documents(docs).select("doc_id"), "doc_id", "left_semi")
    known = stage(known.withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))), "labelled")
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("_all"))  # one row a label
    share = F.lit(2.0 * sample * (1 << 40)) / F.col("_all")
    some = known.join(F.broadcast(sizes), "label").filter(F.col("_h") < share)
    order = Window.partitionBy("label").orderBy("_h", "doc_id")
    chosen = some.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= sample)
    chosen = stage(chosen.select("doc_id", "label"), "sample")  # ``sample`` rows a label at most
    rows = documents(docs).join(F.broadcast(chosen), "doc_id")
    rows = rows.withColumn("text", _stretch(size)).dropDuplicates(["doc_id"])
    return rows.orderBy("doc_id").select("text", "label").toArrow()
