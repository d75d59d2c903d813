"""The six raw sources of the warehouse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.ordinals import ORDINAL, data_columns
from tallyloom.schemas import RAW
from tallyloom.sources.files import read_csv, read_json, read_parquet

# Source name, format and file name below ``<data_dir>/raw``.
SOURCES = {
    "orders": ("csv", "orders.csv"),
    "customers": ("csv", "customers.csv"),
    "returns": ("csv", "returns.csv"),
    "products": ("json", "products.json"),
    "suppliers": ("json", "suppliers.json"),
    "shipping": ("json", "shipping_events.json"),
}


@dataclass
class Extraction:
    """A raw source with its description."""

    name: str
    df: DataFrame
    source_path: str

    @property
    def columns(self) -> list[str]:
        return data_columns(self.df)

    def row_count(self) -> int:
        """Counted by a scan that reads no column."""
        return self.df.count()

    def observed(self) -> tuple[DataFrame, Observation]:
        """The frame with a row count attached that its first action fills in."""
        watch = Observation(f"rows_{self.name}")
        return self.df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def read_source(
    spark: SparkSession, name: str, kind: str, path: str, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Read one named source as csv, json (a list), jsonl, parquet or catalog table.

    Files have an order of rows; a catalog table has none that outlives a rewrite of it, so the
    columns that say which row comes first must be given for a table.
    """
    schema = RAW[name]
    if kind == "csv":
        return read_csv(spark, path, schema)
    if kind in ("json", "jsonl"):
        return read_json(spark, path, schema, json_lines=kind == "jsonl")
    if kind == "parquet":
        return read_parquet(spark, path, schema)
    if kind == "table":
        if not order_by:
            raise ValueError(f"table {path}: order_by must name the columns that order its rows")
        columns = [F.col(f.name).cast(f.dataType) for f in schema.fields]
        return spark.table(path).select(*columns, F.struct(*order_by).alias(ORDINAL))
    raise ValueError(f"unknown source format: {kind}")


def extract_all(
    spark: SparkSession, data_dir: str, overrides: dict[str, tuple] | None = None
) -> dict[str, Extraction]:
    """All six sources below ``data_dir/raw``.

    ``overrides`` maps a source name to another ``(format, path)``, or for a catalog table
    ``("table", name, order columns)``. A missing file raises ``AnalysisException`` when the source is opened.
    """
    unknown = set(overrides or {}) - set(SOURCES)
    if unknown:
        raise KeyError(f"unknown sources: {sorted(unknown)}")
    sources = {}
    for name, (kind, file_name) in SOURCES.items():
        path = f"{data_dir.rstrip('/')}/raw/{file_name}"
        order_by = None
        if overrides and name in overrides:
            kind, path, *more = overrides[name]
            order_by = more[0] if more else None
        sources[name] = Extraction(name, read_source(spark, name, kind, path, order_by), path)
    return sources
