"""File readers. Each returns the declared columns, the other ones as text, and ``_ordinal``.

One rule holds for all formats: columns are found by name, whatever its case and padding;
what is not declared comes along as text, so that the rules see it; a whole number may be
written with a fraction of zero (``1.0``); a value that does not parse becomes NULL, which the
not_null rule reports.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.ordinals import scan_ordinal

CORRUPT = "_corrupt_record"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

Paths = str | Sequence[str]


def _listed(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _typed(text: Column, kind: T.DataType) -> Column:
    """Text as a declared type, NULL if it isn't one."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, _WHOLE):
        exact = F.trim(text).try_cast(T.DecimalType(38, 10))
        return F.when(exact == F.floor(exact), exact).try_cast(kind)
    return F.trim(text).try_cast(kind)


def _declared(df: DataFrame, schema: T.StructType, names: dict[str, str]) -> list[Column]:
    """All columns of ``names`` (their new names), the declared ones with their types first."""
    kinds = {f.name: f.dataType for f in schema.fields}
    others = [n for n in names if n not in kinds]
    return [_typed(F.col(f"`{names[n]}`"), kinds[n]).alias(n) for n in kinds] + [
        F.col(f"`{names[n]}`").cast("string").alias(n) for n in others
    ]


def _unparsed(pairs: list[tuple[Column, T.DataType]]) -> Column:
    """Whether some text is not of its declared type."""
    bad = [(F.trim(text) != "") & _typed(text, kind).isNull() for text, kind in pairs]
    return F.coalesce(reduce(lambda a, b: a | F.coalesce(b, F.lit(False)), bad, F.lit(False)), F.lit(False))


def _must_have(where: object, names: Sequence[str], schema: T.StructType) -> None:
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{where}: missing columns {missing}")


#: Files of one source may differ in their columns; so many different headers are no source any more.
_MOST_HEADERS = 1000


def _headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first line that isn't empty of each file: file, line. Tasks read the files; one job."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )
    first = F.min_by("value", "pos").alias("line")
    return lines.filter((F.col("block") == 0) & (F.trim("value") != "")).groupBy("file").agg(first)


def _by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below the paths by their normalised header.

    Only the different headers come to the driver (usually one), and where there are several, the
    names of the files of each, which the driver's own listing of the files holds too.
    """
    headers = _headers(spark, paths)
    lines = [r[0] for r in headers.select("line").distinct().limit(_MOST_HEADERS + 1).collect()]
    if len(lines) > _MOST_HEADERS:
        raise ValueError(f"{paths}: more than {_MOST_HEADERS} different headers")
    names = {line: _split_header(line) for line in lines}
    if len(set(names.values())) < 2:
        return dict.fromkeys(names.values(), paths)
    found: dict[tuple[str, ...], list[str]] = {}
    for row in headers.orderBy("file").collect():
        found.setdefault(names[row["line"]], []).append(row["file"])
    return found


def _split_header(line: str) -> tuple[str, ...]:
    return tuple(c.strip().strip("\ufeff").strip().lower() for c in next(csv.reader([line])))


def read_csv(
    spark: SparkSession,
    path: Paths,
    schema: T.StructType,
    keep_corrupt: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header row in every file.

    Files of one source may have their columns in different order: they are read by groups of
    one header each, which a first job over the lines finds out. Quotes inside a quoted field are doubled. ``multiline`` also reads line
    breaks inside quotes, at the price of one task per file. ``keep_corrupt`` keeps the raw
    line of a row whose number of fields doesn't fit its header.
    """
    groups = _by_header(spark, _listed(path))
    if not groups:
        groups = {tuple(spark.read.option("header", True).csv(_listed(path)).columns): _listed(path)}
    parts = []
    for header, members in groups.items():
        _must_have(path, header, schema)
        scan = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(header))])
        reader = (
            spark.read.option("header", True)
            .option("mode", "PERMISSIVE")
            .option("escape", '"')
            .option("multiLine", multiline)
            .option("enforceSchema", True)
        )
        if keep_corrupt:
            scan = scan.add(CORRUPT, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        df = reader.schema(scan).csv(members)
        names = {n: f"c{k}" for k, n in enumerate(header) if n}
        corrupt = []
        if keep_corrupt:
            pairs = [(F.col(names[f.name]), f.dataType) for f in schema.fields]
            line = F.when(_unparsed(pairs), F.concat_ws(",", *names.values()))
            corrupt = [F.coalesce(CORRUPT, line).alias(CORRUPT)]
        parts.append(df.select(*_declared(df, schema, names), *corrupt, scan_ordinal()))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_json(
    spark: SparkSession,
    path: Paths,
    schema: T.StructType,
    json_lines: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """A JSON list of flat objects, or JSON lines. Absent keys become NULL.

    Objects are read as maps, so that rows may spell a key in different ways. The names of
    undeclared keys are found by a pass over the keys alone. A list is one document, so each
    such file is read in one task; large sources should be split into many files or landed as
    JSON lines, which are splittable.
    """
    lines = spark.read.text(_listed(path), wholetext=not json_lines)
    kind = "map<string,string>" if json_lines else "array<map<string,string>>"
    parsed = F.from_json("value", kind)
    ordinal = scan_ordinal()
    meta = F.struct("_metadata.file_path", "_metadata.file_block_start").alias("_metadata")
    if json_lines:
        rows = lines.filter(F.trim("value") != "").select(parsed.alias("_m"), "value", meta)
    else:
        rows = lines.select(F.explode_outer(parsed).alias("_m"), "value", meta)
    keys = rows.select(F.explode(F.map_keys("_m")).alias("key")).distinct()
    found: dict[str, list[str]] = {}
    for name, key in keys.select(_key(F.col("key")), "key").collect():  # column names
        found.setdefault(name, []).append(key)
    declared = [f.name for f in schema.fields]
    wanted = declared + sorted(set(found) - set(declared))
    kinds = {f.name: f.dataType for f in schema.fields}
    values = {n: _value(n, found.get(n, [])) for n in wanted}
    columns = [_typed(values[n], kinds.get(n, T.StringType())).alias(n) for n in wanted]
    corrupt = []
    if keep_corrupt:
        odd = F.when(_unparsed([(values[n], kinds[n]) for n in declared]), F.to_json("_m"))
        whole = F.when(F.col("_m").isNull(), F.col("value"))
        corrupt = [F.coalesce(whole, odd).alias(CORRUPT)]
    return rows.select(*columns, *corrupt, ordinal)


def _key(name: Column) -> Column:
    return F.lower(F.trim(name))


def _value(name: str, spellings: list[str]) -> Column:
    """The value of a key, in whatever case and padding an object has it.

    Where all objects spell it alike it is looked up as it is. A later spelling of the same key in
    one object doesn't count.
    """
    if len(spellings) == 1:
        return F.col("_m").getItem(spellings[0])
    same = F.map_filter("_m", lambda k, _: _key(k) == name)
    return F.get(F.map_values(same), F.lit(0))


def read_parquet(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    """Parquet files; only the columns that a query uses are read in the end."""
    df = spark.read.parquet(*_listed(path))
    by_name = {c.strip().lower(): c for c in df.columns}
    _must_have(path, list(by_name), schema)
    kinds = {f.name: f.dataType for f in schema.fields}
    columns = [F.col(f"`{by_name[n]}`").cast(kinds[n]).alias(n) for n in kinds]
    others = [F.col(f"`{c}`").cast("string").alias(n) for n, c in by_name.items() if n not in kinds]
    return df.select(*columns, *others, scan_ordinal())
