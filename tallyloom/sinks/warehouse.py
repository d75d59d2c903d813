"""The warehouse: Parquet tables behind numbered manifests.

A table is a list of immutable batch folders. A load writes new batch folders and then
publishes the next manifest, one small file that names the batches that count. Readers
follow the highest number, so they see either the old or the new state of *all* tables,
and a load that dies leaves nothing but unreferenced folders.

Publishing is compare-and-set: a number is claimed by creating a file that must not exist
yet. An increment that finds its number taken is made again on the state published
meanwhile: its orders, keys and aggregates are checked against that one, so two loads at
once lose nothing. The storage must refuse to create a file that exists (HDFS, local and
network file systems, object stores with conditional writes).

An incremental load adds a batch to the fact table and rewrites only dimensions with changed
members.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import schemas
from tallyloom.operators import merge
from tallyloom.operators.dimensions import assign_keys
from tallyloom.operators.global_order import row_index
from tallyloom.operators.ordinals import ORDINAL
from tallyloom.operators.star import Star
from tallyloom.plans.analyses import daily_sales
from tallyloom.session import in_parallel, stage
from tallyloom.sinks import files

MONTH = "sale_month"
_BATCH = "batch"
_WAIT_SECONDS = 120
_ATTEMPTS = 20
_DIMENSIONS = ["dim_date", "dim_supplier", "dim_customer", "dim_product"]
_SCHEMAS: dict[str, T.StructType] = {
    **schemas.STAR,
    "agg_daily_sales": schemas.AGG_DAILY_SALES,
    "data_quality_issues": schemas.QUALITY_ISSUES,
    "load_metadata": schemas.LOAD_METADATA,
}


class NotLoadedError(LookupError):
    """The warehouse has no such table yet."""


class ConcurrentLoadError(RuntimeError):
    """Other loads were published first, again and again."""


@dataclass(frozen=True)
class State:
    """What one manifest says."""

    number: int = 0
    version: str | None = None
    tables: dict[str, list[str]] = field(default_factory=dict)
    fact_rows: dict[str, int] = field(default_factory=dict)  # rows of each fact batch
    top_order_key: int = 0


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._scans: dict[tuple[str, ...], DataFrame] = {}

    # -- published state ---------------------------------------------------------

    def _number(self, number: int, kind: str) -> str:
        return f"{self.root}/manifests/{number:012d}.{kind}"

    def _state(self) -> State:
        names = [n for n, _ in files.children(self.spark, f"{self.root}/manifests")]
        numbers = [int(n.split(".")[0]) for n in names if n.endswith(".json")]
        if not numbers:
            return State()
        text = files.read_text(self.spark, self._number(max(numbers), "json"))
        return State(number=max(numbers), **json.loads(text))

    def _publish(self, base: State, tables: dict, fact_rows: dict, top: int) -> bool:
        """Publish the successor of ``base``; False if another load did so first.

        A claim without a manifest belongs to a load that is just writing it, so it is waited for.
        One that stays is of a load that died in that moment: then its file is to be deleted by
        hand, as nobody else can know that it won't be written any more.
        """
        number, started = base.number + 1, time.monotonic()
        claim = self._number(number, "claim")
        while not files.claim(self.spark, claim):
            if self._state().number > base.number:
                return False
            if time.monotonic() - started > _WAIT_SECONDS:
                raise ConcurrentLoadError(f"claimed, but not published; if that load has died, delete {claim}")
            time.sleep(0.1)
        state = {
            "version": uuid.uuid4().hex,
            "tables": tables,
            "fact_rows": {b: fact_rows[b] for b in tables.get("fact_sales", [])},
            "top_order_key": top,
        }
        files.replace_text(self.spark, self._number(number, "json"), json.dumps(state))
        return True

    def version(self) -> str | None:
        """Id of the published state; None before the first load."""
        return self._state().version

    def has(self, name: str) -> bool:
        return bool(self._state().tables.get(name))

    def _folder(self, name: str, batch: str) -> str:
        return f"{self.root}/tables/{name}/{_BATCH}={batch}"

    def _read(self, name: str, batches: list[str]) -> DataFrame:
        """The given batches; the fact keeps its month so that filters on it prune.

        Batches never change, so their files are listed only once.
        """
        scan = (name, *batches)
        found = self._scans.get(scan)
        if found is None:
            found = self._open(name, batches)
            others = {k: v for k, v in self._scans.items() if k[0] != name}
            self._scans = {**others, scan: found}  # replaced as a whole: threads may read it
        return found

    def _open(self, name: str, batches: list[str]) -> DataFrame:
        schema = _SCHEMAS[name]
        scan = T.StructType(list(schema.fields)).add(_BATCH, T.StringType())
        extra = []
        if name == "fact_sales":
            scan, extra = scan.add(MONTH, T.IntegerType()), [MONTH]
        if not batches:
            return self.spark.createDataFrame([], scan).select(schema.fieldNames() + extra)
        return (
            self.spark.read.schema(scan)
            .option("basePath", f"{self.root}/tables/{name}")
            .parquet(*[self._folder(name, b) for b in batches])
            .select(schema.fieldNames() + extra)
        )

    def table(self, name: str) -> DataFrame:
        """A table as last published."""
        if name not in _SCHEMAS:
            raise NotLoadedError(f"no such table: {name}")
        batches = self._state().tables.get(name)
        if batches is None:
            raise NotLoadedError(f"table not loaded yet: {name}")
        return self._read(name, batches)

    def star(self) -> Star:
        """The star tables of one and the same published state."""
        state = self._state()
        missing = [n for n in schemas.STAR if n not in state.tables]
        if missing:
            raise NotLoadedError(f"tables not loaded yet: {missing}")
        star = Star(**{n: self._read(n, state.tables[n]) for n in schemas.STAR})
        star.version, star.top_order_key = state.version, state.top_order_key
        star.batches = {n: state.tables[n] for n in schemas.STAR}
        return star

    def register_views(self) -> list[str]:
        """Temporary views of all loaded tables, under their own names."""
        tables = self._state().tables
        for name, batches in tables.items():
            self._read(name, batches).createOrReplaceTempView(name)
        return sorted(tables)

    # -- writing -----------------------------------------------------------------

    def _save(self, name: str, df: DataFrame) -> str:
        """Write one batch of a table; returns its id."""
        batch = f"b{uuid.uuid4().hex}"
        rows = df.select([F.col(f.name).cast(f.dataType) for f in _SCHEMAS[name].fields])
        if name == "fact_sales":
            # Rebalance: AQE splits a large month over tasks and merges small ones.
            rows = rows.withColumn(MONTH, F.expr("date_key div 100").cast("int"))
            rows.hint("rebalance", F.col(MONTH)).write.partitionBy(MONTH).parquet(
                self._folder(name, batch)
            )
        else:
            rows.write.parquet(self._folder(name, batch))
        return batch

    def _write(self, name: str, df: DataFrame) -> tuple[str, int]:
        """Write one batch of a table; returns its id and its number of rows.

        The rows are counted from the file footers: metrics collected while writing
        would count a task twice that is run again after an executor is lost.
        """
        batch = self._save(name, df)
        return batch, self._open(name, [batch]).count()

    def _metadata_batch(self, old: list[str], counts: dict[str, int], mode: str) -> str:
        """Load metadata with the given tables brought up to date: one row per table."""
        now = datetime.now(timezone.utc).isoformat()
        rows = {r["table_name"]: tuple(r) for r in self._read("load_metadata", old).collect()}  # a handful
        rows |= {name: (name, now, n, mode) for name, n in counts.items()}
        fresh = self.spark.createDataFrame(list(rows.values()), schemas.LOAD_METADATA)
        return self._save("load_metadata", fresh.coalesce(1))

    # -- loads -------------------------------------------------------------------

    def load_full(self, star: Star, issues: DataFrame | None = None) -> dict[str, int]:
        """Replace all star tables; returns the rows written per table.

        Without ``issues`` the stored quality issues stay as they are. Of full loads at
        once the last one published counts, as a whole.
        """
        written = self._write_all(star, issues)
        for _ in range(_ATTEMPTS):
            if self._publish_all(self._state(), *written):
                return written[1]
        raise ConcurrentLoadError("full load")

    def _write_all(self, star: Star, issues: DataFrame | None):
        """Batches and row counts of a full load."""
        names = [*_DIMENSIONS, "fact_sales"]
        written = in_parallel(
            self.spark, *(lambda n=n: self._write(n, getattr(star, n)) for n in names)
        )
        tables = {n: [batch] for n, (batch, _) in zip(names, written, strict=True)}
        counts = {n: rows for n, (_, rows) in zip(names, written, strict=True)}
        daily = daily_sales(
            self._read("fact_sales", tables["fact_sales"]),
            self._read("dim_date", tables["dim_date"]),
        )
        tables["agg_daily_sales"] = [self._save("agg_daily_sales", daily)]
        if issues is not None:
            tables["data_quality_issues"] = [self._save("data_quality_issues", issues)]
        return tables, counts

    def _publish_all(self, base: State, new: dict, counts: dict) -> bool:
        tables = {"data_quality_issues": [], **base.tables, **new}
        tables["load_metadata"] = [
            self._metadata_batch(base.tables.get("load_metadata", []), counts, "full")
        ]
        rows = counts["fact_sales"]
        return self._publish(base, tables, {new["fact_sales"][0]: rows}, rows)

    def load_incremental(
        self, star: Star, issues: DataFrame | None = None, facts_checked: bool = False
    ) -> int | None:
        """Upsert the dimensions and append the facts whose order_id is new.

        Returns the number of new facts; falls back to a full load, and returns None,
        if nothing was loaded before. ``facts_checked`` says that the fact holds new
        orders with new order keys only, as built by
        :func:`tallyloom.plans.job.build_star` on the tables of one published state. If
        that state is not the present one, or the star was built without the loaded
        tables, its members get the keys they have here, its orders are checked, and new
        facts are numbered after the largest order_key.
        """
        whole = None
        for _ in range(_ATTEMPTS):
            base = self._state()
            if not base.tables.get("fact_sales"):
                whole = whole or self._write_all(star, issues)
                if self._publish_all(base, *whole):
                    return None
                continue
            current = star.version is not None and star.version == base.version
            batch = star if current else self._rekeyed(star, base)
            done = self._increment(base, batch, issues, facts_checked and current)
            if done is not None:
                return done
        raise ConcurrentLoadError("incremental load")

    def _rekeyed(self, star: Star, base: State) -> Star:
        """The batch with the surrogate keys of the loaded dimensions.

        Members of a dimension that is still the one the batch was built on have their keys already.
        """
        tables, new_keys = star.tables(), {}
        built_on = (star.known and star.known.batches) or {}
        other = [n for n in ("dim_supplier", "dim_customer", "dim_product") if built_on.get(n) != base.tables[n]]
        if "dim_supplier" in other and "dim_product" not in other:
            other.append("dim_product")  # names suppliers by their keys
        if star.known is not None:  # its members are the changed ones: the others may have other keys here
            for name in other:
                held, key = getattr(star.known, name), schemas.BUSINESS_KEYS[name]
                tables[name] = merge.upsert(held, tables[name], key)
        for name in other:
            surrogate = name.removeprefix("dim_") + "_key"
            held = self._read(name, base.tables[name])
            given = tables[name].withColumnRenamed(surrogate, "_given")
            if name == "dim_product" and "supplier_key" in new_keys:
                given = _with_new_keys(given, "supplier_key", new_keys["supplier_key"])
            given = given.withColumn(ORDINAL, F.struct(F.col("_given").alias("pos")))
            keyed = stage(assign_keys(given, schemas.BUSINESS_KEYS[name], surrogate, held), name)
            new_keys[surrogate] = keyed.select("_given", F.col(surrogate).alias("_new"))
            tables[name] = keyed.select(_SCHEMAS[name].fieldNames())
        for surrogate, pairs in new_keys.items():
            tables["fact_sales"] = _with_new_keys(tables["fact_sales"], surrogate, pairs)
        rekeyed = Star(**tables)
        rekeyed.members = star.members
        return rekeyed

    def _increment(
        self, base: State, star: Star, issues: DataFrame | None, facts_checked: bool
    ) -> int | None:
        """The number of facts added to ``base``; None if another load came first."""
        tables = dict(base.tables)

        def dimension(name: str) -> tuple[str, list[str], int, bool]:
            key = schemas.BUSINESS_KEYS[name]
            existing, batch = self._read(name, base.tables[name]), getattr(star, name)
            rows = (star.members or {}).get(name)
            rows = batch.count() if rows is None else rows
            # Of the calendar only new days matter.
            new_days = name == "dim_date" and not merge.new_rows(batch, existing, key).isEmpty()
            same = not new_days if name == "dim_date" else batch.isEmpty()
            if same:
                return name, base.tables[name], rows, new_days
            return name, [self._save(name, merge.upsert(existing, batch, key))], rows, new_days

        def facts() -> tuple[str, int]:
            new = star.fact_sales
            if not facts_checked:
                loaded = self._read("fact_sales", base.tables["fact_sales"])
                new = merge.new_rows(new, loaded, "order_id")
                new = row_index(
                    new.withColumnRenamed("order_key", "_given"),
                    [F.col("_given"), F.col("order_id").asc_nulls_first()],
                    out="order_key",
                    start=base.top_order_key + 1,
                )
            return self._write("fact_sales", new)

        *dimensions, (appended, added) = in_parallel(
            self.spark, *(lambda n=n: dimension(n) for n in _DIMENSIONS), facts
        )
        tables |= {name: batches for name, batches, _, _ in dimensions}
        counts = {name: rows for name, _, rows, _ in dimensions} | {"fact_sales": added}
        new_days = any(new for _, _, _, new in dimensions)
        if added:
            tables["fact_sales"] = [*tables["fact_sales"], appended]
        if issues is not None:
            tables["data_quality_issues"] = [
                *tables["data_quality_issues"],
                self._save("data_quality_issues", issues),
            ]

        def daily() -> list[str]:
            if not counts["fact_sales"] and not new_days:
                return tables["agg_daily_sales"]
            return [self._save("agg_daily_sales", self._daily_after(tables, appended, rebuild=new_days))]

        def metadata() -> list[str]:
            return [self._metadata_batch(base.tables["load_metadata"], counts, "incremental")]

        days, loads = in_parallel(self.spark, daily, metadata)
        tables |= {"agg_daily_sales": days, "load_metadata": loads}
        rows = {**base.fact_rows, appended: counts["fact_sales"]}
        top = base.top_order_key + counts["fact_sales"]
        return counts["fact_sales"] if self._publish(base, tables, rows, top) else None

    def _daily_after(self, tables: dict, appended: str, rebuild: bool) -> DataFrame:
        """Daily aggregates after an append.

        Only the months of the appended facts are computed anew (a pruned scan);
        other days are kept. If the calendar got new days, all is computed anew.
        """
        fact = self._read("fact_sales", tables["fact_sales"])
        dim_date = self._read("dim_date", tables["dim_date"])
        if rebuild:
            return daily_sales(fact, dim_date)
        # At most one value per calendar month reaches the driver. Facts without a date
        # belong to no day.
        months = self._read("fact_sales", [appended]).select(MONTH).distinct().filter(
            F.col(MONTH).isNotNull()
        )
        touched = [r[0] for r in months.collect()]
        month = F.year("date") * 100 + F.month("date")
        kept = self._read("agg_daily_sales", tables["agg_daily_sales"]).filter(
            ~month.isin(touched)
        )
        return kept.unionByName(daily_sales(fact.filter(F.col(MONTH).isin(touched)), dim_date))

    def load(self, star: Star, issues: DataFrame | None = None, mode: str = "full"):
        if mode == "full":
            return self.load_full(star, issues)
        if mode == "incremental":
            return self.load_incremental(star, issues)
        raise ValueError("mode must be 'full' or 'incremental'")

    # -- load metadata -----------------------------------------------------------

    def last_load(self, name: str) -> str | None:
        """UTC time (ISO) at which a table was last loaded, or None."""
        if not self.has("load_metadata"):
            return None
        row = (
            self.table("load_metadata")
            .filter(F.col("table_name") == name)
            .agg(F.max("last_load_at"))
            .first()
        )
        return row[0]

    def vacuum(self, older_than_hours: float = 24.0) -> list[str]:
        """Delete batch folders that no published state names and that are old enough."""
        limit = (time.time() - older_than_hours * 3600) * 1000
        state = self._state()
        live, removed = state.tables, []
        for child, modified in files.children(self.spark, f"{self.root}/manifests"):
            if int(child.split(".")[0]) < state.number and modified < limit:
                files.remove(self.spark, f"{self.root}/manifests/{child}")
        for name in _SCHEMAS:
            keep = {f"{_BATCH}={b}" for b in live.get(name, [])}
            for child, modified in files.children(self.spark, f"{self.root}/tables/{name}"):
                if child not in keep and modified < limit:
                    files.remove(self.spark, f"{self.root}/tables/{name}/{child}")
                    removed.append(f"{name}/{child}")
        return removed


def _with_new_keys(rows: DataFrame, surrogate: str, pairs: DataFrame) -> DataFrame:
    """``surrogate`` replaced by ``_new`` where ``pairs`` has it as ``_given``."""
    pairs = pairs.select(F.col("_given").alias("_old"), F.col("_new"))
    return (
        rows.join(pairs, F.col(surrogate) == F.col("_old"), "left")
        .withColumn(surrogate, F.coalesce("_new", surrogate))
        .drop("_old", "_new")
    )
