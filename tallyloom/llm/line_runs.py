"""Line de-duplication with levelled sorted runs of line hashes.

Documents come in batches. A *run* is a Parquet table of (line hash, number of documents),
laid out by hash and sorted. Each batch is anti-joined with the hashes that the runs already
hold often enough, counted, and added as a run of level 0; when a level has ``fanout`` runs
they are merged into one run of the next level. So a batch reads a bounded number of runs,
and a line that is known to be common is never counted again.

Definitions and edge cases
  * A line is what stands between two ``\\n``; a null or empty text is one empty line.
  * The key of a line is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased.
    Keys are compared by 128 bits of BLAKE2b. An empty key is never common.
  * A key counts once per document, however often it stands there. Rows that repeat a doc_id
    are one document. A row without doc_id is no document to be counted, but loses the lines that
    are common among the others, too.
  * An empty table gives an empty result. Columns other than doc_id and text don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import documents, keyed_documents, row_key, stage

LINE_TYPE = "doc_id long, h1 long, h2 long, batch int"


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def _digest(key: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(key, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _lines(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def line_hashes(docs: DataFrame, batches: int) -> DataFrame:
    """The distinct line keys of each row, and the batch of its document (-1 without doc_id)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows: list[tuple[int, int, int, int]] = []
            ids = part.column(0).to_pylist()
            for doc, text in zip(ids, part.column(1).cast(pa.binary()), strict=True):
                keys = {line_key(x) for x in _lines(text.as_py())} - {b""}
                batch = doc % batches if doc >= -(1 << 62) else -1
                rows += [(doc, *_digest(key), batch) for key in keys]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "h1", "h2", "batch"])

    return keyed_documents(docs).mapInArrow(run, LINE_TYPE)


class LineRuns:
    """Runs of (h1, h2, docs), by level; a later level is older and larger."""

    def __init__(self, min_docs: int, fanout: int = 4) -> None:
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []

    def _sorted(self, counted: DataFrame) -> DataFrame:
        """A run on disk; counting has dealt it by hash already."""
        return stage(counted.sortWithinPartitions("h1", "h2"), "run")

    def totals(self) -> DataFrame | None:
        """Documents per hash over all runs."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            return None
        merged = runs[0]
        for run in runs[1:]:
            merged = merged.unionByName(run)
        return merged.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"))

    def common(self) -> DataFrame | None:
        """Hashes found in at least ``min_docs`` documents so far."""
        totals = self.totals()
        return None if totals is None else totals.filter(F.col("docs") >= self.min_docs).drop("docs")

    def add(self, batch: DataFrame) -> None:
        """Count the (doc_id, h1, h2) rows of a batch of documents no batch before has had."""
        known = self.common()
        fresh = batch.dropDuplicates(["h1", "h2", "doc_id"])
        counted = fresh.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"))
        if known is not None:  # one row per hash on both sides: no hot key can meet here
            counted = counted.join(known.hint("merge"), ["h1", "h2"], "left_anti")
        self._push(self._sorted(counted), 0)

    def _push(self, run: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) < self.fanout:
            return
        merged = self.levels[level][0]
        for other in self.levels[level][1:]:
            merged = merged.unionByName(other)
        compact = merged.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"))
        self.levels[level] = []
        self._push(self._sorted(compact), level + 1)


def common_lines(
    docs: DataFrame, min_docs: int = 10, batches: int = 4, fanout: int = 3
) -> DataFrame:
    """(doc_id, h1, h2) of each document's lines that are found in ``min_docs`` documents."""
    lines = stage(line_hashes(docs, batches), "lines")
    runs = LineRuns(min_docs, fanout)
    for k in range(batches):
        runs.add(lines.filter(F.col("batch") == k).drop("batch"))
    common = stage(runs.common(), "common")
    return lines.drop("batch").join(common, ["h1", "h2"], "left_semi")


def _without(text: bytes | None, drop: list[dict] | None) -> tuple[int, list[bytes]]:
    """The number of lines, and those whose key is not dropped."""
    lines = _lines(text)
    if not drop:
        return len(lines), lines
    keys = {(x["h1"], x["h2"]) for x in drop}
    return len(lines), [x for x in lines if _digest(line_key(x)) not in keys]


def _rebuild(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, drop) become (row, n_lines, n_dropped, kept)."""
    for part in parts:
        row, text, drop = part.columns
        n_lines, n_dropped, kept = [], [], []
        for t, d in zip(text.cast(pa.binary()), drop, strict=True):
            n, stay = _without(t.as_py(), d.as_py())
            n_lines.append(n)
            n_dropped.append(n - len(stay))
            kept.append(b"\n".join(stay) if n > len(stay) else t.as_py())
        counts = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
        kept = pa.array(kept, pa.binary()).cast(text.type)
        yield pa.RecordBatch.from_arrays([row, *counts, kept], ["row", "n_lines", "n_dropped", "kept"])


def _rebuilt(docs: DataFrame, min_docs: int) -> DataFrame:
    """row (a struct of all columns but text), n_lines, n_dropped, kept (null for a null text).

    The table is read twice: for the hashes, and for the texts, which meet the few hashes to
    drop by their row key.
    """
    drops = (
        common_lines(docs, min_docs)
        .dropDuplicates(["doc_id", "h1", "h2"])
        .groupBy(F.col("doc_id").alias("owner"))
        .agg(F.collect_list(F.struct("h1", "h2")).alias("drop"))
    )
    drops = stage(drops, "drops").hint("shuffle_hash")
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    joined = docs.select(others.alias("row"), "text", row_key().alias("key")).join(drops, F.col("key") == F.col("owner"), "left")
    joined = joined.select("row", "text", "drop")
    counts = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped")]
    kinds = T.StructType([joined.schema["row"], *counts, T.StructField("kept", T.StringType())])
    return joined.mapInArrow(_rebuild, kinds)


def drop_common_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """Each document without its common lines: doc_id, n_lines, n_dropped, kept (the text left)."""
    return _rebuilt(documents(docs), min_docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.coalesce("kept", F.lit("")).alias("kept")
    )


def with_kept_text(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """The rows and columns of ``docs``, whatever their names, with the text that is left.

    A null text stays null. ``n_chars``, where the table has it, follows the new text.
    """
    kinds = dict(docs.dtypes)

    def column(name: str):
        if name == "text":
            return F.col("kept").cast(kinds[name]).alias(name)
        old = F.col(f"row.`{name}`")
        if name == "n_chars":
            old = F.when(F.col("n_dropped") > 0, F.char_length("kept").cast(kinds[name])).otherwise(old)
        return old.alias(name)

    return _rebuilt(docs, min_docs).select(*map(column, docs.columns))
