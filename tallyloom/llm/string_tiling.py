"""Benchmark decontamination by greedy string tiling.

Every run of ``seed`` (4) words has a rolling hash. A join of the documents' runs with the test
items' runs gives, per document and item, the places (i, j) they share. Shared runs that
follow one another on a diagonal i - j are one match; the longest match whose words are free
on both sides is marked as a tile, matches that it cuts are cut down, and so on until no match
of ``seed`` words is left. Tiles may come in any order, so a passage whose sentences were moved
is covered all the same. A document is contaminated by an item if its tiles cover at least
``coverage`` of the item's words, and at least eight of them (or all).

A run common to many documents and items ("which of the following") would join them all. So an
item's runs are taken from the one that most items have to the rarest, and set aside while the
words that they cover all together are fewer than a leak needs. What an item shares with a
document then reaches the bound only if one of the other runs, the *anchors*, is shared too:
anchors find the candidates, and only these are compared by all their runs. Nothing is lost.

If the items have at most ``most_seeds`` runs (16 MB), their hashes are sent to all tasks, which
then pass on only the runs that occur in an item. Beyond that a semi join does it, with the same result.

Definitions and edge cases
  * Words are runs of digits, letters A-Z (lower-cased) and characters beyond ASCII.
  * Null or empty texts and items, and items of fewer than ``seed`` words, match nothing.
  * Repeated rows of a document or an item count once. Rows without doc_id are judged by their text.
    An item without item_id matches nothing. Among matches of one length the first in the document, then in the item, wins.
  * Empty tables give an empty result or no matches. Other columns don't matter.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import batches as B
from tallyloom.llm.common import keyed_documents, row_key, stage

_RUN_TYPE = "id long, at int, seed long, n_words int"
_TILE_TYPE = (
    "doc_id long, item_id long, n_words int, covered int,"
    " tiles array<struct<doc_start: int, item_start: int, length: int>>"
)


def _runs(seed: int, only=None):
    """Rolling seed hashes of each text; ``only``: a broadcast of the sorted hashes that count."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if only is not None:
            known = only.value
            filled = np.zeros(1 << 22, dtype=bool)
            filled[known & np.uint64((1 << 22) - 1)] = True
        for piece in B.pieces(parts):
            words = B.split_words(piece.column(1), B.ALNUM, B.LOWER)
            starts = B.window_starts(words.first, seed)
            h = B.window_hashes(words.hashes(), seed)[starts] if len(starts) else np.empty(0, np.uint64)
            if only is not None and len(h):
                near = np.flatnonzero(filled[h & np.uint64((1 << 22) - 1)])
                place = np.minimum(np.searchsorted(known, h[near]), len(known) - 1)
                near = near[known[place] == h[near]]
                starts, h = starts[near], h[near]
            doc = words.documents()[starts]
            ids = piece.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[doc].astype(np.int64)),
                    pa.array(words.positions()[starts].astype(np.int32)),
                    pa.array(B.signed(h)),
                    pa.array(words.counts[doc].astype(np.int32)),
                ],
                ["id", "at", "seed", "n_words"],
            )

    return run


def greedy_tiles(shared: Iterable[tuple[int, int]], seed: int) -> list[tuple[int, int, int]]:
    """Tiles (i, j, length) from the places at which ``seed`` equal words start on both sides."""
    by_diagonal = sorted(set(shared), key=lambda p: (p[0] - p[1], p[0]))
    matches: list[tuple[int, int, int]] = []
    last = None
    for i, j in by_diagonal:
        if last is not None and (i, j) == (last[0] + 1, last[1] + 1):
            n, a, b = matches[-1]
            matches[-1] = (n - 1, a, b)
        else:
            matches.append((-seed, i, j))
        last = (i, j)
    heapq.heapify(matches)  # the longest first, as lengths are negative
    used_i: set[int] = set()
    used_j: set[int] = set()
    tiles = []
    while matches:
        n, i, j = heapq.heappop(matches)
        free = [i + k not in used_i and j + k not in used_j for k in range(-n)]
        if all(free):
            used_i.update(range(i, i - n))
            used_j.update(range(j, j - n))
            tiles.append((i, j, -n))
            continue
        run = 0
        for k, ok in enumerate([*free, False]):
            if ok:
                run += 1
                continue
            if run >= seed:
                heapq.heappush(matches, (-run, i + k - run, j + k - run))
            run = 0
    return tiles


def _need(n_words: int, coverage: float) -> int:
    """The words that tiles must cover at least."""
    return max(math.ceil(coverage * n_words), min(8, n_words))


def _union(starts: Iterable[int], seed: int) -> int:
    """Words covered by runs of ``seed`` words at these places, each word once."""
    total = end = 0
    for j in sorted(set(starts)):
        total += j + seed - max(end, j)
        end = j + seed
    return total


def _tile(seed: int, coverage: float | None):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for row in part.to_pylist():
                shared = [(p["at"], p["j"]) for p in row.pop("places")]
                if coverage is not None and _union((j for _, j in shared), seed) < _need(
                    row["n_words"], coverage
                ):
                    continue
                tiles = greedy_tiles(shared, seed)
                row["covered"] = sum(n for _, _, n in tiles)
                row["tiles"] = [
                    {"doc_start": i, "item_start": j, "length": n} for i, j, n in sorted(tiles)
                ]
                rows.append(row)
            tile = pa.struct([(c, pa.int32()) for c in ("doc_start", "item_start", "length")])
            kinds = [("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int32()),
                     ("covered", pa.int32()), ("tiles", pa.list_(tile))]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

    return run


def _anchor_runs(seed: int, coverage: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: set[tuple[int, int, int]] = set()
            for row in part.to_pylist():
                need = _need(row["n_words"], coverage)
                free = np.ones(row["n_words"], dtype=bool)
                aside = 0
                for p in sorted(row["places"], key=lambda p: (-p["weight"], p["j"], p["seed"])):
                    window = free[p["j"] : p["j"] + seed]
                    more = int(window.sum())
                    if aside + more < need:
                        aside += more
                        window[:] = False
                    else:
                        out.add((p["seed"], row["item_id"], row["n_words"]))
            columns = zip(*sorted(out), strict=True) if out else [[]] * 3
            kinds = zip(columns, (pa.int64(), pa.int64(), pa.int32()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in kinds], ["seed", "item_id", "n_words"]
            )

    return run


def item_runs(benchmark: DataFrame, seed: int = 4) -> DataFrame:
    """The runs of the test items: (seed, item_id, j, n_words)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), "text").filter("id is not null")
    runs = items.mapInArrow(_runs(seed), _RUN_TYPE).distinct()
    return stage(runs.select("seed", F.col("id").alias("item_id"), F.col("at").alias("j"), "n_words"), "items")


def shared_runs(
    docs: DataFrame, items: DataFrame, seed: int = 4, most_seeds: int = 2_000_000
) -> DataFrame:
    """The documents' runs that occur in an item: (doc_id, at, seed)."""
    hashes = items.select("seed").distinct()
    runs = keyed_documents(docs)
    if hashes.count() <= most_seeds:  # checked, so the collected hashes have a bound
        known = hashes.toArrow()["seed"].to_numpy().view(np.uint64)
        if not len(known):
            known = np.zeros(1, np.uint64)
        only = docs.sparkSession.sparkContext.broadcast(np.sort(known))
        runs = runs.mapInArrow(_runs(seed, only), _RUN_TYPE)
    else:
        runs = runs.mapInArrow(_runs(seed), _RUN_TYPE).join(hashes, "seed", "left_semi")
    return runs.select(F.col("id").alias("doc_id"), "at", "seed")


def candidates(shared: DataFrame, items: DataFrame, coverage: float, seed: int = 4) -> DataFrame:
    """(doc_id, item_id, n_words): the pairs that share an anchor, each once."""
    weights = items.groupBy("seed").agg(F.count_distinct("item_id").alias("weight"))
    anchors = (
        items.join(weights, "seed")
        .groupBy("item_id", "n_words")
        .agg(F.collect_list(F.struct("weight", "j", "seed")).alias("places"))
        .mapInArrow(_anchor_runs(seed, coverage), "seed long, item_id long, n_words int")
    )
    anchors = stage(anchors, "anchors")
    return shared.select("doc_id", "seed").join(anchors, "seed").drop("seed").distinct()


def tilings(
    docs: DataFrame, benchmark: DataFrame, seed: int = 4, most_seeds: int = 2_000_000,
    coverage: float | None = None,
) -> DataFrame:
    """The tiles of every document (by its row key) and item with a shared run of ``seed`` words.

    With ``coverage``, only of pairs whose shared runs hold that share of the item's words.
    """
    items = item_runs(benchmark, seed)
    shared = shared_runs(docs, items, seed, most_seeds)
    if coverage is None:
        met = shared.join(items, "seed")
    else:
        shared = stage(shared, "shared")
        pairs = candidates(shared, items, coverage, seed)
        met = pairs.join(items, ["item_id", "n_words"]).join(shared, ["doc_id", "seed"])
    return (
        met.groupBy("doc_id", "item_id", "n_words")
        .agg(F.collect_list(F.struct("at", "j")).alias("places"))
        .mapInArrow(_tile(seed, coverage), _TILE_TYPE)
    )


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5, seed: int = 4) -> DataFrame:
    """The tilings that cover enough of an item."""
    enough = (F.col("covered") >= coverage * F.col("n_words")) & (
        F.col("covered") >= F.least(F.lit(8), "n_words")
    )
    return tilings(docs, benchmark, seed, coverage=coverage).filter(enough)


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5) -> DataFrame:
    """Per document: how many items leak into it, and the item that is covered most."""
    share = (F.col("covered") / F.col("n_words")).alias("coverage")
    best = F.max_by(
        F.struct("item_id", F.col("covered").cast("long").alias("covered"), share),
        F.struct(share, -F.col("item_id")),
    )
    found = leaks(docs, benchmark, coverage).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_items"), best.alias("best")
    )
    found = stage(found.withColumnRenamed("doc_id", "owner"), "leaks")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"))
        .join(found, F.col("key") == F.col("owner"), "left")
        .select(
            "doc_id",
            F.col("n_items").isNotNull().alias("contaminated"),
            F.coalesce("n_items", F.lit(0)).alias("n_items"),
            "best.item_id",
            F.coalesce("best.covered", F.lit(0)).alias("covered"),
            F.coalesce("best.coverage", F.lit(0.0)).alias("coverage"),
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that hold no item, in their columns, whatever their names."""
    bad = stage(leaks(docs, benchmark, coverage).select(F.col("doc_id").alias("owner")).distinct(), "contaminated")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), row_key().alias("key"))
    kept = rows.join(bad.hint("shuffle_hash"), F.col("key") == F.col("owner"), "left_anti")
    return kept.select("row.*")
