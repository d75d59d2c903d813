"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers, floor(scale * x). The index holds blocks of rows; in a
block, bit b of dimension d of all rows is one bitmap (a slice). For a query, the slices of
each dimension are added with the weights of the query's value, written in signed binary
digits: a digit of weight 2^c adds the dimension's slices (or their complements, where it is
negative) c places higher. The additions are carry-save adders on whole bitmaps, place by
place; the result is the slices of the scores plus a constant. The best rows are selected
from the most significant slice downward: rows certainly in, and rows tied so far. What is
tied at the end fills up by smallest id, and the selected rows' scores are computed exactly
from their slices.

The queries are a set given by the caller, e.g. a fixed share of the rows. They go in chunks to
every block: no pair of a query and a row is ever a row of a table.

Definitions and edge cases
  * Rows with a null id, a null vector, or a null, NaN or infinite component take no part.
  * Rows with the query's id are its own and no candidates. Rows that repeat an id count once.
  * Vectors of different lengths have no product; each length is searched by itself.
  * Scores are 64-bit. Fewer than k candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import stage

_INDEX_TYPE = "dim int, block int, n int, low long, bits int, ids binary, slices binary"
_FOUND_TYPE = "query_id long, vec_id long, score long"
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, its quantised vector and length, for the rows that take part."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
        .dropDuplicates(["vec_id"])
        .select("vec_id", whole.alias("v"), F.size("embedding").alias("dim"))
    )


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(rows, -1)


def slice_rows(values: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Bitmaps (dimension, bit, word) of integer rows, the least value, and the number of bits."""
    n, dim = values.shape
    low = int(values.min()) if values.size else 0
    up = (values - low).astype(np.uint64)
    bits = max(1, int(up.max()).bit_length()) if values.size else 1
    words = -(-n // 64)
    out = np.zeros((dim, bits, words * 8), dtype=np.uint8)
    for b in range(bits):
        one = ((up >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(one, axis=0, bitorder="little")
        out[:, b, : len(packed)] = packed.T
    return out.view(np.uint64), low, bits


def _index_block(table: pa.Table) -> pa.Table:
    table = table.sort_by("vec_id")
    slices, low, bits = slice_rows(_matrix(table["v"], table.num_rows))
    row = {
        "dim": table["dim"][0].as_py(), "block": table["block"][0].as_py(), "n": table.num_rows,
        "low": low, "bits": bits, "ids": table["vec_id"].to_numpy().tobytes(),
        "slices": slices.tobytes(),
    }
    kinds = [("dim", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("low", pa.int64()),
             ("bits", pa.int32()), ("ids", pa.binary()), ("slices", pa.binary())]
    return pa.Table.from_pylist([row], schema=pa.schema(kinds))


def signed_digits(value: int) -> list[tuple[int, int]]:
    """(place, sign) of the non-adjacent form of an integer."""
    out, place = [], 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            out.append((place, digit))
            value -= digit
        value >>= 1
        place += 1
    return out


def score_slices(slices: np.ndarray, query: list[int]) -> list[np.ndarray]:
    """Bitmaps of the scores plus a constant, least significant first."""
    dim, bits, words = slices.shape
    flat = slices.reshape(dim * bits, words)
    terms: dict[int, tuple[list[int], list[int]]] = {}
    for d, value in enumerate(query):
        for place, sign in signed_digits(int(value)):
            for b in range(bits):
                at, flip = terms.setdefault(place + b, ([], []))
                at.append(d * bits + b)
                flip.append(sign < 0)
    out: list[np.ndarray] = []
    carries: list[np.ndarray] = []
    place, last = 0, max(terms, default=-1)
    while place <= last or carries:
        stack = carries
        if place in terms:
            at, flip = terms[place]
            mine = flat[at]
            mine[np.array(flip)] ^= _ALL
            stack = [mine, *carries]
        carries = []
        rest = np.concatenate(stack) if stack else np.zeros((1, words), np.uint64)
        while len(rest) > 1:
            third = len(rest) // 3
            if third:
                x, y, z = rest[:third], rest[third : 2 * third], rest[2 * third : 3 * third]
                half = x ^ y
                carries.append((x & y) | (half & z))
                rest = np.concatenate([half ^ z, rest[3 * third :]])
            else:
                carries.append(rest[:1] & rest[1:])
                rest = rest[:1] ^ rest[1:]
        out.append(rest[0])
        place += 1
    return out


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def best_rows(scores: list[np.ndarray], valid: np.ndarray, k: int) -> np.ndarray:
    """The k rows of the largest scores; ties go to the smaller row."""
    sure, tied = np.zeros_like(valid), valid
    room = k
    for bitmap in reversed(scores):
        up = tied & bitmap
        n = int(np.bitwise_count(up).sum())
        if n > room:
            tied = up
        else:
            sure, tied, room = sure | up, tied & ~bitmap, room - n
            if not room:
                return _rows(sure)
    return np.concatenate([_rows(sure), _rows(tied)[:room]])


def _exact(slices: np.ndarray, low: int, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Scores of some rows from their bits."""
    picked = slices[:, :, rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)
    weights = np.int64(1) << np.arange(slices.shape[1], dtype=np.int64)
    values = np.einsum("dbr,b->rd", picked.astype(np.int64), weights) + low
    return values @ query


def _search_tasks(k: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                n, dim = row["n"], row["dim"]
                ids = np.frombuffer(row["ids"], np.int64)
                slices = np.frombuffer(row["slices"], np.uint64).reshape(dim, row["bits"], -(-n // 64))
                valid = np.zeros(-(-n // 64) * 8, np.uint8)
                packed = np.packbits(np.ones(n, np.uint8), bitorder="little")
                valid[: len(packed)] = packed
                valid = valid.view(np.uint64)
                out: list[tuple] = []
                for q in row["queries"]:
                    query = np.array(q["v"], dtype=np.int64)
                    found = best_rows(score_slices(slices, q["v"]), valid, k + 1)
                    found = found[ids[found] != q["query_id"]]
                    score = _exact(slices, row["low"], found, query)
                    order = np.lexsort((ids[found], -score))[:k]
                    out += zip(
                        [q["query_id"]] * len(order), ids[found[order]].tolist(),
                        score[order].tolist(), strict=True,
                    )
                columns = zip(*out, strict=True) if out else [[]] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
                )

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, block: int = 16_384,
    chunk: int = 64, slot: int = 64,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each row with ``is_query``.

    Queries go in chunks to each block, of which there is a copy for every ``slot`` chunks: what meets is one
    block and so many chunks. The planner sees the chunks before they are copied to the blocks and would
    broadcast the copies, hence the hint.
    """
    rows = stage(usable(vectors, scale), "vectors")
    blocks = max(1, -(-rows.count() // block))
    dealt = rows.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int"))
    index = stage(dealt.groupBy("dim", "block").applyInArrow(_index_block, _INDEX_TYPE), "index")
    queries = rows.filter(is_query).withColumn("chunk", F.floor(F.monotonically_increasing_id() / chunk))
    queries = queries.groupBy("dim", "chunk").agg(
        F.collect_list(F.struct(F.col("vec_id").alias("query_id"), "v")).alias("queries")
    )
    queries = stage(queries.drop("chunk"), "queries")
    slots = max(1, -(-queries.count() // slot))
    queries = queries.withColumn("slot", F.pmod(F.monotonically_increasing_id(), F.lit(slots)).cast("int"))
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    copies = index.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    met = queries.hint("merge").join(copies, ["dim", "block", "slot"])
    found = met.mapInArrow(_search_tasks(k), _FOUND_TYPE)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
