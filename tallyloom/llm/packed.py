"""Shuffling very many hashes in few rows.

A task gathers (hash, document, place) triples and sends, for each bucket of the hash, one
row with packed arrays. The bucket comes from the upper half of the hash, and the lower 32
bits travel as key. As the number of buckets follows the data, a bucket's population and
with it the share of chance hits between 32-bit keys stay the same at every size; chance hits
only cost a second look, as the callers compare again by longer hashes. For that, ``wide``
packers send all 64 bits and 32 bits of another hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PACKED_TYPE = (
    "bucket int, keys binary, more binary, ids binary, tags binary, counts binary, low binary,"
    " high binary"
)
_SCHEMA = pa.schema(
    [("bucket", pa.int32())]
    + [(n, pa.binary()) for n in ("keys", "more", "ids", "tags", "counts", "low", "high")]
)


class Packer:
    """Gathers triples of documents, and yields packed rows from time to time."""

    def __init__(
        self, buckets: int, places: bool = True, wide: bool = False, most: int = 2_000_000
    ) -> None:
        self.buckets, self.places, self.wide, self.most = buckets, places, wide, most
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = self.held_docs = 0

    def add(self, hashes, doc, ids, place=None, tags=None, more=None) -> Iterator[pa.RecordBatch]:
        """``doc`` indexes ``ids`` and ``tags`` (64-bit numbers) and must not fall."""
        none = np.empty(0, np.int64)
        self.parts.append(
            (hashes, doc + self.held_docs, ids)
            + tuple(none if x is None else x for x in (place, tags, more))
        )
        self.held += len(hashes)
        self.held_docs += len(ids)
        if self.held >= self.most:
            yield self.flush()

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        hashes, doc, ids, place, tags, more = (
            np.concatenate(x) for x in zip(*self.parts, strict=True)
        )
        self.parts, self.held, self.held_docs = [], 0, 0
        bucket = (hashes >> np.uint64(32)) % np.uint64(self.buckets)
        bucket = bucket.astype(np.uint16 if self.buckets <= 65536 else np.uint32)
        order = np.argsort(bucket, kind="stable")
        bucket, doc = bucket[order], doc[order]
        fresh = np.ones(len(doc), dtype=bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (bucket[1:] != bucket[:-1])
        runs = np.flatnonzero(fresh)
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        rows = np.searchsorted(runs, cuts)
        each = {"keys": hashes[order].astype(np.uint64 if self.wide else np.uint32)}
        if self.wide:
            each["more"] = more[order].astype(np.uint32)
        if self.places:
            place = place[order].astype(np.uint32)
            each["low"] = place.astype(np.uint16)
            each["high"] = (place >> np.uint32(16)).astype(np.uint16)
        by_run = {"ids": ids[doc[runs]]}
        by_run["counts"] = np.diff(np.append(runs, len(doc))).astype(np.uint32)
        if len(tags):
            by_run["tags"] = tags[doc[runs]]
        packed = {n: _sliced(v, cuts) for n, v in each.items()}
        packed |= {n: _sliced(v, rows) for n, v in by_run.items()}
        packed["bucket"] = bucket[cuts[:-1]].tolist()
        return pa.RecordBatch.from_pylist(
            [dict(zip(packed, row, strict=True)) for row in zip(*packed.values(), strict=True)],
            schema=_SCHEMA,
        )


def _sliced(values: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    return [values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def fact_row(bucket: int, **arrays: np.ndarray) -> pa.RecordBatch:
    """A row without keys that takes packed 64-bit numbers to a bucket, by column name."""
    row = {"bucket": bucket} | {n: v.astype(np.int64).tobytes() for n, v in arrays.items()}
    return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)


def answer_row(bucket: int, ids, at, tags=None, keys=None) -> pa.RecordBatch:
    """A row of places in documents, each with its id (and tag and key), without counts."""
    at = at.astype(np.uint32)
    row = {"bucket": bucket, "ids": ids.astype(np.int64).tobytes()}
    row |= {"low": at.astype(np.uint16).tobytes(), "high": (at >> np.uint32(16)).astype(np.uint16).tobytes()}
    if tags is not None:
        row |= {"tags": tags.astype(np.int64).tobytes(), "keys": keys.astype(np.uint32).tobytes()}
    return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    """All packed arrays of a column behind one another; null is empty."""
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype=kind)


def per_key(table: pa.Table, column: str) -> np.ndarray:
    """The document ids or tags of a bucket, once per key."""
    return np.repeat(joined(table[column], np.int64), joined(table["counts"], np.uint32))


def places(table: pa.Table) -> np.ndarray:
    low, high = joined(table["low"], np.uint16), joined(table["high"], np.uint16)
    return low.astype(np.int64) + (high.astype(np.int64) << 16)


def by_document(ids: np.ndarray, **values: np.ndarray) -> pa.Table:
    """A row per document with packed values; a value's type is kept."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    cuts = np.append(np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1)), len(ids))
    columns: dict = {"doc_id": pa.array(ids[cuts[:-1]], pa.int64())}
    for name, value in values.items():
        value = value[order]
        packed = [value[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        columns[name] = pa.array(packed, pa.binary())
    return pa.table(columns)
