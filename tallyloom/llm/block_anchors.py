"""Substring de-duplication with fixed-block anchors.

A window of ``span`` (50) words that stands in two documents holds, wherever it starts, one
whole block of ``span // 2`` words from the non-overlapping blocks that the other document is
cut into. So the index holds only those blocks, and every rolling window of a block's length
probes it:

1. *Index and probe*: hashes of all rolling block-length windows go to buckets by hash in
   packed rows; those at multiples of the block length are the index. A bucket reports the
   probes that meet a block of a document with a smaller id, and the blocks that a document
   with a larger id meets: the *hits*. It never forms pairs.
2. *Extend*: around each hit, all windows of ``span`` words that contain it are hashed (96
   bits) and sent to buckets again, where the first document (and place) with the same words
   is found. Windows that follow one another here and there are merged: the *maximal exact
   repeats*, with the place of the original.
3. *Remove*: each document drops the words that repeats cover.

Both steps are linear in the text, however many documents share a passage. A window that one
packet of a task (2 million windows) holds more than 16 times is settled there: as a hit, or as
a repeat of the packet's smallest document. Only its smallest and largest document go to
the bucket of the hash, so a passage of a third of all rows fills no single task.

Definitions and edge cases
  * Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a window of ``span`` words over
    it also starts in a document with a smaller doc_id. What repeats within one document
    only, or in rows with the same doc_id, stays.
  * Null or empty texts have no words. A row without doc_id loses nothing and takes no part.
    Rows repeated in full lose the same words; a doc_id must identify a text.
  * An empty table gives an empty result. Columns other than doc_id and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import batches as B
from tallyloom.llm.common import documents, parts_for, stage, text_size
from tallyloom.llm.packed import PACKED_TYPE, Packer, answer_row, by_document, joined, per_key, places

_HIT_TYPE = "doc_id long, at binary"
_REPEAT_TYPE = "doc_id long, at binary, ref binary, ref_at binary"
_SPAN_TYPE = "doc_id long, start long, end long, ref_doc long, ref_start long"
_KEPT_TYPE = "doc_id long, n_words long, n_removed long, kept string"
_ZIPPED_TYPE = "doc_id long, size long, zipped binary"


#: A window found more often than this in one packet is settled there.
_MANY = 16
#: In place of the position: stands for a window that was settled, and is an anchor for others.
_SETTLED = 1 << 31
#: Repeated windows are merged in pieces of about so many bytes of their places.
_MERGED = 1 << 20


def _often(hashes: np.ndarray) -> np.ndarray:
    """The indexes of what occurs more than ``_MANY`` times."""
    order = np.argsort(hashes)
    ranked = hashes[order]
    cuts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    lengths = np.diff(np.append(cuts, len(ranked)))
    return np.sort(order[np.repeat(lengths > _MANY, lengths)])


def _settle_probes(step: int):
    """Hits in place of frequent windows: of windows that follow one another, every ``step``-th."""

    def settle(hashes, doc, ids, place, more):
        rows = _often(hashes)
        fresh = np.ones(len(rows), dtype=bool)
        fresh[1:] = (np.diff(doc[rows]) != 0) | (np.diff(place[rows]) != 1)
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))
        keep = (np.arange(len(rows)) - begin) % step == 0
        keep[:-1] |= fresh[1:]
        keep[-1:] = True
        answer = {"ids": ids[doc[rows[keep]]], "at": place[rows[keep]]}
        order = rows[np.lexsort((ids[doc[rows]], hashes[rows]))]
        turn = np.flatnonzero(hashes[order][1:] != hashes[order][:-1])
        ends = order[np.concatenate([[0], turn + 1, turn, [len(order) - 1]])] if len(order) else order
        stay = np.ones(len(hashes), dtype=bool)
        stay[rows] = False
        stay[ends] = True
        place[ends] = _SETTLED
        return stay, answer

    return settle


def _settle_repeats(hashes, doc, ids, place, more):
    """Frequent windows with the first of the packet as their original, which stays itself."""
    rows = _often(hashes)
    rows = rows[np.lexsort((place[rows], ids[doc[rows]], more[rows], hashes[rows]))]
    own, at = ids[doc[rows]], place[rows]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (np.diff(hashes[rows]) != 0) | (np.diff(more[rows]) != 0)
    origin = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))
    again = np.flatnonzero(own > own[origin])
    stay = np.ones(len(hashes), dtype=bool)
    stay[rows[again]] = False
    origin = origin[again]
    return stay, {"ids": own[again], "at": at[again], "tags": own[origin], "keys": at[origin]}


class SettlingPacker(Packer):
    """A packer that settles frequent windows; the answers travel in buckets below zero.

    There are as many of these as others, and the packets of all tasks are dealt over them.
    """

    def __init__(self, buckets: int, settle, turn: int, **options) -> None:
        super().__init__(buckets, **options)
        self.settle, self.turn = settle, turn
        self.answers: list[pa.RecordBatch] = []

    def add(self, *arrays, **named) -> Iterator[pa.RecordBatch]:
        yield from self._with_answers(super().add(*arrays, **named))

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._with_answers(super().end())

    def _with_answers(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            yield from self.answers
            self.answers = []

    def flush(self) -> pa.RecordBatch:
        hashes, doc, ids, place, tags, more = (
            np.concatenate(x) for x in zip(*self.parts, strict=True)
        )
        place = place.astype(np.int64)
        stay, answer = self.settle(hashes, doc, ids, place, more)
        if len(answer["ids"]):
            self.answers = [answer_row(-1 - self.turn % self.buckets, **answer)]
            self.turn += 1
            more = more[stay] if len(more) else more
            self.parts = [(hashes[stay], doc[stay], ids, place[stay], tags, more)]
        return super().flush()


def _zip(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts take less room in a shuffle this way."""
    codec = pa.Codec("zstd", compression_level=1)
    for part in parts:
        texts = [x.as_buffer() or b"" for x in part.column(1).cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array([len(x) for x in texts], pa.int64()),
                pa.array([codec.compress(x, asbytes=True) for x in texts], pa.binary()),
            ],
            ["doc_id", "size", "zipped"],
        )


def _zipped_pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of zipped texts, cut so that the texts of a piece have about ``PIECE`` bytes."""
    for part in parts:
        yield from B.cut(part, part.column("size").to_numpy())


def _unzip(part: pa.RecordBatch) -> list[bytes]:
    codec = pa.Codec("zstd")
    sizes = part.column("size").to_pylist()
    return [
        codec.decompress(x.as_buffer(), n, asbytes=True) if n else b""
        for x, n in zip(part.column("zipped"), sizes, strict=True)
    ]


def _probe_tasks(block: int, step: int, buckets: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SettlingPacker(buckets, _settle_probes(step), TaskContext.get().partitionId())
        for piece in B.pieces(parts):
            words = B.split_words(piece.column(1), B.NOT_SPACE)
            starts = B.window_starts(words.first, block)
            hashes = B.window_hashes(words.hashes(), block)[starts] if len(starts) else starts
            ids = piece.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield from packer.add(
                hashes.astype(np.uint64), words.documents()[starts], ids, words.positions()[starts]
            )
        yield from packer.end()

    return run


def _probe_bucket(block: int):
    def run(table: pa.Table) -> pa.Table:
        if table["bucket"][0].as_py() < 0:
            return by_document(joined(table["ids"], np.int64), at=places(table).astype(np.uint32))
        keys, ids, at = joined(table["keys"], np.uint32), per_key(table, "ids"), places(table)
        settled = at == _SETTLED
        anchor = (at % block == 0) | settled
        order = np.argsort(keys[anchor])
        index = keys[anchor][order]
        if not len(index):
            return by_document(ids[:0], at=at[:0].astype(np.uint32))
        start = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
        index, least = index[start], np.minimum.reduceat(ids[anchor][order], start)
        place = np.minimum(np.searchsorted(index, keys), len(index) - 1)
        met = np.flatnonzero(index[place] == keys)
        place = place[met]
        most = least.copy()
        np.maximum.at(most, place, ids[met])
        hit = (least[place] < ids[met]) | (anchor[met] & (most[place] > ids[met]))
        met = met[hit & ~settled[met]]
        return by_document(ids[met], at=at[met].astype(np.uint32))

    return run


def _extend_tasks(block: int, span: int, buckets: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SettlingPacker(buckets, _settle_repeats, TaskContext.get().partitionId(), wide=True)
        for part in _zipped_pieces(parts):
            words = B.split_words(pa.array(_unzip(part), pa.large_binary()), B.NOT_SPACE)
            n = len(words.start)
            near = np.zeros(n + 1, dtype=np.int32)
            for first, ats in zip(words.first[:-1], part.column("ats"), strict=True):
                for at in ats.as_py():
                    x = first + np.frombuffer(at, dtype=np.uint32).astype(np.int64)
                    np.add.at(near, np.maximum(x - (span - block), first), 1)
                    np.subtract.at(near, x + 1, 1)
            starts = B.window_starts(words.first, span)
            starts = starts[np.cumsum(near)[starts] > 0]
            if not len(starts):
                continue
            hashes = B.window_hashes(words.hashes(), span)[starts]
            other = B.window_hashes(words.hashes(seed=1), span)[starts]
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            yield from packer.add(
                hashes, words.documents()[starts], ids, words.positions()[starts], more=other
            )
        yield from packer.end()

    return run


def _extend_bucket(table: pa.Table) -> pa.Table:
    if table["bucket"][0].as_py() < 0:
        at, ref_at = places(table).astype(np.uint32), joined(table["keys"], np.uint32)
        ids, ref = joined(table["ids"], np.int64), joined(table["tags"], np.int64)
        return by_document(ids, at=at, ref=ref, ref_at=ref_at)
    keys, more = joined(table["keys"], np.uint64), joined(table["more"], np.uint32)
    ids, at = per_key(table, "ids"), places(table)
    order = np.lexsort((at, ids, more, keys))
    keys, more, ids, at = keys[order], more[order], ids[order], at[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])
    origin = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))
    again = np.flatnonzero(ids > ids[origin])
    origin = origin[again]
    return by_document(
        ids[again], at=at[again].astype(np.uint32), ref=ids[origin], ref_at=at[origin].astype(np.uint32)
    )


def _merge(span: int):
    """Merges windows that come sorted by document; a document may go on in the next batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the last document so far
        for part in B.pieces(parts, _MERGED):
            ids = part.column("doc_id").to_numpy()
            if held and held[-1].column("doc_id")[-1].as_py() != ids[0]:
                yield _merged(pa.Table.from_batches(held), span)
                held = []
            last = int(np.searchsorted(ids, ids[-1]))
            if last:
                yield _merged(pa.Table.from_batches([*held, part.slice(0, last)]), span)
                held = []
            held.append(part.slice(last))
        if held:
            yield _merged(pa.Table.from_batches(held), span)

    return run


def _merged(found: pa.Table, span: int) -> pa.RecordBatch:
    """The maximal repeats of whole documents."""
    at = joined(found["at"], np.uint32).astype(np.int64)
    ref, ref_at = joined(found["ref"], np.int64), joined(found["ref_at"], np.uint32).astype(np.int64)
    counts = pc.binary_length(found["at"]).to_numpy() // np.dtype(np.uint32).itemsize
    doc = np.repeat(found["doc_id"].to_numpy(), counts)
    order = np.lexsort((at, doc))
    doc, at, ref, ref_at = doc[order], at[order], ref[order], ref_at[order]
    keep = np.ones(len(at), dtype=bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])
    doc, at, ref, ref_at = doc[keep], at[keep], ref[keep], ref_at[keep]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (np.diff(at) != 1) | (np.diff(ref_at) != 1) | (ref[1:] != ref[:-1])
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(at)) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(x, pa.int64()) for x in (doc[begin], at[begin], at[stop] + span, ref[begin], ref_at[begin])],
        ["doc_id", "start", "end", "ref_doc", "ref_start"],
    )


def repeats(docs: DataFrame, span: int = 50) -> DataFrame:
    """Maximal exact repeats of at least ``span`` words.

    Rows (doc_id, start, end, ref_doc, ref_start): words start..end-1 of the document are words
    ref_start.. of ref_doc, which has a smaller id: the smallest that has them, or of very common
    words the smallest beside it. Where the original changes, the next repeat begins, so repeats of a document may overlap.
    """
    base = documents(docs).filter("doc_id is not null")
    block = span // 2
    size = text_size(base)
    buckets = parts_for(size, 16 << 20, 64)
    hits = (
        base.mapInArrow(_probe_tasks(block, span - block, buckets), PACKED_TYPE)
        .groupBy("bucket")
        .applyInArrow(_probe_bucket(block), _HIT_TYPE)
    )
    hits = stage(hits, "hits").groupBy("doc_id").agg(F.collect_list("at").alias("ats"))
    found = (
        base.mapInArrow(_zip, _ZIPPED_TYPE)
        .join(hits.hint("shuffle_hash"), "doc_id")
        .mapInArrow(_extend_tasks(block, span, buckets), PACKED_TYPE)
        .groupBy("bucket")
        .applyInArrow(_extend_bucket, _REPEAT_TYPE)
    )
    # sorted rows and not a list per document: a batch holds the windows of many documents otherwise
    return found.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(_merge(span), _SPAN_TYPE)


def _remove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _zipped_pieces(parts):
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(_unzip(part), part.column("spans").to_pylist(), strict=True):
            words = text.split()
            stay = words
            if spans:
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                for s in spans:
                    edge[s["start"]] += 1
                    edge[s["end"]] -= 1
                stay = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
            n_words.append(len(words))
            n_removed.append(len(words) - len(stay))
            kept.append(b" ".join(stay))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def remove_repeats(docs: DataFrame, span: int = 50) -> DataFrame:
    """Each document without its repeats: doc_id, n_words, n_removed, kept (words with spaces)."""
    spans = stage(repeats(docs, span), "repeats")
    spans = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return (
        documents(docs)
        .mapInArrow(_zip, _ZIPPED_TYPE)
        .join(spans.hint("shuffle_hash"), "doc_id", "left")
        .mapInArrow(_remove, _KEPT_TYPE)
    )
