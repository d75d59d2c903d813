"""Document quality by voting of nearest neighbours in a latent semantic space.

A document's terms are the shapes of its words (runs of capitals, small letters, digits,
characters beyond ASCII, and other characters, each run as one), pairs of neighbouring
shapes, and marks for words that repeat the word before; and its words (letters and digits, A-Z
lower-cased) and pairs of neighbouring words. Terms are hashed to ``TERMS`` columns for shapes and
as many for words, and weighted by log counts and inverse document frequency; the words' part
has the length ``_SHARE`` of the shapes' part. A singular value decomposition of
a labelled sample gives the latent space. The labelled vectors (a bounded sample) are
broadcast; each document's vector meets all of them in exact blocked cosine products, and its
``k`` nearest vote with their similarity as weight.

Edge cases
  * Null and empty texts have no terms and no neighbours; they get the share of label 1 among
    the sample.
  * Labels: rows without doc_id or label are left out; if rows of a document disagree, the
    larger counts. Without any label every score is 0.
  * Ties between neighbours go to the one that comes first in the sample, which is by doc_id.
    Repeated rows are scored each. Empty tables give an empty result; other columns don't matter.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm import batches as B
from tallyloom.llm.common import documents, labelled_sample, send_model

TERMS = 4096
#: Of words against shapes.
_SHARE = 0.5
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58] = ord("A"), ord("a"), ord("0")
_SHAPE[128:] = 128
_SHAPE[9:14] = 32


def term_counts(column: pa.Array) -> np.ndarray:
    """Counts of the hashed terms, a row per text: of shapes, then of words."""
    words = B.split_words(column, B.NOT_SPACE, B.LOWER)
    same = words.hashes()
    again = np.zeros(len(same), dtype=bool)
    again[1:] = same[1:] == same[:-1]
    heads = words.first[:-1][words.first[:-1] < len(same)]
    again[heads] = False
    raw, bounds = B.text_bytes(column)
    shape = _SHAPE[raw]
    keep = np.ones(len(raw), dtype=bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[bounds[:-1][bounds[:-1] < len(raw)]] = True
    cuts = np.concatenate([[0], np.cumsum(keep)])[bounds]
    short = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(column),
        [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(shape[keep].tobytes())],
    )
    shapes = B.split_words(short, B.NOT_SPACE)
    marks = np.full(int(again.sum()), 7, np.int64), words.documents()[again]
    out = np.empty((len(column), 2 * TERMS), np.float32)
    spelled = B.split_words(column, B.ALNUM, B.LOWER)
    for k, (term, doc) in enumerate((_ones_and_pairs(shapes), _ones_and_pairs(spelled))):
        if not k:
            term, doc = np.concatenate([term, marks[0]]), np.concatenate([doc, marks[1]])
        flat = np.bincount(doc * TERMS + term, minlength=len(column) * TERMS)
        out[:, k * TERMS : (k + 1) * TERMS] = flat.reshape(len(column), TERMS)
    return out


def _ones_and_pairs(words: B.Words) -> tuple[np.ndarray, np.ndarray]:
    """Column and document of each word and each pair of neighbouring words."""
    one, doc = words.hashes(), words.documents()
    starts = B.window_starts(words.first, 2)
    two = B.window_hashes(one, 2)[starts] if len(starts) else one[:0]
    term = np.concatenate([one, two]) % np.uint64(TERMS)
    return term.astype(np.int64), np.concatenate([doc, doc[starts]])


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return _unit(np.hstack([_unit(x[:, :TERMS]), np.float32(_SHARE) * _unit(x[:, TERMS:])]))


@dataclass
class NeighbourModel:
    idf: np.ndarray
    space: np.ndarray  # terms to latent dimensions
    vectors: np.ndarray  # of the labelled sample, of length 1
    labels: np.ndarray
    k: int

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.idf) @ self.space)

    def scores(self, column: pa.Array, block: int = 512) -> np.ndarray:
        share = float(self.labels.mean()) if len(self.labels) else 0.0
        out = np.full(len(column), share)
        k = min(self.k, len(self.labels))
        if not k:
            return out
        cuts = range(0, len(column), block)  # counts are wide, so not of all short texts at once
        none = np.zeros((0, self.space.shape[1]), np.float32)
        parts = (self.latent(term_counts(column.slice(low, block))) for low in cuts)
        mine = np.concatenate([none, *parts])
        some = np.flatnonzero((mine != 0).any(axis=1))
        for low in range(0, len(some), block):
            rows = some[low : low + block]
            cosine = mine[rows] @ self.vectors.T
            cut = np.partition(cosine, -k, axis=1)[:, -k][:, None]
            near = cosine > cut
            tied = cosine == cut
            near |= tied & (np.cumsum(tied, axis=1) <= k - near.sum(axis=1, keepdims=True))
            weight = np.where(near, np.maximum(cosine, 1e-6), 0)
            out[rows] = (weight @ self.labels) / weight.sum(axis=1)
        return np.clip(out, 0, 1)


def right_singular(x: np.ndarray, dims: int, rounds: int = 8) -> np.ndarray:
    """The first right singular vectors of ``x``, by subspace iteration."""
    width = min(dims + 16, *x.shape)
    basis = np.random.default_rng(7).standard_normal((x.shape[1], width)).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, values, turn = np.linalg.svd(x @ basis, full_matrices=False)
    keep = np.flatnonzero(values[:dims] > 1e-3)
    return (basis @ turn[keep].T).astype(np.float32)


def fit(texts: list[str | None], labels: np.ndarray, dims: int = 48, k: int = 25) -> NeighbourModel:
    """The latent space and the labelled vectors of a sample."""
    labels = np.asarray(labels, dtype=np.float32)
    groups = [texts[i : i + 500] for i in range(0, len(texts), 500)]
    empty = np.zeros((0, 2 * TERMS), np.float32)
    counts = np.concatenate([empty, *(term_counts(pa.array(g, pa.string())) for g in groups)])
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    x = _weighted(counts, idf)
    space = right_singular(x, dims)
    model = NeighbourModel(idf, space, np.zeros((0, space.shape[1]), np.float32), labels, k)
    model.vectors = model.latent(counts)
    return model


def fit_quality(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample: int = 1000,
    sample_bytes: int = 32768,
) -> NeighbourModel:
    """Fit on at most ``sample`` documents a class, of at most ``sample_bytes`` each."""
    known = labels.select("doc_id", labels["quality"].cast("int").alias("label"))
    rows = labelled_sample(docs, known, folds, held, sample, sample_bytes)
    return fit(rows["text"].to_pylist(), rows["label"].to_numpy())


def score_quality(docs: DataFrame, model: NeighbourModel) -> DataFrame:
    """doc_id and the score (0 to 1) of every whole text."""
    shared = send_model(docs.sparkSession, model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(shared.value)
        for piece in B.pieces(parts, limit=B.PIECE // 2):
            score = pa.array(own.scores(piece.column(1)), pa.float64())
            yield pa.RecordBatch.from_arrays([piece.column(0), score], ["doc_id", "score"])

    return documents(docs).mapInArrow(run, "doc_id long, score double")
