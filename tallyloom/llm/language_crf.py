"""Language of documents by a linear-chain conditional random field over words.

Each word has a language, so code-switched texts are labelled word by word. Features of a word
are its whole form (the lexicon), its prefixes and suffixes of one to three bytes, and all
byte trigrams inside; they are hashed to ``COLUMNS`` columns, with a weight per language. A
matrix of learned transitions joins neighbouring words. Marginals come from forward-backward;
a document's language is the one with the largest expected number of words, and its score is
that language's share.

Training maximises the conditional likelihood of a bounded sample of documents of each
language (``sample`` documents of at most ``sample_bytes``), all words of which have the
document's language, and of chains made of two pieces of different languages, from which the
transitions learn how rarely a text switches.

A chain is a line; lines of more than ``CHAIN`` words are several chains.

Definitions and edge cases
  * The language is ``und``, with score 0, for a null text and for one without any letter.
  * Languages are those found in the training rows, whatever they are. Without training rows
    every text is ``und``; with one language that one has score 1.
  * Ties go to the language that sorts first. Repeated rows are labelled each; a row without
    doc_id is labelled but not learned from. Empty tables give an empty result; other columns
    don't matter.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm import batches as B
from tallyloom.llm.common import documents, labelled_sample, send_model

COLUMNS = 1 << 16
CHAIN = 256
#: Letters, and numbers that are no digits, such as fractions; ``isalpha`` tells them apart.
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Chains:
    """Words of texts, their different forms' features, and the chains they stand in."""

    form: np.ndarray  # of each word: index of its form
    columns: np.ndarray  # features of all forms behind one another
    cuts: np.ndarray  # where each form's features start
    doc: np.ndarray
    first: np.ndarray  # first word of each chain
    size: np.ndarray  # words of each chain


def chains(column: pa.Array) -> Chains:
    words = B.split_words(column, B.NOT_SPACE, B.LOWER)
    h = words.hashes()
    doc = words.documents()
    one, form = np.unique(h, return_index=True, return_inverse=True)[1:]
    start, end = words.start[one], words.end[one]
    size = end - start
    base = [h[one]]
    owner = [np.arange(len(one))]
    for n in (1, 2, 3):
        fits = np.flatnonzero(size >= n)
        for at, tag in ((start[fits], 10 + n), (end[fits] - n, 20 + n)):
            base.append(B.span_hashes(words.data, at, at + n, seed=tag))
            owner.append(fits)
    grams = np.maximum(size - 2, 0)
    inner = np.repeat(np.arange(len(one)), grams)
    at = start[inner] + np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams)
    base.append(B.span_hashes(words.data, at, at + 3, seed=30))
    owner.append(inner)
    owner, columns = np.concatenate(owner), np.concatenate(base) % np.uint64(COLUMNS)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(len(one)))
    # Chains end with their line; long ones are cut.
    line = np.cumsum(words.data[: int(words.bounds[-1])] == 10)
    line = line[words.start] if len(h) else words.start
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(fresh)
    place = np.arange(len(h)) - np.repeat(heads, np.diff(np.append(heads, len(h))))
    first = np.flatnonzero(place % CHAIN == 0)
    return Chains(
        form, columns[order].astype(np.int64), cuts, doc, first, np.diff(np.append(first, len(h)))
    )


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, cuts, axis=0) if len(cuts) else values[:0]


def forward_backward(emission: np.ndarray, transition: np.ndarray, first, size):
    """Marginals per word, expected transitions, and log normaliser of all chains together.

    ``emission`` and ``transition`` are potentials in log form. All chains move on together,
    the longest ones first, so a step is a few array operations.
    """
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    steps = int(size[0]) if len(size) else 0
    top = emission.max(axis=1, keepdims=True)
    local, move = np.exp(emission - top), np.exp(transition)
    alpha, beta, scale = np.empty_like(local), np.empty_like(local), np.empty(len(local))
    alive = np.searchsorted(-size, -np.arange(steps), side="left")  # chains longer than t
    for t in range(steps):
        at = first[: alive[t]] + t
        now = local[at] if t == 0 else (alpha[at - 1] @ move) * local[at]
        total = now.sum(axis=1)
        alpha[at], scale[at] = now / total[:, None], total
    pairs = np.zeros_like(transition)
    for t in range(steps - 1, -1, -1):
        n = alive[t + 1] if t + 1 < steps else 0
        at = first[: alive[t]] + t
        beta[at[n:]] = 1
        if n:
            ahead = at[:n] + 1
            after = local[ahead] * beta[ahead] / scale[ahead][:, None]
            beta[at[:n]] = after @ move.T
            pairs += (alpha[at[:n]].T @ after) * move
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    return gamma, pairs, float(np.log(scale).sum() + top.sum())


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # COLUMNS x languages
    transition: np.ndarray

    def marginals(self, c: Chains) -> np.ndarray:
        emission = _sums(self.weights[c.columns], c.cuts)[c.form]
        return forward_backward(emission, self.transition, c.first, c.size)[0]

    def labels(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        n, many = len(column), len(self.languages)
        out, score = ["und"] * n, np.zeros(n)
        if not many:
            return out, score
        c = chains(column)
        total = np.zeros((n, many))
        if len(c.form):
            gamma = self.marginals(c)
            for y in range(many):
                total[:, y] = np.bincount(c.doc, gamma[:, y], n)
        best = total.argmax(axis=1)
        share = total[np.arange(n), best] / np.maximum(total.sum(axis=1), 1e-9)
        for k, text in enumerate(column.to_pylist()):
            if text and any(c.group().isalpha() for c in _LETTER.finditer(text)):
                out[k], score[k] = self.languages[best[k]], min(float(share[k]), 1.0)
        return out, score


def _switched(texts: list[str], labels: np.ndarray, rng) -> tuple[list[str], list[tuple]]:
    """Lines of two pieces of different languages: the text, and (words, label) of both."""
    out, parts = [], []
    for _ in range(len(texts)):
        a, b = rng.integers(0, len(texts), 2)
        if labels[a] == labels[b]:
            continue
        cut = []
        for k in (a, b):
            words = texts[k].encode().split()  # the white space of the operator
            n = int(rng.integers(3, 25))
            low = int(rng.integers(0, max(1, len(words) - n)))
            cut.append(words[low : low + n])
        out.append(b" ".join(cut[0] + cut[1]).decode())
        parts.append(((len(cut[0]), labels[a]), (len(cut[1]), labels[b])))
    return out, parts


def fit(texts: list[str | None], labels: list[str], rounds: int = 30) -> LanguageModel:
    """Weights and transitions by Adam on the log likelihood of all words."""
    languages = sorted(set(labels))
    many = len(languages)
    if many < 2:
        return LanguageModel(languages, np.zeros((COLUMNS, many), np.float32), np.zeros((many, many)))
    y = np.array([languages.index(x) for x in labels])
    texts = [t or "" for t in texts]
    more, parts = _switched(texts, y, np.random.default_rng(11))
    c = chains(pa.array(texts + more, pa.string()))
    of = np.concatenate(
        [y[c.doc[c.doc < len(texts)]]]
        + [np.repeat([a[1], b[1]], [a[0], b[0]]) for a, b in parts]
    ).astype(np.int64)
    goal = np.zeros((len(of), many), np.float32)
    goal[np.arange(len(of)), of] = 1
    inside = np.ones(len(of), dtype=bool)
    inside[c.first] = False
    at = np.flatnonzero(inside)
    seen = np.zeros((many, many))
    np.add.at(seen, (of[at - 1], of[at]), 1)
    weights, transition = np.zeros((COLUMNS, many), np.float32), np.zeros((many, many))
    moments = [np.zeros_like(x) for x in (weights, weights, transition, transition)]
    sizes = np.diff(np.append(c.cuts, len(c.columns)))
    for step in range(1, rounds + 1):
        emission = _sums(weights[c.columns], c.cuts)[c.form]
        gamma, pairs, _ = forward_backward(emission, transition, c.first, c.size)
        error = gamma - goal
        slope_w = np.empty_like(weights)
        for k in range(many):
            per_form = np.bincount(c.form, error[:, k], len(c.cuts))
            slope_w[:, k] = np.bincount(c.columns, np.repeat(per_form, sizes), COLUMNS)
        slope_w = slope_w / len(of) + 1e-6 * weights
        slope_t = (pairs - seen) / len(of) + 1e-6 * transition
        for x, slope, m in ((weights, slope_w, 0), (transition, slope_t, 2)):
            moments[m] += 0.1 * (slope - moments[m])
            moments[m + 1] += 0.01 * (slope * slope - moments[m + 1])
            bias = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            x -= 0.1 * bias * moments[m] / (np.sqrt(moments[m + 1]) + 1e-7)
    return LanguageModel(languages, weights, transition)


def fit_languages(
    docs: DataFrame, folds: int = 3, held: int = 1, sample: int = 150, sample_bytes: int = 8192
) -> LanguageModel:
    """Fit on at most ``sample`` documents a language, of at most ``sample_bytes`` each."""
    known = docs.select("doc_id", docs["lang"].alias("label"))
    rows = labelled_sample(docs, known, folds, held, sample, sample_bytes)
    return fit(rows["text"].to_pylist(), rows["label"].to_pylist())


def label_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    shared = send_model(docs.sparkSession, model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(shared.value)
        for piece in B.pieces(parts):
            labels, score = own.labels(piece.column(1))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(labels, pa.string()), pa.array(score)],
                ["doc_id", "lang_pred", "score"],
            )

    return documents(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
