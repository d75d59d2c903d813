"""Toxicity by a subsequence string kernel SVM with Nyström landmarks.

*Kernel.* ``K(s, t)`` sums over all common subsequences of four characters, each weighted by
``decay`` to the length it spans in s plus the length it spans in t. Inserted characters only
stretch a span, so "idxiot" stays close to "idiot". The kernel of a word and a landmark is
divided by the landmark's own and at most 1; it is taken as 0 below 0.6, or if the word misses
more than one character of the landmark (longest common subsequence). A word with the whole
landmark has 0.6 at least if no more characters are inserted than one between every two, as in
"ixdxixoxt".

*Landmarks* are word parts of 4 to 10 characters, chosen greedily by how much more often words with
them stand in positive than in negative training documents. The Nyström map multiplies the
kernel values with the inverse root of the landmarks' kernel matrix.

*Sentences.* A sentence's features are the sums of its words' kernel values. A linear SVM is
trained on sentences: all of negative documents, and of a positive document the one it finds
worst (twice, starting with the largest kernel value). A document is judged by the margin of
its worst sentence, the evidence of all its sentences, and that evidence per word; a logistic
fit on the training documents turns the three into a probability.

Words are what stands between white space without punctuation, symbols, combining marks and
characters of no width, of all of Unicode; A-Z are lower-cased. So "i.d.i.o.t" is one word; four
or more one-letter words in a row are one word too. Words over 32 characters are looked at in
windows of 32 that overlap by half, so whole texts are covered.

Bounds: the fit takes at most ``sample`` documents a class, of at most ``sample_bytes`` each,
chosen by the hash of their id (of a longer one, a stretch). Scoring reads the text only.

Edge cases
  * Null and empty texts, or texts without a suspicious word, get the score of no evidence.
  * Labels: rows without doc_id or label are left out; if rows of a document disagree, the
    larger counts. With no label, or one class alone, every document gets the share of
    positives (0 without labels).
  * Repeated rows are scored each. Empty tables give an empty result. Other columns don't matter.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm import batches as B
from tallyloom.llm.common import documents, labelled_sample

_P = 4
#: Smaller kernel values, as chance words have them, count as 0 (but see ``kernel_values``).
_LEAST = 0.6
_WIDTH = 32
_FAR = 1 << 20
_ENDS = np.array([10, 33, 46, 63])  # line feed ! . ?
_LETTER, _WHITE, _DROPPED = 0, 1, 2


def _kind(c: int) -> int:
    """What a character is to a word: part of it, its end, or nothing."""
    kind = unicodedata.category(chr(c))
    if kind[0] == "Z" or 9 <= c <= 13 or c == 0x85:
        return _WHITE
    name = unicodedata.name(chr(c), "")
    unseen = name.startswith("COMBINING") or "VARIATION SELECTOR" in name or name.endswith("FILLER")
    return _DROPPED if kind[0] in "PS" or kind in ("Cc", "Cf") or unseen else _LETTER


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Where runs of characters of one kind start, and their kinds."""
    codes = [*range(0x20000), *range(0xE0000, 0xE0200)]
    kinds = np.array([_kind(c) for c in codes], dtype=np.uint8)
    first = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
    return np.array(codes, dtype=np.uint32)[first], kinds[first]


_KIND_FROM, _KINDS = _kinds()
_ASCII_KIND = _KINDS[np.searchsorted(_KIND_FROM, np.arange(128, dtype=np.uint32), "right") - 1]


@dataclass
class Sentences:
    """Words of texts: their characters (once per different word), sentence and document."""

    chars: np.ndarray  # (different words, width), code points, 0 behind the end
    word: np.ndarray  # index into chars, per occurrence
    sentence: np.ndarray
    doc: np.ndarray
    counts: np.ndarray  # words per document


def characters(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts, and the bounds of the texts in them."""
    if not (raw > 127).any():
        return raw, bounds
    lead = (raw & 0xC0) != 0x80
    lead[bounds[:-1][bounds[:-1] < len(raw)]] = True
    at = np.flatnonzero(lead)
    code = raw[at].astype(np.uint32)
    wide = np.flatnonzero(code > 127)
    first = code[wide]
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    value = first & (0x7F >> size).astype(np.uint32)
    for k in (1, 2, 3):
        on = size > k
        after = raw[np.minimum(at[wide[on]] + k, len(raw) - 1)].astype(np.uint32)
        value[on] = value[on] << np.uint32(6) | after & np.uint32(0x3F)
    code[wide] = np.where(value > 0x10FFFF, 0xFFFD, value)
    return code, np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])[bounds]


def sentences(column: pa.Array) -> Sentences:
    code, bounds = characters(*B.text_bytes(column))
    kind = _ASCII_KIND[np.minimum(code, 127)]
    wide = np.flatnonzero(code > 127)
    kind[wide] = _KINDS[np.searchsorted(_KIND_FROM, code[wide], "right") - 1]
    kept = kind != _DROPPED
    ends = np.cumsum(np.isin(code, _ENDS), dtype=np.int64)[kept]
    bounds = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])[bounds]
    data, mine = code[kept], kind[kept] == _LETTER
    data[(data >= 65) & (data <= 90)] += 32
    if len(data):
        data = data.astype(np.min_scalar_type(data.max()))
    cut = np.zeros(len(data) + 1, dtype=bool)  # before each character
    cut[bounds] = True
    white = np.concatenate([[True], ~mine, [True]])
    start = np.flatnonzero(mine & (white[:-2] | cut[:-1]))
    end = np.flatnonzero(mine & (white[2:] | cut[1:])) + 1
    counts = np.diff(np.searchsorted(start, bounds))
    doc = np.repeat(np.arange(len(counts)), counts)
    length = end - start
    sent = ends[start] if len(start) else start
    # Four or more single letters in a row are one more word.
    single = np.flatnonzero(length == 1)
    extra: list[tuple[int, int]] = []
    if len(single) > 3:
        cut = (np.diff(single) != 1) | (doc[single[1:]] != doc[single[:-1]])
        for run in np.split(single, np.flatnonzero(cut) + 1):
            if len(run) > 3:
                extra.append((run[0], run[-1]))
    if extra:
        joined = [data[start[a : b + 1]] for a, b in extra]
        at = len(data) + np.concatenate([[0], np.cumsum([len(x) for x in joined])])
        data = np.concatenate([data, *joined])
        first = np.array([a for a, _ in extra])
        start, end = np.concatenate([start, at[:-1]]), np.concatenate([end, at[1:]])
        doc, sent = np.concatenate([doc, doc[first]]), np.concatenate([sent, sent[first]])
        length = end - start
    long = np.flatnonzero(length > _WIDTH)
    if len(long):
        n = -(-(length[long] - _WIDTH) // (_WIDTH // 2)) + 1
        owner = np.repeat(long, n)
        step = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * (_WIDTH // 2)
        short = np.flatnonzero(length <= _WIDTH)
        end = np.concatenate([end[short], np.minimum(start[owner] + step + _WIDTH, end[owner])])
        start = np.concatenate([start[short], start[owner] + step])
        doc, sent = (np.concatenate([x[short], x[owner]]) for x in (doc, sent))
    each = data.itemsize
    spans = np.concatenate([data.view(np.uint8), np.zeros(8, np.uint8)])
    _, one, word = np.unique(
        B.span_hashes(spans, start * each, end * each), return_index=True, return_inverse=True
    )
    chars = np.zeros((len(one), _WIDTH), dtype=data.dtype)
    size = end[one] - start[one]
    for k in range(int(size.max()) if len(one) else 0):
        on = size > k
        chars[on, k] = data[start[one][on] + k]
    return Sentences(chars, word, sent, doc, counts)


def _codes(word: str | bytes) -> np.ndarray:
    """Code points of a word, of the smallest type."""
    codes = np.array([*word] if isinstance(word, bytes) else [ord(c) for c in word], np.uint32)
    return codes.astype(np.min_scalar_type(codes.max()))


def _word(row: np.ndarray) -> str:
    return "".join(map(chr, row[row > 0].tolist()))


def subsequence_kernel(chars: np.ndarray, landmark: str | bytes, decay: float) -> np.ndarray:
    """Kernel of each row of characters (0 behind the end) with one string."""
    n, m, d2 = len(chars), len(landmark), decay * decay
    target = _codes(landmark)
    # above[i][:, j]: subsequences of i characters within the row so far and the first j of
    # the landmark, weighted from their first character to the end of both.
    above = [np.ones((n, m + 1))] + [np.zeros((n, m + 1)) for _ in range(_P - 1)]
    total = np.zeros(n)
    for x in chars.T:
        same = x[:, None] == target
        total += (same * above[_P - 1][:, :-1]).sum(axis=1) * d2
        for i in range(_P - 1, 0, -1):
            here = np.zeros(n)
            for j in range(m):
                here = decay * here + d2 * same[:, j] * above[i - 1][:, j]
                above[i][:, j + 1] = decay * above[i][:, j + 1] + here
    return total


def common_length(chars: np.ndarray, landmark: str | bytes) -> np.ndarray:
    """Length of the longest common subsequence of each row with the landmark, bit-parallel."""
    codes = _codes(landmark)
    table = np.zeros(max(255, int(codes.max()), int(chars.max(initial=0))) + 1, dtype=np.uint64)
    for k, c in enumerate(codes):
        table[c] |= np.uint64(1 << k)
    full = np.uint64((1 << len(landmark)) - 1)
    state = np.full(len(chars), full)
    for x in chars.T:
        hit = state & table[x]
        state = ((state + hit) | (state - hit)) & full
    return len(landmark) - np.bitwise_count(state).astype(np.int64)


def shortest_span(chars: np.ndarray, landmark: str | bytes) -> np.ndarray:
    """Characters from first to last where a row holds the landmark closest together, or many."""
    codes = _codes(landmark)
    begun = np.full((len(chars), len(codes) + 1), -_FAR)  # latest start of the first j characters
    span = np.full(len(chars), _FAR)
    for at, x in enumerate(chars.T):
        begun[:, 0] = at
        begun[:, 1:] = np.where(x[:, None] == codes, begun[:, :-1], begun[:, 1:])
        span = np.minimum(span, at + 1 - begun[:, -1])
    return span


def kernel_values(chars: np.ndarray, landmarks: list[str], decay: float) -> np.ndarray:
    """Kernel of each word with each landmark, divided by the landmark's own: 0, or ``_LEAST`` to 1.

    A landmark with at most one more character between every two of its own has ``_LEAST``.
    """
    out = np.zeros((len(chars), len(landmarks)))
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    mask = np.bitwise_or.reduce(np.where(chars > 0, bit[chars & 63], np.uint64(0)), axis=1)
    for k, mark in enumerate(landmarks):
        letters = np.bitwise_or.reduce(bit[_codes(mark) & 63])
        need = int(np.bitwise_count(letters)) - 1  # one character may be missing
        near = np.flatnonzero(np.bitwise_count(mask & letters) >= need)
        near = near[common_length(chars[near], mark) >= max(_P, len(mark) - 1)]
        if len(near):
            own = subsequence_kernel(_codes(mark)[None], mark, decay)[0]
            value = subsequence_kernel(chars[near], mark, decay) / own
            weak = np.flatnonzero(value < _LEAST)
            whole = shortest_span(chars[near[weak]], mark) < 2 * len(mark)
            value[weak] = np.where(whole, _LEAST, 0)
            out[near, k] = value
    return np.minimum(out, 1)


def suspicious(column: pa.Array, landmarks: list[str], decay: float):
    """Document and features of each sentence with a word close to a landmark; words per text."""
    s = sentences(column)
    values = kernel_values(s.chars, landmarks, decay)
    hot = (values > 0).any(axis=1)
    at = np.flatnonzero(hot[s.word])
    if not len(at):
        return np.empty(0, np.int64), np.empty((0, len(landmarks))), s.counts
    place, inverse = np.unique(
        np.stack([s.doc[at], s.sentence[at]]), axis=1, return_inverse=True
    )
    features = np.zeros((place.shape[1], len(landmarks)))
    np.add.at(features, inverse.ravel(), values[s.word[at]])
    return place[0], features, s.counts


def _parts(word: str) -> set[str]:
    return {
        word[k : k + size]
        for size in range(_P, min(10, len(word)) + 1)
        for k in range(len(word) - size + 1)
    }


def choose_landmarks(texts: list[str | None], toxic: np.ndarray, most: int) -> list[str]:
    """Word parts whose words stand more often in positive documents, by greedy cover."""
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    least = (2 if n1 > 3 else 1) / n1
    lift: dict[str, float] = {}
    positive: Counter = Counter()
    for text, label in zip(texts, toxic, strict=True):
        s = sentences(pa.array([text], pa.string()))
        words = {w for row in s.chars if len(w := _word(row)) >= _P}
        if label:
            positive.update(words)
        # A word must be three times as common in positive documents to speak for a part.
        change = 1 / n1 if label else -3 / n0
        for word in words:
            lift[word] = lift.get(word, 0.0) + change
    strong = sorted((w for w in positive if positive[w] / n1 >= least), key=lambda w: (-lift[w], w))
    cover = {p: 0.0 for w in strong[:2000] for p in _parts(w)}
    del positive, strong
    for word, change in lift.items():
        for p in _parts(word) & cover.keys():
            cover[p] += change
    chosen: list[str] = []
    floor = 0.05 * max(cover.values(), default=0)
    cover = {p: c for p, c in cover.items() if c > floor}
    while cover and len(chosen) < most:
        best = max(cover, key=lambda p: (round(cover[p], 9), len(p), p))
        if cover[best] <= floor:
            break
        chosen.append(best)
        for word in [w for w in lift if best in w]:
            change = lift.pop(word)
            for p in _parts(word) & cover.keys():
                cover[p] -= change
        cover.pop(best, None)
    return chosen


@dataclass
class ToxicityModel:
    landmarks: list[str]
    decay: float
    weights: np.ndarray  # on kernel values: Nyström map times SVM weights
    bias: float
    judge: np.ndarray  # of the logistic fit: worst margin, evidence, evidence per word, constant

    def evidence(self, column: pa.Array) -> np.ndarray:
        """What the logistic fit looks at, a row per document."""
        out = np.zeros((len(column), 4))
        out[:, 0], out[:, 3] = self.bias, 1
        if self.landmarks:
            doc, x, counts = suspicious(column, self.landmarks, self.decay)
            part = x @ self.weights
            np.maximum.at(out[:, 0], doc, part + self.bias)
            total = np.bincount(doc, np.maximum(part, 0), len(column))
            out[:, 1] = np.log1p(total)
            out[:, 2] = np.log1p(100 * total / np.maximum(counts, 1))
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(column) @ self.judge, -50, 50)))


def nystrom_map(landmarks: list[str], decay: float) -> np.ndarray:
    """Inverse root of the landmarks' kernel matrix, for values divided by own kernels."""
    chars = np.zeros((len(landmarks), _WIDTH), dtype=np.uint32)
    for k, mark in enumerate(landmarks):
        chars[k, : len(mark)] = _codes(mark)
    raw = np.stack([subsequence_kernel(chars, mark, decay) for mark in landmarks])
    root = np.sqrt(np.diag(raw))
    values, vectors = np.linalg.eigh(raw / np.outer(root, root))
    inverse = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    return inverse


def linear_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 400):
    """Weights and bias of a squared-hinge SVM with a cost per row, by accelerated descent."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    reg = np.append(np.full(x.shape[1], 1e-3), 0.0)
    rate = 1 / (2 * np.linalg.norm(x1 * np.sqrt(cost)[:, None], 2) ** 2 + 2e-3)
    w = v = np.zeros(x1.shape[1])
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        step = v - rate * (2 * reg * v - 2 * x1.T @ (cost * y * slack))
        w, v = step, step + k / (k + 3) * (step - w)
    return w[:-1], float(w[-1])


def _logistic(a: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients of a logistic fit with Platt's softened goals; the last column is constant."""
    n1, n0 = y.sum(), len(y) - y.sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.zeros(a.shape[1])
    keep = ridge * np.diag(np.append(np.ones(a.shape[1] - 1), 1e-3))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + keep
        move = np.linalg.solve(hessian, a.T @ (p - goal) + keep @ w)
        w = w - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return w


def fit(texts: list[str | None], toxic: np.ndarray, most: int = 48, decay: float = 0.8) -> ToxicityModel:
    """The model of labelled texts."""
    toxic = np.asarray(toxic, dtype=np.int64)
    share = float(toxic.mean()) if len(toxic) else 0.0
    marks = choose_landmarks(texts, toxic, most) if 0 < share < 1 else []
    if not marks:
        odds = np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -20, 20)
        return ToxicityModel([], decay, np.empty(0), 0.0, np.array([0, 0, 0, odds]))
    column = pa.array(texts, pa.string())
    doc, values, _ = suspicious(column, marks, decay)
    inverse = nystrom_map(marks, decay)
    z = values @ inverse
    positive = toxic[doc] == 1
    rank = values.max(axis=1)
    for _ in range(2):
        order = np.lexsort((-rank, doc))
        worst = order[np.append(True, doc[order][1:] != doc[order][:-1])]
        use = np.concatenate([worst[positive[worst]], np.flatnonzero(~positive)])
        x = np.vstack([z[use], np.zeros((1, z.shape[1]))])
        y = np.append(np.where(positive[use], 1.0, -1.0), -1.0)
        n1, n0 = (y > 0).sum(), (y < 0).sum()
        cost = np.where(y > 0, 1 / max(n1, 1), 0.5 / n0)
        cost[-1] = 0.5  # documents without evidence weigh as much as the other negatives
        weights, bias = linear_svm(x, y, cost)
        rank = z @ weights
    model = ToxicityModel(marks, decay, inverse @ weights, bias, np.zeros(4))
    model.judge = _logistic(model.evidence(column), toxic)
    return model


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, sample: int = 1000,
    sample_bytes: int = 32768,
) -> ToxicityModel:
    """Fit on a bounded sample of the labelled documents outside the held-out fold."""
    known = labels.select("doc_id", labels["toxic"].cast("int").alias("label"))
    rows = labelled_sample(docs, known, folds, held, sample, sample_bytes)
    return fit(rows["text"].to_pylist(), rows["label"].to_numpy())


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and the score (0 to 1) of every whole text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in B.pieces(parts):
            score = pa.array(model.scores(piece.column(1)))
            yield pa.RecordBatch.from_arrays([piece.column(0), score], ["doc_id", "score"])

    return documents(docs).mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: ToxicityModel, limit: float) -> DataFrame:
    """The rows of ``docs`` that score less than ``limit``, with all their columns."""
    place = docs.columns.index("text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in B.pieces(parts, piece_column=place):
            yield piece.filter(pa.array(model.scores(piece.column(place)) < limit))

    return docs.mapInArrow(run, docs.schema)
