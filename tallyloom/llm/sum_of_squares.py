"""Packing documents into fixed-length sequences by the sum-of-squares rule.

*Tokens.* Words are cut from whole batches of bytes, and each different word of a batch is
given to the tokenizer once. That is exact where a word's ids don't depend on its neighbours;
texts with control characters, special tokens' strings, or characters other than ASCII and
the Latin letters U+00C0 to U+027F (which NFC leaves alone) are tokenized as a whole instead.

*Packing.* An open sequence has a gap, the tokens still free. A piece goes to the gap for
which the squared numbers of open sequences per gap add up to least afterwards; if no gap is
wide enough it opens a sequence. Pieces of a group are placed from the longest down, which
leaves the short ones for the odd gaps. Groups of about ``group_size`` pieces are packed
independently, so the work is spread and each group wastes a few sequences' ends at most.

Definitions and edge cases
  * A document is its tokens and one end token, so a null or empty text has length 1. Only
    documents longer than a sequence are cut, at multiples of its length.
  * Equal lengths are placed in order of doc_id, piece. Repeated rows and rows without doc_id
    are packed like any other. An empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import batches as B
from tallyloom.llm.common import stage

_PIECE_TYPE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED_TYPE = _PIECE_TYPE + ", sequence_id long, offset long"

#: Kinds of bytes: 0 white space, 1 letter, 2 digit, 3 other.
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[[9, 10, 13, 32]] = 0
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_KIND[48:58] = 2
#: Texts with any of these bytes, or pairs of bytes, are tokenized as a whole: other control
#: characters, characters that are not Latin letters or have a special lower case, and what
#: may be a special token.
_ODD = np.zeros(256, dtype=bool)
_ODD[:32] = _ODD[127] = _ODD[0xC2] = _ODD[0xCA:] = True
_ODD[[9, 10, 13]] = False
_ODD_PAIRS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0), (ord("<"), ord("|")))
#: The vocabulary's characters for bytes: printable ones stand for themselves.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_AS_TEXT = {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)} - {*_PLAIN}))}
_AS_TEXT[32] = " "


def _odd_texts(data: np.ndarray, bounds: np.ndarray) -> list[int]:
    at = [np.flatnonzero(_ODD[data])]
    for first, second in _ODD_PAIRS:
        here = np.flatnonzero(data[:-1] == first)
        at.append(here[data[here + 1] == second])
    return np.unique(np.searchsorted(bounds, np.concatenate(at), side="right") - 1).tolist()


def _word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word: letters, one digit, other characters, or a contraction."""
    n = len(data)
    kind = _KIND[data]
    begins = np.ones(n, dtype=bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    heads = np.zeros(n + 1, dtype=bool)
    heads[bounds] = True
    begins |= heads[:n]
    closes = np.append(begins[1:], True)
    # 's 't 'm 'd 're 've 'll, where the quote starts a run of its own
    quote = np.flatnonzero((data == 39) & begins & closes & ~heads[1:])
    quote = quote[kind[quote + 1] == 1]
    if len(quote):
        padded = np.append(data, np.zeros(2, np.uint8))
        a, b = padded[quote + 1] | 32, padded[quote + 2] | 32
        two = ((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)
        two &= ~heads[np.minimum(quote + 2, n)] & (quote + 2 < n)
        size = np.where(np.isin(a, [115, 116, 109, 100]), 1, np.where(two, 2, 0))
        quote, size = quote[size > 0], size[size > 0]
        last = quote + size
        closes[quote] = begins[quote + 1] = False
        more = last + 1 < n
        begins[(last + 1)[more & ~closes[last]]] = True
        closes[last] = True
    begins &= kind != 0
    closes &= kind != 0
    return np.flatnonzero(begins), np.flatnonzero(closes) + 1


class WordTokenizer:
    """Token ids of texts, with each different word looked up once."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Tokenizer.from_file(path)  # for words in lower case, bytes as characters
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        size = self.tokenizer.get_vocab_size()
        self.closes = np.zeros(size, dtype=bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.closes[k] = token.endswith("</w>")
        self.row: dict[int, int] = {}  # of a word's hash
        self.ids = [np.empty(0, np.uint32)]
        self.sizes = [np.empty(0, np.int64)]

    def _whole(self, text: bytes) -> np.ndarray:
        encoding = self.tokenizer.encode(text.decode(), add_special_tokens=False)
        return np.array(encoding.ids, dtype=np.uint32)

    def _learn(self, words: list[bytes]) -> None:
        for k in range(0, len(words), 1000):
            line = b" ".join(words[k : k + 1000]).decode().lower()
            if not line.isascii():
                line = line.encode().decode("latin-1").translate(_AS_TEXT)
            encoding = self.words.encode_batch_fast([line], add_special_tokens=False)[0]
            ids = np.array(encoding.ids, dtype=np.uint32)
            self.ids.append(ids)
            self.sizes.append(np.diff(np.flatnonzero(self.closes[ids]), prepend=-1))

    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, sizes = np.concatenate(self.ids), np.concatenate(self.sizes)
        self.ids, self.sizes = [ids], [sizes]
        return ids, sizes, np.cumsum(sizes) - sizes

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another, and their bounds."""
        raw, bounds = B.text_bytes(column)
        odd = {k: self._whole(raw[bounds[k] : bounds[k + 1]].tobytes()) for k in _odd_texts(raw, bounds)}
        if odd:
            sizes = np.diff(bounds)
            sizes[list(odd)] = 0
            keep = np.ones(len(raw), dtype=bool)
            for k in odd:
                keep[bounds[k] : bounds[k + 1]] = False
            raw, bounds = raw[keep], np.concatenate([[0], np.cumsum(sizes)])
        start, end = _word_bounds(raw, bounds)
        data = np.append(raw, np.zeros(8, np.uint8))
        different, one, word = np.unique(
            B.span_hashes(data, start, end), return_index=True, return_inverse=True
        )
        rows = np.array([self.row.get(h, -1) for h in different.tolist()], dtype=np.int64)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            words = [data[start[k] : end[k]].tobytes() for k in one[fresh]]
            fresh = fresh[np.argsort([not w.isascii() for w in words], kind="stable")]
            words.sort(key=bytes.isascii, reverse=True)
            rows[fresh] = len(self.row) + np.arange(len(fresh))
            self.row.update(zip(different[fresh].tolist(), rows[fresh].tolist(), strict=True))
            self._learn(words)
        ids, sizes, at = self._table()
        word = rows[word]
        size = sizes[word]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.repeat(at[word] - total[:-1], size) + np.arange(total[-1])]
        cuts = total[np.searchsorted(start, bounds)]
        if not odd:
            return flat, cuts
        parts = [odd.get(k, flat[a:b]) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def _piece_tasks(path: str, length: int, end_id: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = None
        for part in B.pieces(parts, limit=4 * B.PIECE):
            tokenizer = tokenizer or WordTokenizer(path)
            ids, cuts = tokenizer.encode(part.column(1))
            rows: list[tuple] = []
            for doc, a, b in zip(part.column(0).to_pylist(), cuts[:-1], cuts[1:], strict=True):
                own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                for k in range(0, len(own), length):
                    piece = own[k : k + length]
                    rows.append((doc, k // length, k, len(piece), zlib.crc32(piece.tobytes())))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, longest first, by the sum-of-squares rule."""
    open_ = np.zeros(capacity + 1, dtype=np.int64)  # sequences per gap; a gap of 0 is closed
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = widest = 0
    for k in np.argsort(-lengths, kind="stable"):
        size = int(lengths[k])
        gap = 0
        if size <= widest:
            # from gap g to g - size the sum of squares changes by 2 * (N[g - size] - N[g] + 1)
            change = 2 * (open_[: widest + 1 - size] - open_[size : widest + 1] + 1)
            change[0] = 1 - 2 * open_[size]  # closes a sequence
            change[open_[size : widest + 1] == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            gap = best + size if open_[best + size] else 0
        if gap:
            at = waiting[gap].pop()
            open_[gap] -= 1
        else:
            at, gap, used = used, capacity, used + 1
        sequence[k], offset[k] = at, capacity - gap
        rest = gap - size
        if rest:
            open_[rest] += 1
            waiting[rest].append(at)
            widest = max(widest, rest)
        while widest and not open_[widest]:
            widest -= 1
    return sequence, offset


def _place_group(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        sequence, offset = place(table["length"].to_numpy(), capacity)
        group = table["grp"][0].as_py()
        return (
            table.drop_columns(["grp"])
            .append_column("sequence_id", pa.array((group << 32) + sequence))
            .append_column("offset", pa.array(offset))
        )

    return run


def token_pieces(docs: DataFrame, path: str, length: int = 4096, end_id: int = 1) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return base.mapInArrow(_piece_tasks(path, length, end_id), _PIECE_TYPE)


def pack(
    docs: DataFrame, path: str, length: int = 4096, end_id: int = 1, group_size: int = 20_000
) -> DataFrame:
    """Where each piece goes: the columns of ``token_pieces``, sequence_id and offset."""
    pieces = stage(token_pieces(docs, path, length, end_id), "pieces")
    groups = max(1, round(pieces.count() / group_size))
    dealt = pieces.withColumn("grp", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(_place_group(length), _PLACED_TYPE)
