"""Encoding and decoding with SentencePiece vocabularies of the merge type.

*Encoding.* The characters of a text are its first symbols. All adjacent symbols that make a
piece together are on an agenda, ordered by the score of that piece and, among equals, from
left to right; its first pair becomes one symbol, the pairs with its new neighbours join the
agenda, until it is empty. Two characters that stand beside each other in no piece never come
into one symbol, so texts are cut there, and the agenda is worked off once for each different
stretch of a batch: for all short stretches at a time (each round takes the first pair of every
stretch), and from a heap for long ones. Characters without a piece become their bytes' pieces.

*Decoding.* The bytes of all pieces behind one another, without the space that encoding put
in front; bytes that make no character become U+FFFD one by one.

*Check.* ``check=True`` gives each Arrow batch to the sentencepiece library too and says for each
text whether its ids and its decoded text are the same.

Definitions and edge cases
  * A null text is empty; an empty text has no ids and decodes to the empty text. Very long texts
    are encoded whole. Repeated rows and rows without doc_id are encoded like any other. An empty
    table gives an empty result; other columns don't matter.
  * U+2581 stands for a space, as in the library, so it decodes to one.
  * No begin or end ids, no sampling. Models must be of the merge type, with byte pieces, a space in
    front and no other change to the text; others are refused (found out by trying them).
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import batches as B
from tallyloom.llm.common import documents

_SPACE = "▁"
_CODED_TYPE = "doc_id long, ids array<int>, decoded string, agrees boolean"
#: Stretches of more symbols have a heap of their own.
_LONG = 24
_NEVER = np.int64(1) << 62
#: A model must agree with its library on these texts.
_PROBES = ["a", " a  b ", "x▁y", "AﬁＡ", "\n\t", "é", "x\x00y", "<s><0x0A>", "\U0001f600͸"]


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and code point of each character of valid UTF-8; ``data`` has four more bytes."""
    start = np.flatnonzero((data[:-4] & 0xC0) != 0x80)
    lead = data[start].astype(np.int64)
    code = lead.copy()
    for size, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0x100)):
        rows = np.flatnonzero((lead >= low) & (lead < high))
        value = lead[rows] & (0xFF >> (size + 1))
        for k in range(1, size):
            value = value << 6 | data[start[rows] + k] & 0x3F
        code[rows] = value
    return start, code


class PieceCoder:
    """A vocabulary with its tables: pairs of symbols, characters, bytes of pieces."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        size = self.size = lib.get_piece_size()
        plain = {}
        self.silent = np.array([lib.is_control(k) for k in range(size)])
        byte_ids = {}
        for k in range(size):
            piece = lib.id_to_piece(k)
            if lib.is_byte(k):
                byte_ids[int(piece[1:-1], 16)] = k
            elif not (lib.is_control(k) or lib.is_unknown(k)):
                plain[piece.replace(_SPACE, " ")] = k
        if len(byte_ids) < 256 or any(lib.is_unused(k) for k in range(size)):
            raise ValueError("the model must have pieces for all bytes and none unused")
        self.byte_ids = np.array([byte_ids[b] for b in range(256)], dtype=np.int32)
        symbols = dict(plain)
        for c in sorted({c for piece in plain for c in piece}):
            symbols.setdefault(c, len(symbols) + size)  # a character within pieces only
        self.symbol_of = np.full(0x110000, -1, dtype=np.int32)
        for c, k in symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = k
        self.base = size + len(symbols)
        self._tabulate_pairs(plain, symbols)
        self._tabulate_bytes(plain, byte_ids)
        for text in _PROBES:
            ids = self.encode(pa.array([text]))[0].tolist()
            if ids != lib.encode(text) or self.decode(ids) != lib.decode(ids):
                raise ValueError("not a merge-type model with a space in front and unchanged text")

    def _tabulate_pairs(self, plain: dict[str, int], symbols: dict[str, int]) -> None:
        scores = {k: self.library.get_score(k) for k in plain.values()}
        place = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = {}
        self.joins = np.zeros((256, 256), dtype=bool)
        for piece, k in plain.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                self.joins[left.encode()[-1], right.encode()[0]] = True
                if left in symbols and right in symbols:
                    pairs[symbols[left] * self.base + symbols[right]] = (place[scores[k]], k)
        self.pairs = pairs
        order = sorted(pairs)
        self.pair_keys = np.array(order, dtype=np.int64)
        self.pair_place = np.array([pairs[x][0] for x in order], dtype=np.int64)
        self.pair_symbol = np.array([pairs[x][1] for x in order], dtype=np.int32)

    def _tabulate_bytes(self, plain: dict[str, int], byte_ids: dict[int, int]) -> None:
        spelled = [b""] * self.size
        for piece, k in plain.items():
            spelled[k] = piece.encode()
        for b, k in byte_ids.items():
            spelled[k] = bytes([b])
        spelled[self.library.unk_id()] = " ⁇ ".encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_size = np.array([len(x) for x in spelled], dtype=np.int64)
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size
        self.spaced = np.zeros(self.size, dtype=bool)
        self.spaced[[k for piece, k in plain.items() if piece.startswith(" ")]] = True
        codecs.register_error("piece_one_by_one", _one_by_one)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of the pair table for each pair of symbols, or -1."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.base + right)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, at, -1)

    def _merge_short(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Work off the agendas of many stretches; returns symbols and the character each starts at.

        ``word`` numbers the stretch of each symbol. A round takes the first pair of each agenda.
        """
        at = np.arange(len(symbol))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        pair = np.full(len(symbol), -1)
        same = np.flatnonzero(word[1:] == word[:-1])
        pair[same] = self._look_up(symbol[same], symbol[same + 1])
        while len(symbol):
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            place = np.where(pair >= 0, self.pair_place[pair] << 32 | np.arange(len(pair)), _NEVER)
            first = np.minimum.reduceat(place, heads)
            more = first < _NEVER
            if not more.all():
                open_ = np.repeat(more, np.diff(np.append(heads, len(symbol))))
                done.append((symbol[~open_], at[~open_]))
                symbol, word, at, pair = symbol[open_], word[open_], at[open_], pair[open_]
                heads = np.flatnonzero(np.diff(word, prepend=-1))
                place = np.where(pair >= 0, self.pair_place[pair] << 32 | np.arange(len(pair)), _NEVER)
                first = np.minimum.reduceat(place, heads) if len(heads) else first[:0]
            left = first & 0xFFFFFFFF
            symbol[left] = self.pair_symbol[pair[left]]
            keep = np.ones(len(symbol), dtype=bool)
            keep[left + 1] = False
            new = left - np.arange(len(left))  # places after the right symbols have gone
            symbol, word, at, pair = symbol[keep], word[keep], at[keep], pair[keep]
            for a in (new - 1, new):
                real = a[(a >= 0) & (a + 1 < len(symbol))]
                real = real[word[real] == word[real + 1]]
                pair[real] = self._look_up(symbol[real], symbol[real + 1])
            ends = new[(new + 1 == len(symbol)) | (word[np.minimum(new + 1, len(symbol) - 1)] != word[new])]
            pair[ends] = -1
        if not done:
            return symbol, at
        symbol, at = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(at)
        return symbol[order], at[order]

    def _merge_long(self, symbol: list[int]) -> tuple[list[int], list[int]]:
        """Work off the agenda of one stretch; symbols and the character each starts at."""
        n = len(symbol)
        before, behind = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int, int]] = []

        def put(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and symbol[a] >= 0 and symbol[b] >= 0:
                found = self.pairs.get(symbol[a] * self.base + symbol[b])
                if found:
                    heapq.heappush(agenda, (found[0], a, b, symbol[a], symbol[b]))

        for k in range(n - 1):
            put(k, k + 1)
        alive = [True] * n
        while agenda:
            _, a, b, left, right = heapq.heappop(agenda)
            if not (alive[a] and alive[b] and behind[a] == b and symbol[a] == left and symbol[b] == right):
                continue  # one of both has become part of another symbol
            symbol[a] = self.pairs[left * self.base + right][1]
            alive[b] = False
            behind[a] = behind[b]
            if behind[b] >= 0:
                before[behind[b]] = a
            put(before[a], a)
            put(a, behind[a])
        kept = [k for k in range(n) if alive[k]]
        return [symbol[k] for k in kept], kept

    def _encode_stretches(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches behind one another, and their bounds."""
        start, code = _characters(data)
        symbol = self.symbol_of[code]
        first = np.searchsorted(start, bounds)
        count = np.diff(first)
        word = np.repeat(np.arange(len(count)), count)
        short = count[word] <= _LONG
        chars = np.flatnonzero(short)
        merged, at = self._merge_short(symbol[chars], word[chars])
        symbols, ats = [merged], [chars[at]]
        for w in np.flatnonzero(count > _LONG).tolist():
            merged, at = self._merge_long(symbol[first[w] : first[w + 1]].tolist())
            symbols.append(np.array(merged, dtype=np.int32))
            ats.append(first[w] + np.array(at, dtype=np.int64))
        symbol, at = np.concatenate(symbols), np.concatenate(ats)
        order = np.argsort(at, kind="stable")
        symbol, at = symbol[order], at[order]
        # a symbol without a piece is one character, and gives its bytes
        bare = (symbol < 0) | (symbol >= self.size)
        size = np.ones(len(symbol), dtype=np.int64)
        size[bare] = np.append(start, bounds[-1])[at[bare] + 1] - start[at[bare]]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = np.repeat(symbol, size)
        if bare.any():
            spread = np.repeat(bare, size)
            byte = np.repeat(start[at] - total[:-1], size)[spread] + np.flatnonzero(spread)
            ids[spread] = self.byte_ids[data[byte]]
        return ids, total[np.searchsorted(at, first)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another, and their bounds."""
        text = pc.fill_null(column.cast(pa.large_string()), "")
        text = pc.replace_substring(text, _SPACE, " ")
        space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        front = pc.if_else(pc.greater(pc.binary_length(text), 0), space, nothing)
        text = pc.binary_join_element_wise(front, text, nothing)
        raw, bounds = B.text_bytes(text)
        if not len(raw):
            return np.empty(0, np.int32), np.zeros(len(bounds), np.int64)
        cut = (raw & 0xC0) != 0x80
        cut[1:] &= ~self.joins.ravel()[raw[:-1].astype(np.uint16) << 8 | raw[1:]]
        cut[bounds[bounds < len(raw)]] = True
        at = np.append(np.flatnonzero(cut), len(raw))
        stretches = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]
        ).dictionary_encode()
        data, own = B.text_bytes(stretches.dictionary)
        ids, cuts = self._encode_stretches(np.append(data, np.zeros(4, np.uint8)), own)
        which = stretches.indices.to_numpy()
        size = np.diff(cuts)[which]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.repeat(cuts[which] - total[:-1], size) + np.arange(total[-1])]
        return flat, total[np.searchsorted(at, bounds)]

    def _spell(self, ids: np.ndarray) -> bytes:
        size = self.spelled_size[ids]
        total = np.cumsum(size)
        at = np.repeat(self.spelled_at[ids] - total + size, size) + np.arange(total[-1] if len(ids) else 0)
        return self.spelled[at].tobytes()

    def decode(self, ids) -> str:
        """The text of some ids. Control ids have none, and part the bytes beside them."""
        ids = np.asarray(ids, dtype=np.int64)
        silent = self.silent[ids]
        spoken = ids[~silent]
        runs = np.split(ids, np.flatnonzero(silent)) if silent.any() else [ids]
        text = "".join(self._spell(run).decode("utf-8", "piece_one_by_one") for run in runs)
        return text[1:] if len(spoken) and self.spaced[spoken[0]] else text


def _coding_tasks(path: str, check: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for part in B.pieces(parts, limit=2 * B.PIECE):
            coder = coder or PieceCoder(path)
            ids, cuts = coder.encode(part.column(1))
            split = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            decoded = [coder.decode(x) for x in split]
            agrees = [None] * len(split)
            if check:
                theirs = coder.library.encode(pc.fill_null(part.column(1), "").to_pylist(), num_threads=1)
                texts = coder.library.decode(theirs, num_threads=1)
                agrees = [
                    a.tolist() == b and t == u for a, b, t, u in zip(split, theirs, decoded, texts, strict=True)
                ]
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())],
                ["doc_id", "ids", "decoded", "agrees"],
            )

    return run


def code_texts(docs: DataFrame, path: str, check: bool = False) -> DataFrame:
    """doc_id, ids and decoded text of every text; ``agrees`` with the library, null without check."""
    return documents(docs).mapInArrow(_coding_tasks(path, check), _CODED_TYPE)


def digest(coded: DataFrame) -> DataFrame:
    """Number of ids, and hashes of the ids (decimal, joined by commas) and of the decoded text."""
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )
