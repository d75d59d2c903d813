"""Grouping spelling variants by a bit-sliced position index over the vocabulary.

*Vocabulary.* Spark cuts the texts into runs of letters and counts the words; that is one shuffle
of partial counts.

*Index.* For each position and letter, one bitset over the words says which of them have that
letter there. For a word, four bitsets follow its letters through the positions, all of the index
at once: the words equal so far (zero errors), and those equal but for one replaced letter, for
one letter more (their positions shifted up by one) or one letter less (shifted down). What is set
at the end, and of the right length, is near. Words are in order of falling count, so the
first bit is the word's form and the number of bits its number of near words; pairs of words are
bits and never rows.

*Spreading.* Of two near words of at least six letters, either the first three letters are equal,
or else the last three are. So a word goes to a bucket by its first three and to one by its last
three letters, and near words meet: where the first three are equal in the former, else in the
latter. A bucket has about ``bucket`` words; one with more than ``most`` letters (many words with
the same three) is cut into parts of that size, and each pair of parts is a task of its own.

*Roots.* Links from words to forms are followed by doubling; counts rise at least ``times``-fold at
each link, so few rounds are needed.

Definitions and edge cases
  * A null text has no words, and an empty table no rows. Very long texts are read whole. Repeated
    rows count again. Other columns don't matter.
  * In a row without doc_id no letter is taken away, as its hash isn't defined.
  * Of near words with equal counts the smallest in code-point order is the form.
  * Each word of the vocabulary has a row, alone or not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, stage

#: A run of letters, and the letters with a lower case.
RUN = "([A-Za-zÀ-ÿ]+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOUND_TYPE = "word string, n_near long, form string, form_n long"
#: Letters that decide where words meet; least length of words for that.
_AFFIX = 3
#: 64-bit numbers of a bitset matrix that is worked on at a time.
_WORK = 1 << 16


def vocabulary(docs: DataFrame, min_length: int, min_count: int, every: int) -> DataFrame:
    """word and its number of occurrences n.

    Of a run whose crc32 with its doc_id is a multiple of ``every``, one letter is taken away.
    """
    runs = documents(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(1))).alias("run"))
    plain = F.when(F.col("run") == F.lower("run"), F.col("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    runs = runs.select("doc_id", plain.alias("run"))
    hashed = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % every == 0, less).otherwise(F.col("run"))
    words = runs.withColumn("h", hashed).select(word.alias("word")).filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _position_sets(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitsets of the letters at one position (the last one empty), and each letter's row."""
    present = np.unique(letters[letters > 0])
    row = np.full(256, len(present), dtype=np.intp)
    row[present] = np.arange(len(present))
    words = -(-len(letters) // 64)
    sets = np.zeros((len(present) + 1, words * 8), dtype=np.uint8)
    packed = np.packbits(letters[None, :] == present[:, None], axis=1, bitorder="little")
    sets[:-1, : packed.shape[1]] = packed
    return sets.view(np.uint64), row


def _bits(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(-(-len(flags) // 64) * 8, dtype=np.uint8)
    packed = np.packbits(flags, bitorder="little")
    out[: len(packed)] = packed
    return out.view(np.uint64)


def near_sets(queries: np.ndarray, index: list, sizes: tuple, same_start: bool | None) -> np.ndarray:
    """Bitsets of the index words at one error from each query; all queries have one length.

    ``index`` has the bitsets of each position up to that length, ``sizes`` those of the words
    with one letter less, as many, and one more. ``same_start`` says whether the first three letters
    must be equal or must not be.
    """
    n, length = queries.shape
    words = index[0][0].shape[1]
    equal = np.full((n, words), ~np.uint64(0))
    replaced, longer, shorter = (np.zeros((n, words), np.uint64) for _ in range(3))
    start = equal
    for p in range(length):
        letter = queries[:, p]
        here, row = index[p]
        match = here[row[letter]]
        behind, row = index[p + 1]
        longer = (longer | equal) & behind[row[letter]]
        if p:
            before, row = index[p - 1]
            shorter &= before[row[letter]]
        shorter |= equal
        replaced &= match
        replaced |= equal & ~match
        equal = equal & match
        if p == _AFFIX - 1:
            start = equal
    near = (shorter & sizes[0]) | (replaced & sizes[1]) | ((longer | equal) & sizes[2])
    if same_start is not None:
        near &= start if same_start else ~start
    return near


def _first_bits(near: np.ndarray) -> np.ndarray:
    """Place of the first bit of each row that has one."""
    at = (near != 0).argmax(axis=1)
    word = near[np.arange(len(near)), at]
    low = word & (~word + np.uint64(1))
    return at * 64 + np.bitwise_count(low - np.uint64(1)).astype(np.int64)


def near_words(words: list[str], n: np.ndarray, index: np.ndarray, query: np.ndarray, same_start: bool | None):
    """Rows of the queries that have near words, their numbers, and the row of the first by count."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    text = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    at = np.cumsum(size) - size
    order = np.array(sorted(np.flatnonzero(index).tolist(), key=lambda k: (-n[k], words[k])), dtype=np.int64)
    out = []
    for length in np.unique(size[query]).tolist():
        mine = order[np.abs(size[order] - length) <= 1]
        if not len(mine):
            continue
        positions = [
            _position_sets(np.where(p < size[mine], text[np.minimum(at[mine] + p, len(text) - 1)], 0))
            for p in range(length + 1)
        ]
        sizes = tuple(_bits(size[mine] == length + d) for d in (-1, 0, 1))
        asked = np.flatnonzero(query & (size == length))
        step = max(1, _WORK // len(sizes[0]))
        for k in range(0, len(asked), step):
            some = asked[k : k + step]
            letters = text[at[some][:, None] + np.arange(length)]
            near = near_sets(letters, positions, sizes, same_start)
            count = np.bitwise_count(near).sum(axis=1, dtype=np.int64)
            hit = np.flatnonzero(count)
            if len(hit):
                out.append((some[hit], count[hit], mine[_first_bits(near[hit])]))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _meet(table: pa.Table) -> pa.Table:
    """Near words of one part of a bucket for the queries of another."""
    words = table["word"].to_pylist()
    n = table["n"].to_numpy()
    index, query = (table[c].to_numpy().astype(bool) for c in ("is_index", "is_query"))
    row, count, form = near_words(words, n, index, query, table["side"][0].as_py() == 0)
    column = table["word"].combine_chunks()
    return pa.table(
        {
            "word": column.take(pa.array(row)), "n_near": pa.array(count, pa.int64()),
            "form": column.take(pa.array(form)), "form_n": pa.array(n[form], pa.int64()),
        }
    )


def _cells(parts: str, own: str):
    """(index part, query part, index?, query?) of a word: a row of cells and a column of them."""
    return F.expr(f"""
        concat(
            transform(sequence(0, {parts} - 1), k -> struct({own} AS i, k AS j, true AS is_index, k = {own} AS is_query)),
            filter(transform(sequence(0, {parts} - 1),
                k -> struct(k AS i, {own} AS j, false AS is_index, true AS is_query)), c -> c.i <> {own}))""")


def near_counts(words: DataFrame, bucket: int = 4096, most: int = 1_000_000) -> DataFrame:
    """word, its number of near words, and the largest of them with its count, where there are any."""
    buckets = max(1, 2 * words.count() // bucket)
    ends = F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", 1, _AFFIX).alias("affix")),
        F.struct(F.lit(1).alias("side"), F.substring("word", -_AFFIX, _AFFIX).alias("affix")),
    )
    sided = words.select("word", "n", F.inline(ends)).select(
        "word", "n", "side", F.pmod(F.xxhash64("side", "affix"), F.lit(buckets)).alias("bucket")
    )
    letters = sided.groupBy("side", "bucket").agg(F.sum(F.length("word")).alias("letters"))
    parts = letters.select("side", "bucket", F.ceil(F.col("letters") / most).cast("int").alias("parts"))
    dealt = sided.join(parts, ["side", "bucket"]).withColumn("own", F.pmod(F.hash("word"), F.col("parts")))
    cells = dealt.select("word", "n", "side", "bucket", F.inline(_cells("parts", "own")))
    found = cells.groupBy("side", "bucket", "i", "j").applyInArrow(_meet, _FOUND_TYPE)
    best = F.min(F.struct((-F.col("form_n")).alias("order"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """word and root for each word that has a form; ``links`` has word and root, at first its form."""
    links = stage(links, "links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = links.join(ahead, "root", "left")
        moved = moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        moved = stage(moved, "links")
        if moved.filter("_moved").isEmpty():
            return moved.select("word", "root")
        links = moved.select("word", "root")


def variant_groups(
    docs: DataFrame, min_length: int = 6, min_count: int = 5, times: int = 5, every: int = 199,
    bucket: int = 4096, most: int = 1_000_000,
) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of the vocabulary."""
    if min_length < 2 * _AFFIX:
        raise ValueError(f"words of fewer than {2 * _AFFIX} letters may not meet")
    words = stage(vocabulary(docs, min_length, min_count, every), "words")
    found = near_counts(words, bucket, most)
    larger = -F.col("best.order") >= times * F.col("n")
    forms = words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(larger, F.col("best.form")).alias("form"),
        F.when(larger, -F.col("best.order")).alias("form_n"),
    )
    forms = stage(forms, "forms")
    roots = _roots(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
