"""License statements by diagonal voting.

Templates are short texts with a label. All rolling word k-grams of the documents are joined,
by hash, with the positions that the templates' k-grams have. A match at word i of a document
and word j of a template votes for the diagonal i - j. Votes are counted per document, template
and diagonal before anything is shuffled. A template may be found

* exactly (the base phrases): all its k-grams on one diagonal, which is then the place where
  the phrase starts; or
* in part: diagonals at most ``drift`` apart are merged, so that an inserted or missing word
  doesn't break a match. The span is verified: only k-grams that follow one another in the
  document as in the template count, and words that set a template apart from its relatives
  (``needs``: the "nc" of a licence that has variants without it) must be among those matched.

The join is verified by a second, independent 64-bit hash of each k-gram.

Definitions and edge cases
  * Words are runs of digits, letters A-Z (lower-cased) and characters beyond ASCII.
  * Null and empty texts have no words. Each row is a document of its own, so repeated rows and
    rows without doc_id each have their result. An empty table gives an empty result; other
    columns don't matter.
  * Templates have at least k and at most 64 + k - 1 words.
  * The score is the largest share of a template's k-grams in a span that has what it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import batches as B
from tallyloom.llm.common import documents

_K = 2
#: Stands for the row that each document has besides its k-grams.
_DOCUMENT = -7046029254386353131
_GRAM_TYPE = "row_id long, at int, gram long, second long"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool = False
    needs: tuple[str, ...] = ()


# The base phrases and their labels.
BASE = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)

#: Statements that may be found in part.
STATEMENTS = (
    Template("apache", "licensed under the apache license version 2 0", needs=("apache",)),
    Template("bsd", "redistribution and use in source and binary forms with or without"
             " modification are permitted provided that the following conditions are met"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", needs=("nc",)),
    Template("cc-by-sa", "licensed under a creative commons attribution share alike license",
             needs=("share", "alike")),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3",
             needs=("general", "3")),
    Template("mit", "released under the mit license", needs=("mit",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"
             " of this software and associated documentation files"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license",
             needs=("mozilla",)),
)


def _grams(column: pa.Array, k: int):
    """Words, the k-grams' starts, and their two hashes."""
    words = B.split_words(column, B.ALNUM, B.LOWER)
    starts = B.window_starts(words.first, k)
    if not len(starts):
        none = np.empty(0, np.uint64)
        return words, starts, none, none
    one, two = (B.window_hashes(words.hashes(seed), k)[starts] for seed in (0, 1))
    return words, starts, one, two


def _gram_tasks(k: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for piece in B.pieces(parts):
            words, starts, one, two = _grams(piece.column(1), k)
            rows = row + np.arange(piece.num_rows)
            row += piece.num_rows
            own = [rows, words.counts.astype(np.int32), np.full(len(rows), _DOCUMENT)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x) for x in own), piece.column(0)], ["row_id", "at", "gram", "second"]
            )
            doc, at = words.documents()[starts], words.positions()[starts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[doc]), pa.array(at.astype(np.int32)), pa.array(B.signed(one)),
                 pa.array(B.signed(two))],
                ["row_id", "at", "gram", "second"],
            )

    return run


def _positions(spark: SparkSession, templates: tuple[Template, ...], k: int) -> DataFrame:
    """A row for each k-gram of each template, and one for the documents' own rows."""
    rows: list[tuple] = [(_DOCUMENT, None, -1, None, True, 0, 1)]
    for t, template in enumerate(templates):
        _, starts, one, two = _grams(pa.array([template.text]), k)
        for j, (a, b) in enumerate(zip(B.signed(one).tolist(), B.signed(two).tolist(), strict=True)):
            rows.append((a, b, t, template.label, template.exact, j, len(starts)))
    kinds = "gram long, check long, template int, label string, exact boolean, j int, grams int"
    return spark.createDataFrame(rows, kinds)


def votes(docs: DataFrame, templates: tuple[Template, ...], k: int = _K) -> DataFrame:
    """Votes per document, template and diagonal; ``seen`` has a bit per k-gram of the template.

    A document's own row has template -1, its id in ``doc_id`` and its words in ``diagonal``.
    """
    grams = documents(docs).mapInArrow(_gram_tasks(k), _GRAM_TYPE)
    places = F.broadcast(_positions(docs.sparkSession, templates, k))  # one row per k-gram
    same = (F.col("template") == -1) | (F.col("second") == F.col("check"))
    return (
        grams.join(places, "gram")
        .filter(same)
        .withColumn("diagonal", F.col("at") - F.col("j"))
        .groupBy("row_id", "template", "label", "exact", "grams", "diagonal")
        .agg(
            F.expr("bit_or(shiftleft(1L, j))").alias("seen"),
            F.max(F.when(F.col("template") == -1, F.col("second"))).alias("doc_id"),
        )
    )


#: The most k-grams of a span that can be taken with places and template positions both rising:
#: ``t`` holds the smallest last position of a run of each length.
_IN_ORDER = """
  size(aggregate(
    array_sort(flatten(transform(parts, x -> transform(
      filter(sequence(0, 63), j -> shiftright(x.seen, j) & 1L = 1L),
      j -> struct(x.diagonal + j AS at, -j AS back))))),
    cast(array() AS array<int>),
    (t, p) -> concat(filter(t, v -> v < -p.back), array(-p.back),
                     slice(t, size(filter(t, v -> v < -p.back)) + 2, 64))))"""


def spans(found: DataFrame, drift: int = 2) -> DataFrame:
    """Votes of neighbouring diagonals as one span; a document's own row stays as it is.

    Rows (row_id, template, label, exact, start, seen, coverage, doc_id); ``coverage`` is the share
    of the template's k-grams that the span has in the template's order.
    """
    order = Window.partitionBy("row_id", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > drift
    fresh = F.col("exact") | F.coalesce(apart, F.lit(False))  # exact ones stay on one diagonal
    matched = F.when(F.size("parts") > 1, F.expr(_IN_ORDER)).otherwise(F.bit_count("seen"))
    return (
        found.withColumn("part", F.sum(fresh.cast("int")).over(order))
        .groupBy("row_id", "template", "label", "exact", "grams", "part")
        .agg(
            F.collect_list(F.when(~F.col("exact"), F.struct("diagonal", "seen"))).alias("parts"),
            F.bit_or("seen").alias("seen"),
            F.min("diagonal").cast("long").alias("start"),
            F.max("doc_id").alias("doc_id"),
        )
        .withColumn("coverage", matched / F.col("grams"))
        .drop("part", "grams", "parts")
    )


def _has_needs(templates: tuple[Template, ...], k: int = _K):
    """Whether the span's k-grams hold every word that its template needs."""
    ok = F.lit(True)
    for t, template in enumerate(templates):
        words = template.text.split()
        for need in template.needs:
            grams = {j for w, x in enumerate(words) if x == need for j in range(max(w - k + 1, 0), w + 1)}
            mask = sum(1 << j for j in grams if j <= len(words) - k)
            ok = ok & ((F.col("template") != t) | (F.col("seen").bitwiseAND(F.lit(mask)) != 0))
    return ok


def scan(
    docs: DataFrame, base: tuple[Template, ...] = BASE,
    statements: tuple[Template, ...] = STATEMENTS, enough: float = 0.6,
) -> DataFrame:
    """Per document: its words, the base phrases' places, all labels, and the best coverage."""
    own = F.col("template") == -1
    hit = ~own & F.col("exact") & (F.col("coverage") == 1)
    named = hit | ~own & ~F.col("exact") & F.col("sound") & (F.col("coverage") >= enough)
    templates = base + statements
    return (
        spans(votes(docs, templates))
        .withColumn("sound", _has_needs(templates))
        .groupBy("row_id")
        .agg(
            F.max(F.when(own, F.col("doc_id"))).alias("doc_id"),
            F.max(F.when(own, F.col("start"))).alias("n_words"),
            F.count(F.when(hit, 1)).alias("n_base"),
            F.min(F.when(hit, F.col("start"))).alias("first_word"),
            F.max(F.when(hit, F.col("start"))).alias("last_word"),
            _labels(hit).alias("base_labels"),
            _labels(named).alias("labels"),
            F.coalesce(F.max(F.when(~own & F.col("sound"), F.col("coverage"))), F.lit(0.0)).alias("score"),
        )
        .drop("row_id")
    )


def _labels(condition):
    return F.array_join(F.sort_array(F.collect_set(F.when(condition, F.col("label")))), ",")
