"""The registered queries of this package, and their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    bit_sliced,
    block_anchors,
    diagonal_voting,
    language_crf,
    line_runs,
    neighbour_voting,
    piece_agenda,
    signature_tree,
    spelling_bitsets,
    string_tiling,
    sum_of_squares,
    toxicity_ssk,
    weighted_whitening,
)
from tallyloom.llm.common import read, remainder

Query = Callable[[SparkSession, str], DataFrame]

#: A document with a toxicity score of at least this is toxic.
TOXIC = 0.7


def tokenizer_path() -> str:
    """The vocabulary file, a parameter of the packing operator."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; learned outside the fold of crc32 remainder 1 of 3."""
    docs = read(spark, sf_dir, "documents")
    model = language_crf.fit_languages(docs, folds=3, held=1)
    return language_crf.label_languages(docs, model).select(
        "doc_id",
        F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text; learned outside the fold of crc32 remainder 1 of 3."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity_ssk.fit_toxicity(docs, labels, folds=3, held=1)
    return toxicity_ssk.score_toxicity(docs, model).select(
        "doc_id",
        F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4,096 tokens."""
    return sum_of_squares.pack(read(spark, sf_dir, "documents"), tokenizer_path(), 4096)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold a test item, by the share of it that tiles cover."""
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return string_tiling.contamination(docs, benchmark)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in windows of 50 that a document with a smaller id has too are removed."""
    out = block_anchors.remove_repeats(read(spark, sf_dir, "documents"), span=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    vectors = read(spark, sf_dir, "embeddings")
    return bit_sliced.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and statements in every text."""
    return diagonal_voting.scan(read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text; learned outside the fold of crc32 remainder 0 of 5."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = neighbour_voting.fit_quality(docs, labels, folds=5, held=0)
    return neighbour_voting.score_quality(docs, model).select(
        "doc_id",
        F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents lose all their copies."""
    out = line_runs.drop_common_lines(read(spark, sf_dir, "documents"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by 5-word shingles at a Jaccard similarity of 0.8, and their classes."""
    return signature_tree.near_duplicates(read(spark, sf_dir, "documents"), k=5, threshold=80)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words at one error from a word five times as frequent, and the words they come from."""
    return spelling_bitsets.variant_groups(read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the first 32 principal components, with unit variance."""
    return weighted_whitening.by_component(weighted_whitening.whiten(read(spark, sf_dir, "embeddings")))


def piece_model_path() -> str:
    """The merge-type model file, a parameter of the encoding operator."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every text, compared with the library's."""
    docs = read(spark, sf_dir, "documents")
    return piece_agenda.digest(piece_agenda.code_texts(docs, piece_model_path(), check=True))


def queries() -> dict[str, Query]:
    return {
        "op1_language_id": op1_language_id,
        "op2_toxicity": op2_toxicity,
        "op3_packing": op3_packing,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_topk_search": op6_topk_search,
        "op7_license_scan": op7_license_scan,
        "op8_quality": op8_quality,
        "op9_line_dedup": op9_line_dedup,
        "op10_ngram_join": op10_ngram_join,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_whitening": op12_whitening,
        "op13_pieces": op13_pieces,
    }


#: Space, tab, line feed, vertical tab, form feed, carriage return.
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

_OP9 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, {_SPACE}), {_UPPER}, {_LOWER}) AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (key IN (SELECT key FROM common)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
              FILTER (key NOT IN (SELECT key FROM common)), '')) AS kept_sha256
FROM keyed GROUP BY doc_id"""


_WORDS = r"'[^\x20\x09-\x0D]+'"

_OP4 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
firsts AS (SELECT h, min(doc_id) AS owner FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k
  FROM windows JOIN firsts USING (h) WHERE doc_id > owner),
kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p.k) AS t
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM words) p
  LEFT JOIN gone USING (doc_id, k) WHERE gone.k IS NULL GROUP BY p.doc_id)
SELECT words.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

_OP6 = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(embedding) = len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)])),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5"""

_OP10 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), {_WORDS}) AS w
  FROM documents),
grams AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION SELECT links.y, reach.root FROM reach JOIN links ON links.x = reach.doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)"""


def _crc_table() -> list[int]:
    """The table of crc32, from its rule."""
    out = []
    for k in range(256):
        for _ in range(8):
            k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
        out.append(k)
    return out


_OP11 = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, {_UPPER}, {_LOWER}) AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  GROUP BY ALL),
spelled AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, k, xor(list_reduce(
           [4294967295::BIGINT] || [('0x' || x[2 * i + 1:2 * i + 2])::BIGINT FOR i IN range(0, len(x) // 2)],
           lambda c, b: xor(c >> 8, ({_crc_table()}::BIGINT[])[1 + (xor(c, b) & 255)])), 4294967295) AS h
  FROM spelled),
cut AS (
  SELECT k, CASE WHEN h % 199 = 0
                 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2)
                 ELSE run END AS word
  FROM hashed),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
less AS (
  SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word)))::INT AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n
  FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT less.word, words.word, words.n FROM less JOIN words ON rest = words.word
  UNION SELECT words.word, less.word, less.n FROM less JOIN words ON rest = words.word),
best AS (
  SELECT word, count(*) AS n_near, min({{'order': -other_n, 'form': other}}) AS b FROM near GROUP BY word),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -b['order'] >= 5 * n THEN b.form END AS form, CASE WHEN -b['order'] >= 5 * n THEN -b['order'] END AS form_n
  FROM words LEFT JOIN best USING (word)),
follow AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT follow.word, forms.form FROM follow JOIN forms ON forms.word = follow.root WHERE forms.form IS NOT NULL),
roots AS (SELECT follow.word, root FROM follow JOIN forms ON forms.word = root WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_substring_dedup": _OP4,
        "op6_topk_search": _OP6,
        "op9_line_dedup": _OP9,
        "op10_ngram_join": _OP10,
        "op11_spelling_variants": _OP11,
    }
