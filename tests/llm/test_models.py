"""Trained operators: exact parts against brute force, the rest by held-out accuracy."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from shared import TEXTS, by_key, documents

from tallyloom.llm import language_crf, neighbour_voting, registered, toxicity_ssk
from tallyloom.llm.common import labelled_sample

SF = "/root/testdata/sf0.1"


def fold(doc, n):
    return zlib.crc32(str(doc).encode()) % n


@pytest.fixture(scope="module")
def corpus():
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    labels = {r["doc_id"]: r for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    return docs, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, score int")


# --- subsequence kernel --------------------------------------------------------------------


def brute_kernel(s, t, decay, p=4):
    total = 0.0
    for a in itertools.combinations(range(len(s)), p):
        for b in itertools.combinations(range(len(t)), p):
            if [s[i] for i in a] == [t[j] for j in b]:
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


@pytest.mark.parametrize("word", [b"idiot", b"idxiot", b"toidi", b"iiddiioott", b"abc", b"diotid"])
def test_subsequence_kernel(word):
    chars = np.zeros((1, 32), np.uint8)
    chars[0, : len(word)] = list(word)
    got = toxicity_ssk.subsequence_kernel(chars, b"idiot", 0.8)[0]
    assert got == pytest.approx(brute_kernel(word, b"idiot", 0.8))


def test_common_length():
    chars = np.zeros((3, 32), np.uint8)
    for row, word in zip(chars, (b"xaybzc", b"cba", b""), strict=True):
        row[: len(word)] = list(word)
    assert toxicity_ssk.common_length(chars, b"abcd").tolist() == [3, 1, 0]


def test_words_of_sentences():
    s = toxicity_ssk.sentences(pa.array(["You i.d.i.o.t! a b c d e\nend", None, "", "x" * 70]))
    forms = [row.tobytes().rstrip(b"\0") for row in s.chars]
    found = sorted((int(d), forms[w]) for d, w in zip(s.doc, s.word, strict=True))
    mine = [b"you", b"idiot", b"end", b"abcde", *b"a b c d e".split()]
    assert [w for d, w in found if d == 0] == sorted(mine)
    assert [w for d, w in found if d == 3] == [b"x" * 22, b"x" * 32, b"x" * 32, b"x" * 32]


def test_gapped_insults_are_found(corpus):
    docs, labels = corpus
    train = [d for d in docs if d["doc_id"] in labels and fold(d["doc_id"], 3) != 1][:1500]
    y = np.array([labels[d["doc_id"]]["toxic"] for d in train])
    model = toxicity_ssk.fit([d["text"] for d in train], y)
    texts = ["such a loser he is", "such a los*er he is", "such a looser he is", "such a l.o.s.e.r he is",
             "such a rose he is", "", None]
    score = model.scores(pa.array(texts))
    assert (score[:4] > 0.7).all() and (score[4:] < 0.2).all()


def test_insertions_between_every_two_letters():
    def values(*words):
        s = toxicity_ssk.sentences(pa.array(words))
        first = np.flatnonzero(np.append(True, np.diff(s.doc)))
        return toxicity_ssk.kernel_values(s.chars, ["idiot", "worthless", "chón"], 0.8)[s.word[first]]

    hit = values("ixdxixoxt", "idxixot", "wxoxrxtxhxlxexsxs", "cxhxóxn", "éidéiéoét")
    assert (hit >= 0.6).tolist() == [[True, False, False]] * 2 + [[False, True, False], [False, False, True],
                                     [True, False, False]]
    assert not values("ixxxdxxxixxxoxxxt", "rose", "idxixo").any()


@pytest.mark.parametrize("mark", ["\u200b", "\u00b7", "\u00ad", "\u2060", "\ufeff", "\u2014", "\u0336", "\U0001f4a9"])
def test_marks_beyond_ascii_are_dropped_from_words(mark):
    texts = ["such an " + mark.join("idiot") + " he is", f"id{mark}iot", None, mark, "é\u00a0" + mark]
    s = toxicity_ssk.sentences(pa.array(texts))
    forms = ["".join(map(chr, row[row > 0])) for row in s.chars]
    found = sorted((int(d), forms[w]) for d, w in zip(s.doc, s.word, strict=True))
    assert found == sorted([*((0, w) for w in "such an idiot he is".split()), (1, "idiot"), (4, "é")])
    assert s.counts.tolist() == [5, 1, 0, 0, 1]


def test_stretched_insults_are_toxic(corpus):
    docs, labels = corpus
    train = [d for d in docs if d["doc_id"] in labels and fold(d["doc_id"], 3) != 1][:1500]
    model = toxicity_ssk.fit([d["text"] for d in train], np.array([labels[d["doc_id"]]["toxic"] for d in train]))
    texts = [f"such a {c.join('loser')} he is" for c in ("\u200b", "\u00b7", "x")] + ["such a los\u200ber he is"]
    assert (model.scores(pa.array(texts)) > 0.7).all()


def test_toxicity_on_held_out_rows(spark, corpus):
    _, labels = corpus
    rows = registered.op2_toxicity(spark, SF).collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]["toxic"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    hit = sum(p and y for p, y in held)
    assert hit / sum(p for p, _ in held) > 0.9
    assert hit / sum(y for _, y in held) > 0.6


def test_toxicity_edges(spark):
    docs = documents(spark, [*TEXTS, (20, "you absolute zilchbag"), (21, "my zilchbag friend")])
    known = [(20, 1, 1, "t", 0), (21, 1, 1, "t", 0), (6, 1, 0, "t", 0), (10, 1, 0, "t", 0), (5, 1, 0, "t", 0),
             (None, 1, 1, "t", 0), (9, 1, None, "t", 0), (6, 1, 0, "t", 0)]
    model = toxicity_ssk.fit_toxicity(docs, labels_of(spark, known), folds=1, held=1)
    scored = by_key(toxicity_ssk.score_toxicity(docs, model), "doc_id", "score")
    assert len(scored) == len(TEXTS) + 2
    by = dict(scored)
    assert min(by[20], by[21]) > max(by[1], by[2], by[5], by[6])
    kept = toxicity_ssk.keep_clean(docs, model, (by[20] + by[6]) / 2)
    assert kept.columns == docs.columns
    assert by_key(kept, "doc_id", "text") == sorted(TEXTS, key=repr)


@pytest.mark.parametrize("known", [[], [(6, 1, 0, "t", 0)]])
def test_toxicity_without_both_classes(spark, known):
    docs = documents(spark)
    model = toxicity_ssk.fit_toxicity(docs, labels_of(spark, known), folds=1, held=1)
    assert {round(r["score"], 3) for r in toxicity_ssk.score_toxicity(docs, model).collect()} == {0.0}
    assert toxicity_ssk.score_toxicity(documents(spark, []), model).collect() == []


def test_labels_of_long_documents_stay_in_the_sample(spark):
    long = " ".join(f"é{k}日" for k in range(5000))
    docs = documents(spark, [(1, "short"), (2, long), (3, long), (4, None), (2, long)])
    known = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c"), (5, "d")], "doc_id long, label string")
    rows = labelled_sample(docs, known, 1, 1, 10, 1000).to_pylist()
    texts = [(r["label"], r["text"]) for r in rows if r["label"] != "b"]
    assert texts == [("a", "short"), ("c", None)]
    parts = [r["text"] for r in rows if r["label"] == "b"]
    assert len(set(parts)) == 2  # not at the same place
    assert all(p in long and 990 <= len(p.encode()) <= 1000 for p in parts)
    assert rows == labelled_sample(docs, known, 1, 1, 10, 1000).to_pylist()


def test_models_know_labels_of_long_documents_alone(spark):
    base = [(k, "der hund und die katze " * 3) for k in range(4)] + [(k, "le chien et le chat " * 900) for k in range(4, 8)]
    docs = documents(spark, base).drop("score")
    lang = docs.withColumn("lang", F.when(F.col("doc_id") < 4, "de").otherwise("fr"))
    model = language_crf.fit_languages(lang, folds=1, held=1)
    assert model.languages == ["de", "fr"]
    far = documents(spark, [(k, t * 3) for k, t in base])
    known = labels_of(spark, [(k, int(k < 4), int(k < 4), "t", 0) for k, _ in base])
    assert sorted(neighbour_voting.fit_quality(far, known, folds=1, held=1).labels) == [0] * 4 + [1] * 4


# --- quality ---------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark, corpus):
    _, labels = corpus
    rows = registered.op8_quality(spark, SF).collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]["quality"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    assert np.mean([p == y for p, y in held]) > 0.97


def test_neighbours_vote_by_similarity():
    texts = ["ALL CAPS!! HERE!!", "MORE CAPS!! NOW!!", "a plain text here", "another plain text", "PLAIN caps"]
    y = np.array([0, 0, 1, 1, 1])
    model = neighbour_voting.fit(texts, y, k=3)
    probe = pa.array(["SOME CAPS!! AGAIN!!", "a plain one", "", None, "CAPS plain"])
    x = model.latent(neighbour_voting.term_counts(probe))
    expected = []
    for row in x:
        if not row.any():
            expected.append(y.mean())
            continue
        cosine = model.vectors @ row
        near = np.argsort(-cosine, kind="stable")[:3]
        weight = np.maximum(cosine[near], 1e-6)
        expected.append((weight * y[near]).sum() / weight.sum())
    assert model.scores(probe) == pytest.approx(expected, abs=1e-5)
    assert model.scores(probe, block=1) == pytest.approx(expected, abs=1e-5)


def test_quality_of_plain_words():
    kinds = ["cheap pills casino bonus winner click offer deal".split(), "river museum garden engine painter village".split()]
    common = "the a of in and to with for on by".split()
    rng = np.random.default_rng(3)
    y = np.arange(300) % 2
    texts = [" ".join(rng.choice(kinds[k] if rng.random() < 0.4 else common) for _ in range(40)) for k in y]
    model = neighbour_voting.fit(texts[:200], y[:200])
    assert np.mean((model.scores(pa.array(texts[200:])) > 0.5) == y[200:]) > 0.95


def test_quality_edges(spark):
    docs = documents(spark)
    known = [(6, 1, 0, "t", 0), (6, 0, 0, "t", 0), (10, 0, 0, "t", 0), (None, 1, 0, "t", 0), (9, None, 0, "t", 0)]
    model = neighbour_voting.fit_quality(docs, labels_of(spark, known), folds=1, held=1)
    assert sorted(model.labels.tolist()) == [0, 1]
    rows = neighbour_voting.score_quality(docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0.5}
    none = neighbour_voting.fit_quality(docs, labels_of(spark, []), folds=1, held=1)
    assert {r["score"] for r in neighbour_voting.score_quality(docs, none).collect()} == {0.0}
    assert neighbour_voting.score_quality(documents(spark, []), model).collect() == []


# --- language ----------------------------------------------------------------------------------


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(1)
    emission, transition = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    first, size = np.array([0, 4, 5]), np.array([4, 1, 4])
    gamma, pairs, total = language_crf.forward_backward(emission, transition, first, size)
    expected, moves, logs = np.zeros((9, 3)), np.zeros((3, 3)), 0.0
    for a, n in zip(first, size, strict=True):
        paths = list(itertools.product(range(3), repeat=int(n)))
        score = np.array([
            sum(emission[a + t, y] for t, y in enumerate(p))
            + sum(transition[u, v] for u, v in itertools.pairwise(p)) for p in paths
        ])
        logs += np.log(np.exp(score).sum())
        for p, w in zip(paths, np.exp(score) / np.exp(score).sum(), strict=True):
            for t, y in enumerate(p):
                expected[a + t, y] += w
            for u, v in itertools.pairwise(p):
                moves[u, v] += w
    assert gamma == pytest.approx(expected)
    assert pairs == pytest.approx(moves)
    assert total == pytest.approx(logs)


def test_chains_end_with_lines_and_documents():
    c = language_crf.chains(pa.array(["a b\nc", None, "", "d", " ".join(["w"] * 300)]))
    assert c.size.tolist() == [2, 1, 1, 256, 44]
    assert c.doc[c.first].tolist() == [0, 0, 3, 4, 4]


def test_language_on_held_out_rows(spark, corpus):
    docs, _ = corpus
    lang = {d["doc_id"]: d["lang"] for d in docs}
    rows = registered.op1_language_id(spark, SF).collect()
    assert len(rows) == 10_000
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.95


def test_language_edges(spark, corpus):
    docs, _ = corpus
    train = [d for d in docs if fold(d["doc_id"], 3) != 1][:400]
    model = language_crf.fit([d["text"] for d in train], [d["lang"] for d in train])
    by = {(r["doc_id"], r["lang_pred"] == "und") for r in language_crf.label_languages(documents(spark), model).collect()}
    assert {(1, True), (2, True), (3, True), (4, False), (5, False), (11, False)} <= by
    digits = documents(spark, [(1, "123 45!\n"), (2, "7 x"), (3, "½ ² 12 ①"), (4, "½ ⅷ ab")])
    assert by_key(language_crf.label_languages(digits, model).withColumn("u", F.expr("lang_pred = 'und'")), "doc_id", "u") == [(1, True), (2, False), (3, True), (4, False)]
    assert language_crf.label_languages(documents(spark, []), model).collect() == []
    none = language_crf.fit([], [])
    assert {r["lang_pred"] for r in language_crf.label_languages(documents(spark), none).collect()} == {"und"}


def test_code_switched_words_get_their_own_language(corpus):
    docs, _ = corpus
    train = [d for d in docs if fold(d["doc_id"], 3) != 1][:1200]
    model = language_crf.fit([d["text"] for d in train], [d["lang"] for d in train])
    held = [d for d in docs if fold(d["doc_id"], 3) == 1 and len(d["text"]) > 1000]
    de = next(d["text"] for d in held if d["lang"] == "de").split()[:30]
    fr = next(d["text"] for d in held if d["lang"] == "fr").split()[:30]
    c = language_crf.chains(pa.array([" ".join(de + fr)]))
    best = [model.languages[k] for k in model.marginals(c).argmax(axis=1)]
    assert best[:30].count("de") > 25 and best[30:].count("fr") > 25
