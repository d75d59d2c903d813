"""Spelling variants, whitening and piece encoding against brute force and the library."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from shared import TEXTS, by_key, documents

from tallyloom.llm import piece_agenda, registered, spelling_bitsets, weighted_whitening

SF = "/root/testdata/sf0.001"


# --- spelling variants ---------------------------------------------------------------------


def one_error(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, min_count=5, times=5, every=199):
    count = collections.Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= 6 and k >= min_count}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_error(v, w)] for w in n}
    first = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in first.items() if n[v] >= times * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def variants(df, **more):
    return by_key(spelling_bitsets.variant_groups(df, **more), *COLUMNS)


def words_text(counts):
    return " ".join(" ".join([w] * n) for w, n in counts.items())


CHAIN = {
    "keyboard": 700, "keyboord": 130, "keybord": 20, "keyboar": 6, "eyboard": 5, "keyboardé": 25,
    "KEYBOARD": 3, "xkeyboard": 9, "kezboard": 9, "planet": 5, "plamet": 5, "plané": 40, "planét": 25,
    "short": 90, "straße": 25, "strasse": 30, "stra÷e": 5, "aaaaaa": 30, "aaaaaaa": 150, "aaaaaaaa": 5,
}


@pytest.mark.parametrize("more", [{}, {"bucket": 4, "most": 20}])
def test_variants(spark, more):
    rows = [*TEXTS, (70, words_text(CHAIN)), (71, "planet-planet,Planet PLANET"), (72, "Ünïçödé " * 6)]
    got = variants(documents(spark, rows), **more)
    assert got == brute_variants(rows)
    assert ("keyboar", "keyboard", "keyboard") in {r[:3] for r in got}


@pytest.mark.parametrize("more", [{"every": 2}, {"every": 2, "bucket": 8, "most": 60}])
def test_random_words_of_few_letters(spark, more):
    rng = random.Random(5)
    letters = "abé"
    rows = [
        (k, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(5, 8))) for _ in range(120)))
        for k in range(60)
    ]
    rows.append((None, rows[0][1]))
    got = variants(documents(spark, rows), min_count=2, times=2, **more)
    assert got == brute_variants(rows, 2, 2, 2)
    assert sum(r[4] for r in got) > 1000


def test_many_words_with_one_start_and_end(spark):
    """A hot bucket: the words of one start are cut into parts, and pairs of parts still all meet."""
    names = ["com" + "".join(x) + "ing" for x in itertools.product("abcde", repeat=4)]
    rows = [(None, words_text({w: 2 + 20 * (k % 7 == 0) for k, w in enumerate(names)}))]
    got = variants(documents(spark, rows), min_count=2, most=800)
    assert got == brute_variants(rows, 2)
    assert all(r[4] == 16 for r in got)


def test_very_long_words_and_empty_tables(spark):
    long = "ab" * 3000
    rows = [(None, words_text({long: 30, long[:-1] + "c": 5, long + "d": 6, long[1:]: 5}))]
    assert variants(documents(spark, rows)) == brute_variants(rows)
    assert variants(documents(spark, [])) == []
    assert variants(documents(spark, [(1, None), (2, "")])) == []
    with pytest.raises(ValueError):
        spelling_bitsets.variant_groups(documents(spark, []), min_length=5)


def test_registered_variants(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = by_key(registered.op11_spelling_variants(spark, SF), *COLUMNS)
    assert got == brute_variants(rows)


# --- whitening -----------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, x string, n string, dim int, part int, whitened int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "n", 1, 2, 3) for i, v in rows], VECTORS)


def whitened(spark, rows, **more):
    out = weighted_whitening.by_component(weighted_whitening.whiten(vectors(spark, rows), **more))
    return out.collect()


def check_whitened(got, rows):
    """``rows`` are (vec_id, vector) that take part, all of one length."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    y = ((n * x - sums) / n).astype(float)
    values, columns = np.linalg.eigh(y.T @ y / n)
    values, columns = values[::-1], columns[:, ::-1]
    rank = min(32, int((values > 1e-9 * values.sum()).sum()))
    want = collections.Counter((i, int(d)) for (i, _), d in zip(rows, deviation, strict=True))
    for c in range(1, rank + 1):
        mine = [r for r in got if r["component"] == c]
        assert collections.Counter((r["vec_id"], r["deviation"]) for r in mine) == want
        assert {r["n"] for r in mine} == {n}
        assert mine[0]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        z = y @ columns[:, c - 1] / np.sqrt(values[c - 1])
        near = sorted(r["whitened"] for r in mine)
        assert np.allclose(near, sorted(z), atol=1e-8) or np.allclose(near, sorted(-z), atol=1e-8)
    assert {r["component"] for r in got} == set(range(1, rank + 1))
    assert max(r["identity_error"] for r in got) < 1e-9


def test_whitening_counts_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(k, list(map(float, v))) for k, v in enumerate(rng.normal(size=(300, 40)) * np.linspace(3, 0.1, 40))]
    rows += [(1000 + k, rows[0][1]) for k in range(400)] + [(7, rows[7][1]), (None, rows[3][1])]
    odd = [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 40), (2003, [float("inf")] * 40), (2004, [])]
    check_whitened(whitened(spark, rows + odd), rows)


def test_each_length_by_itself(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=3 if k % 2 else 5).tolist()) for k in range(80)]
    got = whitened(spark, rows)
    for odd in (0, 1):
        check_whitened([r for r in got if r["vec_id"] % 2 == odd], [r for r in rows if r[0] % 2 == odd])


def test_dependent_and_constant_dimensions(spark):
    rows = [(k, [float(k), 2.0 * k, 7.0, float(k * k % 13)]) for k in range(50)]
    got = whitened(spark, rows)
    assert {r["component"] for r in got} == {1, 2}
    check_whitened(got, rows)
    assert whitened(spark, [(1, [1.0, 2.0])] * 9) == []
    assert whitened(spark, []) == []


def test_large_entries(spark):
    rows = [(k, [1e30 if k % 2 else -1e30, float(k)]) for k in range(6)]
    got = whitened(spark, rows)
    assert {r["deviation"] for r in got} == {None}
    assert {r["component"] for r in got} == {1}  # the other one vanishes beside it
    assert sorted(round(r["whitened"], 6) for r in got) == [-1.0] * 3 + [1.0] * 3


def test_moments_merge_in_any_cut():
    rng = np.random.default_rng(4)
    x = rng.integers(-500, 500, size=(400, 6)) + 1_000_000
    w = rng.integers(1, 50, size=400)
    whole = weighted_whitening.block_moments(x, w)
    merged = None
    for k in range(0, 400, 37):
        merged = weighted_whitening.merge_moments(merged, weighted_whitening.block_moments(x[k : k + 37], w[k : k + 37]))
    assert merged[:2] == whole[:2] and np.allclose(merged[2], whole[2], rtol=1e-12)


def test_registered_whitening(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitened(registered.op12_whitening(spark, SF).collect(), rows)


# --- pieces --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    return piece_agenda.PieceCoder(registered.piece_model_path())


def mixed_texts(n):
    rng = random.Random(11)
    for alphabet in ("ab  eiost▁\n\té日本<0x>A😀͸\x00ﬁ.,'=-_/ ", "the ingatons", "    ▁a", "0123456789,."):
        for _ in range(n):
            yield "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))


def test_ids_are_those_of_the_library(coder):
    texts = [*mixed_texts(700), "x" * 40_000, " " * 500, "the" * 4000, None, "", "﻿a", "é", "<s></s>"]
    ids, cuts = coder.encode(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True):
        assert ids[a:b].tolist() == coder.library.encode(text or ""), text


def test_long_and_short_agendas_agree(coder):
    words = ["internationalization" * k for k in range(1, 9)] + ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    for word in words:
        symbols = coder.symbol_of[np.array([ord(c) for c in word])]
        long, at = coder._merge_long(symbols.tolist())
        short, at_short = coder._merge_short(symbols.copy(), np.zeros(len(word), np.int64))
        assert long == short.tolist() and at == at_short.tolist()


def test_decoding_any_ids(coder):
    rng = random.Random(7)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, 29871, rng.randint(3, 258), rng.randint(0, 31_999)]) for _ in range(rng.randint(0, 8))]
        assert coder.decode(ids) == coder.library.decode(ids), ids


def test_coded_texts(spark, coder):
    rows = [*TEXTS, *enumerate(mixed_texts(20), 500)]
    coded = piece_agenda.code_texts(documents(spark, rows), registered.piece_model_path(), check=True)
    got = sorted(((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in coded.collect()), key=repr)
    want = [(d, coder.library.encode(t or "")) for d, t in rows]
    assert got == sorted(((d, tuple(x), coder.library.decode(x)) for d, x in want), key=repr)
    assert coded.filter("NOT agrees OR agrees IS NULL").isEmpty()
    assert piece_agenda.code_texts(documents(spark, []), registered.piece_model_path()).collect() == []


def test_other_models_are_refused(monkeypatch):
    monkeypatch.setattr(piece_agenda, "_PROBES", ["a"])
    monkeypatch.setattr(piece_agenda.PieceCoder, "decode", lambda self, ids: "b")
    with pytest.raises(ValueError, match="merge-type"):
        piece_agenda.PieceCoder(registered.piece_model_path())


def test_registered_pieces(spark, coder):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for r in rows:
        ids = coder.library.encode(r["text"] or "")
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(coder.library.decode(ids)), True))
    got = registered.op13_pieces(spark, SF)
    assert by_key(got, *got.columns) == sorted(want, key=repr)
    assert got.filter(~F.col("agrees")).isEmpty()
