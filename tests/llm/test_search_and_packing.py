"""Packing, decontamination, top-k search and license scans against brute force."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from shared import TEXTS, by_key, documents, lower
from tokenizers import Tokenizer

from tallyloom.llm import bit_sliced, diagonal_voting, registered, string_tiling, sum_of_squares

SF = "/root/testdata/sf0.001"


# --- packing -------------------------------------------------------------------------------

QUOTES = ["don't can'T we'll 'tis x.'s they've I'M it'd rock'n'roll 'S ''s 12'd 'rear 'r 'l' 've", "'", "x'",
          "a<|endoftext|>b", "İstanbul ŉ ǅ", "été\té\x0bx", "日本語 text's", "é 1.5kg $3,000", "²³ ½"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(registered.tokenizer_path())


def brute_pieces(plain, texts, length):
    out = []
    for d, t in texts:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), length):
            piece = np.array(ids[k : k + length], dtype="<u4")
            out.append((d, k // length, k, len(piece), zlib.crc32(piece.tobytes())))
    return sorted(out, key=repr)


def test_word_tokenizer_is_exact(plain):
    rng = random.Random(3)
    texts = QUOTES + ["".join(rng.choice("abst'rvmdlE .1éÉ\n-<|") for _ in range(rng.randint(0, 40))) for _ in range(800)]
    ids, cuts = sum_of_squares.WordTokenizer(registered.tokenizer_path()).encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[cuts[k] : cuts[k + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("length", [64, 4096])
def test_packing(spark, plain, length):
    texts = [*TEXTS, *enumerate(QUOTES, 100), *((200 + k, "word " * (k % 70)) for k in range(300))]
    rows = sum_of_squares.pack(documents(spark, texts), registered.tokenizer_path(), length, group_size=120).collect()
    got = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=repr)
    assert got == brute_pieces(plain, texts, length)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    # each group may leave one sequence open
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // length) + 1 + len(rows) // 120


def brute_place(lengths, capacity):
    """The rule by trying every gap."""
    gaps, out = [], []
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size, best = lengths[k], None
        for g in sorted({g for g in gaps if g >= size}):
            after = [x for x in gaps if x != 0]
            after.remove(g)
            after += [g - size] if g > size else []
            squares = sum(after.count(x) ** 2 for x in set(after))
            if best is None or squares < best[0]:
                best = (squares, g)
        if best:
            gaps[gaps.index(best[1])] -= size
        else:
            gaps.append(capacity - size)
        out.append(sorted(gaps))
    return len(gaps)


def test_sum_of_squares_rule():
    rng = random.Random(5)
    for _ in range(30):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 40))]
        sequence, offset = sum_of_squares.place(np.array(lengths), 20)
        assert sequence.max() + 1 == brute_place(lengths, 20)
        for s in set(sequence.tolist()):
            parts = sorted((offset[k], lengths[k]) for k in np.flatnonzero(sequence == s))
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]


def test_packing_nothing(spark):
    assert sum_of_squares.pack(documents(spark, []), registered.tokenizer_path()).collect() == []


# --- decontamination -----------------------------------------------------------------------


def brute_tiles(doc, item, least):
    """Greedy string tiling on lists of words."""
    used_d, used_i, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while (i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]
                       and i + n not in used_d and j + n not in used_i):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return sorted(tiles)
        n, i, j = best
        tiles.append((i, j, n))
        used_d.update(range(i, i + n))
        used_i.update(range(j, j + n))


def test_greedy_tiles():
    rng = random.Random(2)
    for _ in range(60):
        doc = [rng.choice("abc") for _ in range(rng.randint(0, 30))]
        item = [rng.choice("abc") for _ in range(rng.randint(0, 18))]
        seeds = [(i, j) for i in range(len(doc) - 2) for j in range(len(item) - 2) if doc[i : i + 3] == item[j : j + 3]]
        assert sorted(string_tiling.greedy_tiles(seeds, 3)) == brute_tiles(doc, item, 3)


ITEM = "Alpha beta gamma delta. Epsilon zeta eta theta, iota kappa lambda mu! Nu xi omicron pi rho sigma tau."


def test_reordered_passages_are_found(spark):
    w = ITEM.split()
    texts = [*TEXTS, (30, "see: " + ITEM.upper() + " end"), (31, " ".join(w[12:] + ["and", "then"] + w[:12])),
             (32, " ".join(w[:6])), (33, " ".join(x for k, x in enumerate(w) if k % 3)), (31, "nothing")]
    items = spark.createDataFrame(
        [(1, ITEM, "x"), (2, None, "x"), (3, "", "x"), (4, "one two", "x"), (None, ITEM, "x"), (1, ITEM, "x")],
        "item_id long, text string, doc_id string",
    )
    for most in (2_000_000, 0):  # with the hashes at hand, and by a join of all runs
        tiled = string_tiling.tilings(documents(spark, texts), items, most_seeds=most)
        assert by_key(tiled, "doc_id", "item_id", "covered", "n_words") == [(30, 1, 19, 19), (31, 1, 19, 19), (32, 1, 6, 19)]
    kept = string_tiling.without_leaks(documents(spark, [*texts, (None, ITEM)]).withColumn("row", F.lit(1)), items)
    left = [t for t in texts if t[0] not in (30, 31)]
    assert by_key(kept, "doc_id", "text") == sorted(left, key=repr)
    texts.append((None, "so " + ITEM))  # without an id, and found all the same
    out = string_tiling.contamination(documents(spark, texts), items)
    assert out.count() == len(texts)
    bad = by_key(out.filter("contaminated").distinct(), "doc_id", "n_items", "item_id", "coverage")
    assert bad == sorted([(30, 1, 1, 1.0), (31, 1, 1, 1.0), (None, 1, 1, 1.0)], key=repr)
    assert string_tiling.contamination(documents(spark, []), items).collect() == []
    assert not string_tiling.leaks(documents(spark, texts), items.limit(0)).collect()


def common_runs(n, seed):
    """Documents and items that all share a phrase; every 40th document holds its item in two moved halves."""
    rng = random.Random(seed)
    start = "which of the following statements about"
    items, texts = [], []
    for k in range(n):
        own = [f"w{rng.randrange(40 * n)}" for _ in range(rng.randrange(3, 20))]
        items.append((k, f"{start} {' '.join(own)}"))
        body = " ".join(f"d{rng.randrange(40 * n)}" for _ in range(12))
        half = len(own) // 2
        leak = " ".join([*own[half:], "and", *own[:half]]) if k % 40 == 0 else ""
        texts.append((k, f"{body} {start} {leak} {body} {start}"))
    return texts, items


@pytest.mark.parametrize("coverage", [0.3, 0.5, 1.0])
def test_anchors_lose_no_leak(spark, coverage):
    texts, items = common_runs(60, seed=3)
    texts += [(1000 + k, t + " tail") for k, (_, t) in enumerate(items[::7])] + [(None, items[5][1]), (7, None), (8, "")]
    items += [(500, "which of the following statements about"), (501, "of the following which of the following"), (1, "a b c")]
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    every = string_tiling.tilings(docs, bench).filter(
        (F.col("covered") >= coverage * F.col("n_words")) & (F.col("covered") >= F.least(F.lit(8), "n_words"))
    )
    columns = ("doc_id", "item_id", "n_words", "covered", "tiles")
    want = by_key(every, *columns)
    assert want and by_key(string_tiling.leaks(docs, bench, coverage), *columns) == want


def test_a_common_run_joins_no_pairs(spark):
    n = 2000
    texts, items = common_runs(n, seed=4)
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    runs = string_tiling.item_runs(bench)
    shared = string_tiling.shared_runs(docs, runs)
    pairs = string_tiling.candidates(shared, runs, 0.5).count()
    assert shared.join(runs, "seed").select("doc_id", "item_id").distinct().count() == n * n
    assert pairs < n
    found = {(r["doc_id"], r["item_id"]) for r in string_tiling.leaks(docs, bench).collect()}
    whole = {(k, k) for k in range(0, n, 40) if len(items[k][1].split()) >= 18}
    assert whole <= found <= {(k, k) for k in range(0, n, 40)}


def test_decontamination_of_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    expected = {d["doc_id"] for d in docs for i in items if i["text"] in d["text"]}
    got = {r["doc_id"] for r in registered.op5_decontamination(spark, SF).collect() if r["contaminated"]}
    assert expected and expected <= got and len(got - expected) <= 2


# --- top-k search --------------------------------------------------------------------------


def brute_top(rows, k, scale, step):
    rows = {
        d: [int(np.floor(scale * float(np.float32(x)))) for x in v]
        for d, v in rows if d is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    out = []
    for q, a in rows.items():
        if q % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), d) for d, b in rows.items() if d != q and len(a) == len(b))
        out += [(q, r + 1, d, -s) for r, (s, d) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 100_000])
def test_top_k(spark, block):
    rng = np.random.default_rng(8)
    rows = [(int(k), rng.normal(size=6).astype(np.float32).tolist()) for k in range(90)]
    rows += [(100 + k, rows[3][1]) for k in range(12)]  # ties
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] * 6), (205, [float("inf")] * 6),
             (None, rows[1][1]), (210, [0.5, 0.25]), (220, [1.0, -1.0]), (211, [0.0, 0.0]), (230, []), (231, []), rows[5]]
    df = spark.createDataFrame([(d, v, 1, 2) for d, v in rows], "vec_id long, embedding array<float>, score int, rank int")
    found = bit_sliced.top_k(df, F.col("vec_id") % 10 == 0, k=5, scale=256, block=block, chunk=3)
    assert by_key(found, "query_id", "rank", "vec_id", "score") == sorted(brute_top(rows, 5, 256, 10), key=repr)
    assert bit_sliced.top_k(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_copies_of_queries_are_not_broadcast(spark):
    """The planner sees the queries before there is a copy of them for each block: they looked small."""
    rng = np.random.default_rng(8)
    rows = [(int(k), rng.normal(size=6).astype(np.float32).tolist()) for k in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = bit_sliced.top_k(df, F.col("vec_id") % 5 == 0, k=5, scale=256, block=7, chunk=3, slot=2)
    assert by_key(found, "query_id", "rank", "vec_id", "score") == sorted(brute_top(rows, 5, 256, 5), key=repr)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_score_slices_add_up():
    rng = np.random.default_rng(9)
    values = rng.integers(-300, 300, (130, 5))
    slices, low, _ = bit_sliced.slice_rows(values)
    query = [3, -7, 0, 255, -128]
    bits = bit_sliced.score_slices(slices, query)
    total = sum(np.unpackbits(b.view(np.uint8), bitorder="little")[:130].astype(np.int64) << k for k, b in enumerate(bits))
    exact = values @ np.array(query)
    assert len(set((total - exact).tolist())) == 1
    for n in (0, 1, -1, 6, 255, -256, 1023):
        assert sum(s << p for p, s in bit_sliced.signed_digits(n)) == n


# --- licenses ------------------------------------------------------------------------------

PHRASES = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}


def brute_scan(text):
    w = [x.decode() for x in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))]
    hits = [(k, n) for n, p in PHRASES.items() for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    at = [k for k, _ in hits]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in hits}))


def test_license_scan(spark):
    texts = [*TEXTS, (40, "All Rights\nReserved, all rights reserved. CC-BY"), (41, "GNU General Public License cc by nc 4.0 cc by"),
             (42, "released here under the mit license"), (43, "rights reserved all"), (44, "ccby général public license")]
    found = diagonal_voting.scan(documents(spark, texts))
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert by_key(found, *columns) == sorted(((d, *brute_scan(t)) for d, t in texts), key=repr)
    labels = {r["doc_id"]: set(r["labels"].split(",")) for r in found.collect()}
    assert labels[42] == {"mit"} and {"gpl", "cc-by"} <= labels[41] and labels[43] == {""}
    assert all(0 <= r["score"] <= 1 for r in found.collect())
    assert diagonal_voting.scan(documents(spark, [])).collect() == []


def test_license_scan_of_the_tables(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    got = by_key(registered.op7_license_scan(spark, SF), *columns)
    assert got == sorted(((d, *brute_scan(t)) for d, t in texts), key=repr)


def brute_statements(text, drift=2, enough=0.6):
    """Labels and score by looking at every k-gram of every template."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    labels, score = set(), 0.0
    for template in diagonal_voting.BASE + diagonal_voting.STATEMENTS:
        own = template.text.split()
        grams = len(own) - 1
        points = [(i, j) for j in range(grams) for i in range(len(words) - 1) if words[i : i + 2] == own[j : j + 2]]
        parts, last = [], None
        for d, i, j in sorted((i - j, i, j) for i, j in points):
            if last is None or d - last > (0 if template.exact else drift):
                parts.append([])
            parts[-1].append((i, j))
            last = d
        for part in parts:
            seen = {own[j + x] for _, j in part for x in (0, 1)}
            if not set(template.needs) <= seen:
                continue
            best = {}
            for i, j in sorted(part):
                best[i, j] = 1 + max((n for (a, b), n in best.items() if a < i and b < j), default=0)
            share = max(best.values()) / grams
            score = max(score, share)
            if share >= (1 if template.exact else enough):
                labels.add(template.label)
    return ",".join(sorted(labels)), score


def test_spans_are_verified(spark):
    rng = random.Random(5)
    texts = [
        (1, "Licensed under CC BY 4.0"), (2, "licensed under CC BY-NC 4.0 here"), (3, "nc. Licensed under cc by 4 0"),
        (4, "this work is licensed under the GNU General Public License, version 2"),
        (5, "This work is hereby licensed under the GNU general public license version 3"),
        (6, "public license version 3 gnu general this work is licensed under the"),
        (7, "licensed under a creative commons attribution license"), (8, None), (9, ""), (None, "released under the MIT license"),
        (10, "under the " * 500 + "mit license"), (11, "released under the mit license " * 3),
    ]
    for k in range(120):  # statements with words left out, put in, and moved
        words = rng.choice(diagonal_voting.STATEMENTS + diagonal_voting.BASE).text.split()
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(words))
            words = rng.choice([words[:at] + words[at + 1 :], [*words[:at], "so", *words[at:]], words[at:] + words[:at]]) or ["x"]
        texts.append((100 + k, " ".join(["a", *words, "b"] + words[: rng.randrange(3)])))
    got = by_key(diagonal_voting.scan(documents(spark, texts)), "doc_id", "labels", "score")
    assert [g[:2] for g in got] == [w[:2] for w in sorted(((d, *brute_statements(t)) for d, t in texts), key=repr)]
    assert got == sorted(((d, *brute_statements(t)) for d, t in texts), key=repr)
    labels = {g[0]: g[1] for g in got}
    assert labels[1] == labels[3] == "cc-by" and labels[2] == "cc-by,cc-by-nc"
    assert labels[4] == "gpl" and labels[5] == "gpl,gpl-3" and labels[7] == ""
