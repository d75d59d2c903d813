"""Line, substring and n-gram operators against brute force."""

from __future__ import annotations

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from shared import TEXTS, by_key, documents, lower, sha, words

from tallyloom.llm import block_anchors, graph, line_runs, packed, signature_tree


def noisy_copies(seed: int, families: int = 6, per: int = 9, size: int = 70):
    """Families of near copies, some chains of them, with a passage that all share."""
    rng = random.Random(seed)
    common = [f"common{k}" for k in range(60)]
    out, doc = [], 100
    for f in range(families):
        base = [f"f{f}w{k}" for k in range(size)] + (common if f % 2 else [])
        text = list(base)
        for _ in range(per):
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = f"n{rng.random()}"
            out.append((doc, " ".join(text if rng.random() < 0.5 else base)))
            doc += 1
    rng.shuffle(out)
    return out


# --- lines -------------------------------------------------------------------------------


def brute_lines(texts, least):
    docs = defaultdict(set)
    key = lambda x: x.strip(b" \t\n\x0b\x0c\r").lower()
    for d, t in texts:
        for x in (t or "").encode().split(b"\n"):
            if d is not None and key(x):
                docs[key(x)].add(d)
    out = []
    for d, t in texts:
        lines = (t or "").encode().split(b"\n")
        gone = [len(docs[key(x)]) >= least for x in lines]
        kept = [x for x, g in zip(lines, gone, strict=True) if not g]
        out.append((d, len(lines), sum(gone), sha(b"\n".join(kept))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_line_dedup(spark, least):
    texts = [*TEXTS, *((50 + k, f"shared line\nown {k}\n SHARED LINE \t") for k in range(4))]
    out = line_runs.drop_common_lines(documents(spark, texts), least)
    got = by_key(out.withColumn("s", F.sha2("kept", 256)), "doc_id", "n_lines", "n_dropped", "s")
    assert got == brute_lines(texts, least)


def test_lines_kept_with_all_columns(spark):
    docs = documents(spark, [(k, f"a\nb{k}") for k in range(3)] + [(9, None), (None, "a\nc")])
    out = line_runs.with_kept_text(docs, 3)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert by_key(out, "doc_id", "text", "n_chars") == sorted(
        [(0, "b0", 2), (1, "b1", 2), (2, "b2", 2), (9, None, 4), (None, "c", 1)], key=repr
    )


def test_any_column_names_pass_line_dedup(spark):
    names = ["_id", "_drop", "_kept", "_n_dropped", "row", "key", "owner", "drop", "kept", "a.b"]
    docs = documents(spark, [(k, f"a\nb{k}") for k in range(3)]).select("doc_id", "text")
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    out = line_runs.with_kept_text(docs, 3)
    assert out.columns == docs.columns
    assert sorted(r[1:] for r in out.collect()) == [(f"b{k}", *names) for k in range(3)]


def test_runs_are_levelled(spark):
    runs = line_runs.LineRuns(min_docs=3, fanout=2)
    for batch in range(5):
        rows = [(10 * batch + k, 1, 1) for k in range(2)] + [(batch, batch, 2)]
        runs.add(spark.createDataFrame(rows, "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    # The common hash is not counted any more once it is known.
    assert by_key(runs.totals(), "h1", "h2", "docs") == sorted(
        [(1, 1, 4), *((k, 2, 1) for k in range(5))], key=repr
    )


def test_line_dedup_of_nothing(spark):
    assert line_runs.drop_common_lines(documents(spark, []), 2).collect() == []


# --- substrings --------------------------------------------------------------------------


def brute_repeats(texts, span):
    first = {}
    rows = [(d, words(t)) for d, t in texts]
    for d, w in rows:
        for k in range(len(w) - span + 1 if d is not None else 0):
            key = tuple(w[k : k + span])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in rows:
        gone = set()
        for k in range(len(w) - span + 1 if d is not None else 0):
            if first[tuple(w[k : k + span])] < d:
                gone.update(range(k, k + span))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((d, len(w), len(gone), sha(b" ".join(kept))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("span", [4, 7, 50])
def test_substring_dedup(spark, span):
    texts = [*TEXTS, *noisy_copies(1)]
    out = block_anchors.remove_repeats(documents(spark, texts), span)
    got = by_key(out.withColumn("s", F.sha2("kept", 256)), "doc_id", "n_words", "n_removed", "s")
    assert got == brute_repeats(texts, span)


@pytest.mark.parametrize("many", [1, 3])
def test_frequent_windows_are_settled_alike(spark, monkeypatch, many):
    monkeypatch.setattr(block_anchors, "_MANY", many)
    passage = " ".join(f"p{k}" for k in range(60))
    hot = [(50_000 + 7 * k % 40, f"{'u' * (k % 3)} {k} {passage} {k * k} " + "same " * (k % 5) * 20) for k in range(40)]
    texts = [*TEXTS, *noisy_copies(1), *hot, (-9, "z " * 300), (90_000, "z " * 200)]
    for span in (3, 7, 50):
        out = block_anchors.remove_repeats(documents(spark, texts).repartition(3), span)
        got = by_key(out.withColumn("s", F.sha2("kept", 256)), "doc_id", "n_words", "n_removed", "s")
        assert got == brute_repeats(texts, span)


def test_a_hot_window_fills_no_bucket():
    """20,000 documents with one passage at different places send a few rows for each of its windows."""
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    settle = block_anchors._settle_probes(25)
    packer = block_anchors.SettlingPacker(64, settle, 5)
    batches = []
    for low in range(0, 20_000, 1000):
        doc, at = np.repeat(np.arange(1000), 30), np.repeat(rng.integers(0, 9, 1000), 30) + np.tile(np.arange(30), 1000)
        batches += packer.add(np.tile(passage, 1000), doc, np.arange(low, low + 1000), at)
    batches += packer.end()
    table = pa.Table.from_batches(batches)
    below = np.array([b < 0 for b in table["bucket"].to_pylist()])
    sent = table.filter(pa.array(~below))
    assert len(packed.joined(sent["keys"], np.uint32)) <= 2 * 30 * 1
    assert set(packed.per_key(sent, "ids").tolist()) == {0, 19_999}
    hits = packed.joined(table.filter(pa.array(below))["ids"], np.int64)
    assert set(hits.tolist()) == set(range(20_000)) and len(hits) <= 3 * 20_000
    assert not below.all() and below.sum() == 1


def test_repeats_name_their_original(spark):
    passage = " ".join(f"p{k}" for k in range(12))
    texts = [(5, f"a b {passage} c"), (2, f"{passage} d"), (9, f"x {passage}")]
    spans = block_anchors.repeats(documents(spark, texts), 10)
    assert by_key(spans, "doc_id", "start", "end", "ref_doc", "ref_start") == [
        (5, 2, 14, 2, 0),
        (9, 1, 13, 2, 0),
    ]


def test_merging_holds_a_few_documents_at_a_time():
    """Windows come in sorted rows, cut anywhere; what is held is a piece and the last document's rows."""
    rows, want = [], []
    for doc in range(2_000):
        for k in range(40):  # each row has every 40th window from k on: of two repeats and one more place
            at = np.arange(k, 400, 40)
            ref = np.where(at < 200, doc + 10_000, doc + 20_000)
            kinds = (at, np.uint32), (ref, np.int64), (at + 7, np.uint32)
            rows.append((doc, *(x.astype(t).tobytes() for x, t in kinds)))
        rows.append((doc, *(np.array([x]).astype(t).tobytes() for x, t in ((500, "u4"), (1, "i8"), (3, "u4")))))
        want += [(doc, 0, 249, doc + 10_000, 7), (doc, 200, 449, doc + 20_000, 207), (doc, 500, 550, 1, 3)]
    names = ["doc_id", "at", "ref", "ref_at"]
    table = pa.table([pa.array(c) for c in zip(*rows, strict=True)], names)
    for size in (7, 41, 10_000):
        got = []
        tracemalloc.start()
        for part in block_anchors._merge(50)(iter(table.to_batches(size))):
            got += zip(*(c.to_pylist() for c in part.columns), strict=True)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got == want
        assert peak < 60e6


def test_windows_are_not_gathered_in_lists(spark, capsys):
    block_anchors.repeats(documents(spark, TEXTS), 10).explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and "collect_list(struct(" not in plan.replace("named_struct", "struct")


def test_substring_dedup_of_nothing(spark):
    assert block_anchors.remove_repeats(documents(spark, []), 50).collect() == []


# --- n-gram sets -------------------------------------------------------------------------


def shingles(text, k=5):
    w = lower(text).split()
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def brute_classes(texts, threshold=80):
    sets = {d: shingles(t) for d, t in texts if d is not None}
    head = {d: d for d in sets}

    def root(d):
        while head[d] != d:
            d = head[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * x >= threshold * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                head[high] = low
    return sorted((d, len(sets[d]), root(d)) for d in ids)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    texts = [*TEXTS, *noisy_copies(seed), (60, "a b c d"), (61, "A b c d"), (62, "a b c d e")]
    got = by_key(signature_tree.near_duplicates(documents(spark, texts)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_classes(texts), key=repr)


def test_large_areas_go_by_chunks(spark):
    """With tiny blocks, links across chunks are found all the same."""
    texts = noisy_copies(3, families=3, per=14, size=60)
    docs = documents(spark, texts).select("doc_id", "text")
    sets = docs.mapInArrow(signature_tree._set_tasks(5), "doc_id long, n long, grams binary")
    kept = signature_tree.stage(sets.dropDuplicates(["grams"]), "sets")
    linked = signature_tree.similar_sets(kept, 80, chunk=2, block=3)
    ids = {r["doc_id"] for r in kept.collect()}
    expected = [(d, c) for d, _, c in brute_classes([t for t in texts if t[0] in ids])]
    classes = dict.fromkeys(ids)
    classes = {d: d for d in classes} | {r["node"]: r["component"] for r in linked.collect()}
    assert sorted(classes.items()) == expected


def near_copies(copies, words=150):
    """One family of near copies, most of which differ too much to link with each other."""
    rng = random.Random(copies)
    base = [f"w{k}" for k in range(words)]
    out = []
    for d in range(copies):
        text = list(base)
        for at in rng.sample(range(words), rng.choice([2, 3, 3, 3, 4])):
            text[at] = f"x{rng.randrange(10**9)}"
        out.append((d, " ".join(text)))
    return out


def test_meetings_grow_with_the_family(spark, monkeypatch):
    """Four times the near copies give at most five times the rows that meet; classes stay exact."""
    seen = []
    plain = signature_tree.meetings

    def counted(*args):
        out = plain(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(signature_tree, "meetings", counted)
    for copies in (250, 1000):
        texts = near_copies(copies)
        got = by_key(signature_tree.near_duplicates(documents(spark, texts)), "doc_id", "n_shingles", "component_id")
        assert got == sorted(brute_classes(texts), key=repr)
        assert len({c for _, _, c in got}) > 1
    assert 100 < seen[0] and seen[1] <= 5 * seen[0] and seen[1] <= 1000


def test_short_prefixes_are_enough():
    """Of two sets that link, the smaller one lacks no more than its short slack of the other."""
    for t in (50, 80, 90, 100):
        for n in range(1, 200):
            for more in range(n, 260):
                least = -(-t * (n + more) // (100 + t))  # the overlap that a link needs
                if least <= n:
                    assert n - least <= signature_tree.short_slack(n, t)
                    assert more - least <= signature_tree.slack(more, t)


def test_tree_bounds_lose_nothing():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    sets = []
    for k in range(60):
        keep = rng.random(len(base)) > 0.12 * (k % 3)
        more = rng.integers(0, 1 << 63, 30 * (k % 4), dtype=np.uint64)
        sets.append(np.unique(np.concatenate([base[keep], more])))
    sets += [np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64)) for _ in range(20)]
    group = np.arange(len(sets))
    signature_tree.tree_links(sets, group, np.zeros(len(sets), int), 80)
    head = np.arange(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            x = len(np.intersect1d(sets[i], sets[j]))
            if 100 * x >= 80 * (len(sets[i]) + len(sets[j]) - x):
                low, high = sorted((head[i], head[j]))
                head[head == high] = low
    assert group.tolist() == head.tolist()


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 50), (50, 70), (5, 5), (70, 100)]
    got = by_key(graph.components(spark.createDataFrame(edges, "v long, u long")), "node", "component")
    assert got == sorted([(k, 0) for k in range(41)] + [(k, 50) for k in (50, 70, 100)], key=repr)


def test_near_duplicates_of_nothing(spark):
    assert signature_tree.near_duplicates(documents(spark, [])).collect() == []


def test_one_of_each_class_stays(spark):
    rows = [(1, "a"), (1, "a"), (1, "other"), (2, "b"), (3, "b"), (None, "c"), (None, "c")]
    docs = documents(spark, rows).withColumn("_alone", F.lit(0)).withColumn("lone", F.lit(0)).withColumn("row", F.lit(0))
    classes = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "doc_id long, component_id long")
    out = signature_tree.one_of_each(docs, classes)
    assert out.columns == docs.columns
    kept = [(1, "a"), (1, "other"), (2, "b"), (None, "c"), (None, "c")]
    assert by_key(out, "doc_id", "text") == sorted(kept, key=repr)


def test_packed_rows_round_trip():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    doc = np.sort(rng.integers(0, 40, 5000))
    ids = np.arange(40) * 7 - 9
    at = rng.integers(0, 200_000, 5000)
    packer = packed.Packer(16, wide=True, most=1)
    table = pa.Table.from_batches([*packer.add(h, doc, ids, at, more=h >> np.uint64(7)), *packer.end()])
    got = zip(
        packed.joined(table["keys"], np.uint64).tolist(),
        packed.per_key(table, "ids").tolist(), packed.places(table).tolist(), strict=True,
    )
    assert sorted(got) == sorted(zip(h.tolist(), ids[doc].tolist(), at.tolist(), strict=True))
