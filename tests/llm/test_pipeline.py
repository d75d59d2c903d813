"""The pipeline: each stage on its predecessor's rows, and all of it."""

from __future__ import annotations

import shutil

import pytest
from shared import TEXTS, by_key, documents
from test_dedup import brute_classes, brute_lines, noisy_copies
from test_search_and_packing import brute_pieces
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tallyloom.llm import registered
from tallyloom.llm.common import stage

SF = "/root/testdata/sf0.001"
NAMES = ["toxicity", "line_dedup", "ngram_join", "decontamination", "packing"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with planted cases, and the given labels and benchmark."""
    path = tmp_path_factory.mktemp("corpus")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(3).collect()
    plain = [(1000 + k, f"doc{k} says " + " ".join(f"v{k}u{j}" for j in range(40))) for k in range(40)]
    toxic = [(2000 + k, f"you zilchbag {k} and grumblefop t{k} {k * 7} so there") for k in range(10)]
    lines = [(3000 + k, f"shared banner line\nown words of {k} a{k} b{k} c{k} d{k} e{k}") for k in range(12)]
    leaks = [(4000 + k, f"intro {k} " + r["text"] + f" outro {k}") for k, r in enumerate(items)]
    texts = [*TEXTS, *plain, *toxic, *lines, *leaks, *noisy_copies(7, families=3)]
    documents(spark, texts).write.parquet(f"{path}/documents.parquet")
    labels = [(d, 1, int(2000 <= d < 2006)) for d, _ in texts if d and (d < 2006 or d >= 3000)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    shutil.copy(f"{SF}/benchmark.parquet", path / "benchmark.parquet")
    return str(path)


def rows(df):
    return by_key(df, "doc_id", "text")


def test_stages_one_by_one(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, folder), name)
        if name != "packing":
            assert out.columns == columns
        seen[name] = (docs, out)
        docs = out

    before, after = seen["toxicity"]
    gone = {r["doc_id"] for r in before.select("doc_id").collect()} - {r["doc_id"] for r in after.select("doc_id").collect()}
    assert gone == set(range(2000, 2010))

    before, after = seen["line_dedup"]
    lines = brute_lines(rows(before), 10)
    changed = {d for d, _, n, _ in lines if n}
    assert set(range(3000, 3012)) <= changed
    assert all("banner" not in (t or "") for _, t in rows(after))
    assert [d for d, _ in rows(after)] == [d for d, _ in rows(before)]
    assert {(d, t) for d, t in rows(before) if d not in changed} <= set(rows(after))

    before, after = seen["ngram_join"]
    heads = {c for _, _, c in brute_classes(rows(before))}
    kept = [d for d, _ in rows(after)]
    assert sorted(d for d in kept if d is not None) == sorted(heads)
    assert kept.count(None) == 2  # rows without id can't be named

    before, after = seen["decontamination"]
    gone = {d for d, _ in rows(before)} - {d for d, _ in rows(after)}
    assert gone == {4000, 4001, 4002}

    before, after = seen["packing"]
    plain = Tokenizer.from_file(registered.tokenizer_path())
    got = by_key(after, "doc_id", "piece", "start", "length", "ids_crc32")
    assert got == brute_pieces(plain, rows(before), 4096)


def test_run_equals_the_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, folder), "step")
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    assert by_key(corpus_pipeline.run(spark, folder), *columns) == by_key(docs, *columns)


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_all_operators_are_registered():
    names = set(entry.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    assert set(registered.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_matches_sql(spark, name):
    from check_oracle import compare

    ok, note = compare(spark, SF, name, registered.oracle_sql()[name])
    assert ok, note
