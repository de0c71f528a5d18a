"""The pipeline, stage by stage against brute force, on real documents and odd ones."""

from __future__ import annotations

import shutil
import zlib

import corpus_pipeline
import pytest
from test_operators import ODD, cut, groups, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import packing, stages, toxicity
from tickloom.llm.store import staged

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables, and odd documents with a column more."""
    place = tmp_path_factory.mktemp("tables")
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SOURCE}/{name}.parquet", place / f"{name}.parquet")
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet").withColumn("class", F.lit("clash"))
    odd = spark.createDataFrame([(i and i + 10**6, t, None, None, None, "clash") for i, t in ODD], docs.schema)
    docs.unionByName(odd).coalesce(3).write.parquet(str(place / "documents.parquet"))
    return str(place)


@pytest.fixture(scope="module")
def steps(spark, folder):
    """What goes into each stage, and what comes out of the last."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], folder), name))
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def key(row):
    return repr(row)


def test_stages_keep_the_columns(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_toxic_documents_go(spark, folder, steps):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.classify(steps[0], labels)
    toxic = {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    assert toxic
    assert sorted(texts(steps[1]), key=key) == sorted(((i, t) for i, t in texts(steps[0]) if i not in toxic), key=key)


def test_one_of_each_group_stays(steps):
    rows = texts(steps[1])
    component = {(i, n): c for i, n, c in groups(rows, stages.NEAR_SHINGLE, stages.NEAR_PERCENT)}
    want = {i for (i, n), c in component.items() if i is not None and (c == i or n == 0)}
    assert {i for i, _ in texts(steps[2]) if i is not None} == want
    assert sum(i is None for i, _ in texts(steps[2])) == sum(i is None for i, _ in rows)
    assert len(set(texts(steps[2]))) == len([i for i, t in texts(steps[2]) if words(t) and i is not None]) + len({(i, t) for i, t in texts(steps[2]) if not words(t) or i is None})


def test_near_copies_share_four_fifths_of_five_word_shingles(spark, folder):
    base = [f"b{i}" for i in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, *(f"x{i}" for i in range(45))])), (3, " ".join([*base, *(f"y{i}" for i in range(60))]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.STAGES[1][1](spark, docs, folder)
    assert {i for i, c in ((i, c) for i, _, c in groups(rows, 5, 80)) if i == c} == {1, 3}
    assert {r["doc_id"] for r in kept.collect()} == {1, 3}


def test_repeats_are_cut(steps):
    rows = texts(steps[2])
    by_id = {(i, " ".join(words(t))): t for i, t in rows}
    got = sorted(((i, " ".join(words(t))) for i, t in texts(steps[3])), key=key)
    assert got == sorted(((i, kept) for i, _, _, kept in cut(rows, 13)), key=key)
    # A text that lost nothing is as it was.
    assert all(t == by_id[i, " ".join(words(t))] for i, t in texts(steps[3]) if (i, " ".join(words(t))) in by_id and t)
    changed = steps[3].where("n_chars IS NOT NULL AND n_chars != char_length(text)").count()
    assert changed == steps[0].where("n_chars IS NOT NULL AND n_chars != char_length(text)").count()


def test_contaminated_documents_go(spark, folder, steps):
    items = [" ".join(words(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = [(i, t) for i, t in texts(steps[3]) if not any(x in " ".join(words(t)) for x in items)]
    assert len(want) < len(texts(steps[3]))
    assert sorted(texts(steps[4]), key=key) == sorted(want, key=key)


def pieces(df):
    return sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect()), key=key)


def test_everything_left_is_packed(steps):
    exact = Tokenizer.from_file(packing.default_tokenizer())
    want = []
    for i, t in texts(steps[4]):
        ids = exact.encode(t or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : first if piece == 0 else start + 1024]
            want.append((i, piece, start, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    assert pieces(steps[5]) == sorted(want, key=key)
    filled = steps[5].groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert filled.where("n > 1024").isEmpty()


def test_run_is_its_stages(spark, folder, steps):
    assert pieces(corpus_pipeline.run(spark, folder)) == pieces(steps[5])


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
