"""The Merkle manifest against brute force: every step size, hot and tiny sources, odd input."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tickloom.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, g long, leaf string, i int, root string"
RESULT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def documents(spark, rows):
    """Documents with extra columns that clash with results and inner names."""
    return spark.createDataFrame([(*r, 1, "clash", 2, "clash") for r in rows], COLUMNS).repartition(3)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i : i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def changed(row):
    text = row[4]
    return text.replace("\n", "") if text and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 else text


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    trees = []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        leaves = [(r[0], h(*map(field, r)), h(*map(field, (*r[:4], changed(r))))) for r in by_source[source]]
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((leaves, levels([x[1] for x in leaves])))
    top = levels([t[1][-1][0] for t in trees])
    found = []
    for number, (leaves, low) in enumerate(trees):
        for place, (doc, leaf, folded) in enumerate(leaves):
            proof = []
            for at, tree in ((place, low), (number, top)):
                for level in tree[:-1]:
                    first = at - at % 3
                    before, after = level[first:at], level[at + 1 : first + 3]
                    proof += before + after
                    folded, at = h(*before, folded, *after), at // 3
            found.append((doc, leaf, low[-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return sorted(found, key=repr)


def got(spark, rows):
    now = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.manifest(documents(spark, rows), now).select(*RESULT).collect()), key=repr)


def made():
    dice = random.Random(1)
    sources = [None, "", "b", "a", "é", "\U0001f600", "�"] + ["hot"] * 5
    rows = [(i if i % 97 else None, dice.choice(sources), "en", 5, f"t{i}\n{i}" if i % 7 else None) for i in range(400)]
    # Repeated ids and rows, empty and long texts, a source of one document.
    rows += [(1, "a", None, None, "x")] * 5 + [(2, "a", "de", 0, ""), (2, "a", "de", 0, "\n" * 9), (3, "hot", "fr", 1, "w\n" * 200_000), (9, "only", "en", 1, "y")]
    return rows


@pytest.mark.parametrize(("step", "load"), [(1, 7), (2, 50_000), (6, 5)])
def test_rows_equal_brute_force(spark, monkeypatch, step, load):
    monkeypatch.setattr(merkle, "STEP", step)
    monkeypatch.setattr(merkle, "BLOCK", merkle.ARITY**step)
    monkeypatch.setattr(merkle, "LOAD", load)
    rows = made()
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("count", [0, 1, 2, 3, 4])
def test_few_documents(spark, count):
    rows = [(i, "one" if i else None, "en", None, "a\nb") for i in range(count)]
    assert got(spark, rows) == brute(rows)


def test_untouched_documents_verify_and_any_change_does_not(spark):
    rows = [(i, f"s{i % 4}", "en", 3, f"text {i}") for i in range(100)]
    docs = documents(spark, rows)
    assert merkle.manifest(docs).where("NOT verified").isEmpty()
    now = F.when(F.col("doc_id") == 17, F.lit("text 18")).otherwise(F.col("text"))
    broken = merkle.manifest(docs, now).where("NOT verified").collect()
    assert [r["doc_id"] for r in broken] == [17]


def test_a_row_climbed_by_many_leaves_has_copies(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LOAD", 10)
    tree = merkle.build(documents(spark, [(i, "hot", None, None, "x") for i in range(95)] + [(1000, "b", None, None, "x")]))
    copies = {r["i"]: r["count"] for r in tree.inner.where(f"g = {merkle.TOP}").groupBy("i").count().collect()}
    assert copies == {0: 1, 1: 10}
