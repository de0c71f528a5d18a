"""Each operator against brute force, and on odd input: nulls, empty and long texts, ties, repeated rows, no rows, clashing names."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import struct
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.llm import chat, components, decontaminate, html, labelled, packing, partenum, quality, queries, rules, substring, text, toxicity, warc

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept_text string, class long, score double"


def words(value):
    return WORD.findall(value or "")


def documents(spark, rows):
    """Documents with extra columns that clash with results."""
    return spark.createDataFrame([(i, t, None, "s", None, "clash", 7, 0.5) for i, t in rows], COLUMNS)


LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(40_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "alone with no id " * 9), (None, None), (5, LONG), (6, LONG), (6, LONG), (7, "a b c d e f g h i j k l m n"), (7, "a b c d e f g h i j k l m n"), (8, "Zoë\u00a0été \U0001f600 < [x] \\")]


# words and hashes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x0c\r\x1c\x85\u00a0é\U0001f600AZ", max_size=40)), max_size=12), st.booleans())
def test_words_are_those_of_the_pattern(texts, lower):
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    seen = {}
    for t in text.tokens(column, lower):
        own = t.bounds()
        for i in range(t.rows):
            found = [t.data[a:b].tobytes().decode() for a, b in zip(t.start[own[i] : own[i + 1]], t.end[own[i] : own[i + 1]], strict=True)]
            assert found == words(texts[t.first + i])
            for word, h in zip(found, t.hash[own[i] : own[i + 1]], strict=True):
                assert seen.setdefault(word.translate(text.ASCII_LOWER) if lower else word, h) == h
    assert len(set(map(int, seen.values()))) == len(seen)


# 6: substring dedup


def cut(rows, width):
    first = {}
    for i, t in rows:
        own = words(t)
        for k in range(len(own) - width + 1):
            if i is not None:
                gram = tuple(own[k : k + width])
                first[gram] = min(first.get(gram, i), i)
    out = []
    for i, t in rows:
        own = words(t)
        gone = [False] * len(own)
        for k in range(len(own) - width + 1):
            if i is not None and first[tuple(own[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, len(own), sum(gone), " ".join(w for w, g in zip(own, gone, strict=True) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("buffer", [5, 10_000_000])
def test_substring_dedup_equals_brute_force(spark, buffer):
    dice = random.Random(6)
    made = [(i, " ".join(dice.choice("abc") for _ in range(dice.randrange(40)))) for i in range(60)]
    rows = made + ODD
    got = substring.remove_repeats(documents(spark, rows), 4, buffer).select("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == cut(rows, 4)


def test_removed_intervals_are_maximal(spark):
    rows = [(1, "a b c d"), (2, "x a b c d y a b c z")]
    got = substring.remove_repeats(documents(spark, rows), 2).orderBy("doc_id").collect()
    assert [[tuple(s) for s in r["removed"]] for r in got] == [[], [(1, 5), (6, 9)]]
    assert got[1]["lang"] is None and got[1]["source"] == "s"


# 10: n-gram Jaccard join


def groups(rows, n=4, percent=85):
    sets = []
    for _, t in rows:
        own = [w.translate(text.ASCII_LOWER) for w in words(t)]
        sets.append(frozenset(tuple(own[k : k + n]) for k in range(max(1, len(own) - n + 1))) if own else frozenset())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if rows[x][0] is not None and rows[y][0] is not None and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                parent[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[root(x)] = min(least.get(root(x), i), i)
    return sorted(((i, len(sets[x]), None if i is None else least[root(x)]) for x, (i, _) in enumerate(rows)), key=repr)


def near(dice, base, edits):
    own = list(base)
    for _ in range(edits):
        own[dice.randrange(len(own))] = f"e{dice.randrange(10**6)}"
    return " ".join(own)


@pytest.mark.parametrize("last_pairs", [partenum.LAST_PAIRS, 0])
def test_near_copies_equal_brute_force(spark, monkeypatch, last_pairs):
    monkeypatch.setattr(partenum, "LAST_PAIRS", last_pairs)
    dice = random.Random(10)
    rows = list(ODD)
    base = [f"b{i}" for i in range(150)]
    # A star: copies link with the base more often than with each other.
    rows += [(100 + i, near(dice, base, dice.choice((2, 3, 4)))) for i in range(60)] + [(900, " ".join(base))]
    # Chains at all sizes.
    for size in (3, 5, 8, 13, 30, 90, 400):
        own = [f"c{size}x{i}" for i in range(size)]
        for step in range(6):
            rows.append((1000 * size + step, " ".join(own)))
            own = own[: size // 40 + 1] and own[:-1] + [f"d{step}"]
    # One passage in many otherwise different documents.
    rows += [(5_000_000 + i, " ".join([*base[:30], *(f"p{i}x{k}" for k in range(20))])) for i in range(40)]
    got = partenum.near_copies(documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == groups(rows)


@settings(max_examples=160, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.randoms(use_true_random=False), st.sampled_from([80, 85]))
def test_sets_that_link_share_a_signature(shingles, dice, percent):
    one = sorted(shingles)
    other = set(one)
    for _ in range(dice.randrange(len(one) // 6 + 1)):
        other.discard(dice.choice(one))
        if dice.random() < 0.5:
            other.add(dice.randrange(2**64))
    limits = partenum.Bands(percent)
    if other and 100 * len(other & shingles) >= percent * len(other | shingles):
        a, b = (partenum.signatures(np.array(sorted(s), np.uint64), limits) for s in (shingles, other))
        assert set(a.tolist()) & set(b.tolist())
        a, b = (partenum.second_signatures(np.array(sorted(s), np.uint64), limits) for s in (shingles, other))
        assert set(a.tolist()) & set(b.tolist())


def test_one_of_each_group_stays(spark):
    rows = [(1, "A b c d e"), (2, "a b c d e"), (3, "other words that are not like it"), (3, "other words that are not like it"), (4, ""), (4, ""), (None, "a b c d e"), (5, None)]
    got = partenum.keep_one(documents(spark, rows))
    assert got.columns == documents(spark, rows).columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got.collect() if r["text"]) == [(0, "a b c d e"), (1, "A b c d e"), (3, "other words that are not like it")]
    assert got.count() == 6


def test_slices_of_the_join_find_what_the_whole_does(spark, monkeypatch):
    dice, base = random.Random(12), [f"b{i}" for i in range(120)]
    rows = [*ODD, *((100 + i, near(dice, base, dice.choice((1, 2, 3)))) for i in range(30))]
    # Equal texts in several tasks sign several times, and still are one class.
    rows += [(200 + i, " ".join(base)) for i in range(30)] + [(300 + i, " ".join(f"w{i % 5}x{k}" for k in range(60))) for i in range(40)]
    for name in ("SLICED_ROWS", "SLICED_PAIRS"):
        monkeypatch.setattr(partenum, name, 0)
    tables, plain = {}, partenum.staged

    def staged(df, label):
        table = plain(df, label)
        tables.setdefault(label, []).append([r.signature for r in table.select("signature").collect()] if label == "shared" else table.count())
        return table

    monkeypatch.setattr(partenum, "staged", staged)
    got = partenum.near_copies(documents(spark, rows).repartition(6)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == groups(rows)
    # No step takes all signatures at once, and a signature of one class goes no further.
    found = tables["shared"]
    assert len(found) == partenum.SLICES and sum(map(len, found)) == len(set().union(*found)) > 2 * max(map(len, found))
    own = {s for i in range(5) for s in partenum.signatures(np.unique(next(iter(text.shingle_sets(pa.array([" ".join(f"w{i}x{k}" for k in range(60))]), 4)))), partenum.Bands(85)).view(np.int64).tolist()}
    assert own and not own & set().union(*found)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5, 5), (None, 3)]
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    want = {i: 0 for i in range(1, 301)} | {1001: 1000}
    assert {r["vertex"]: r["component"] for r in got.collect()} == want


# 9: best-fit packing


def test_packing_is_whole_and_tight(spark):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_tokenizer())
    rows = ODD + [(100 + i, f"text {i} " * (i % 97)) for i in range(300)] + [(9, "a<|endoftext|>b")]
    docs = documents(spark, rows).repartition(5)
    pieces = [r.asDict() for r in packing.pack(docs, with_ids=True).collect()]
    want = collections.Counter()
    for i, t in rows:
        ids = exact.encode(t or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : first if piece == 0 else start + 1024]
            want[i, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), tuple(part)] += 1
    assert collections.Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"], tuple(p["ids"])) for p in pieces) == want
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_sequence) <= 1.02 * -(-sum(p["length"] for p in pieces) // 1024) + 1


def test_underfull_bins_merge_in_rounds(spark):
    rows = [(i, "a " * 60) for i in range(400)]
    got = packing.pack(documents(spark, rows).repartition(40), round_items=10)
    sizes = [r["s"] for r in got.groupBy("sequence_id").agg(F.sum("length").alias("s")).collect()]
    assert max(sizes) <= 1024 and len(sizes) <= 1.2 * -(-sum(sizes) // 1024)


def test_sequences_hold_the_ids(spark):
    got = packing.sequences(documents(spark, [(1, "hello world"), (2, None)])).collect()
    assert len(got) == 1 and sorted(got[0]["ids"]) == sorted([31373, 995, 2, 2])


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_tokenizers(value):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_tokenizer())
    assert packing.encoder(packing.default_tokenizer())(value).tolist() == exact.encode(value, add_special_tokens=False).ids


# 8 and 2: classifiers


@pytest.mark.parametrize(("module", "label", "recall"), [(toxicity, "toxic", 0.4), (quality, "quality", 0.97)])
def test_held_out_accuracy(spark, module, label, recall):
    folder = "/root/testdata/sf0.1" if module is toxicity else FOLDER
    recall = 0.85 if module is toxicity else recall
    docs, labels = queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels")
    got = module.classify(docs, labels)
    assert got.count() == docs.count()
    assert got.where("score IS NULL OR score < 0 OR score > 1").isEmpty()
    held = got.join(labels, "doc_id").where("held_out").groupBy(F.col(label).alias("y"), "predicted").count().collect()
    n = {(r["y"], r["predicted"]): r["count"] for r in held}
    assert n.get((1, 1), 0) >= recall * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 0), 0) >= 0.97 * (n.get((0, 0), 0) + n.get((0, 1), 0))


def test_shape_is_of_the_whole_word():
    assert quality.shape("a" * 64 + "+7") == quality.shape("a+7") != quality.shape("a" * 64)


def test_held_out_is_by_crc(spark):
    df = spark.createDataFrame([(i,) for i in (*range(50), None)], "doc_id long")
    for r in df.select("doc_id", labelled.held_out(F.col("doc_id")).alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifiers_on_odd_input(spark, module):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 1, 1), (2, 0, 0), (4, 3, 3)], none.schema)
    for labels in (none, odd):
        got = module.classify(documents(spark, ODD), labels).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert module.classify(documents(spark, []), none).count() == 0


def newton(slope_and_curve, width):
    """The least point of a convex function, to rounding."""
    theta = np.zeros(width)
    for _ in range(60):
        slope, curve = slope_and_curve(theta)
        theta = theta - np.linalg.solve(curve, slope)
    return theta


def test_pairwise_weights_are_near_the_optimum(monkeypatch):
    monkeypatch.setattr(quality, "WIDTH", 4)
    dice = np.random.default_rng(3)
    x = dice.normal(0, 2, (300, 4))
    y = (x @ [1, -1, 0.5, 0] + dice.normal(0, 2, 300) > 0).astype(int)
    mean, scale, theta = quality.fit(x, y)
    z = quality.standard(x, mean, scale)
    chosen = np.random.default_rng(20)
    count = 4 * len(y)
    d = z[chosen.choice(np.flatnonzero(y == 1), count)] - z[chosen.choice(np.flatnonzero(y == 0), count)]

    def loss(t):
        return np.log1p(np.exp(-d @ t)).mean() + quality.RIDGE / 2 * t @ t

    def parts(t):
        lost = 1 / (1 + np.exp(d @ t))
        return -(lost @ d) / count + quality.RIDGE * t, (d * (lost * (1 - lost))[:, None]).T @ d / count + quality.RIDGE * np.eye(4)

    best = newton(parts, 4)
    assert loss(best) <= loss(theta) < loss(best) + 1e-4
    assert np.allclose(theta, best, atol=0.02)


def test_counterfactual_weights_are_near_the_optimum():
    dice = np.random.default_rng(4)
    real = [sorted(set(dice.integers(0, 5, 3).tolist())) for _ in range(120)]
    swapped = [[4 if i == 3 else 3 if i == 4 else i for i in r] if {3, 4} & set(r) else None for r in real]
    y = np.array([float(0 in r or (3 in r and dice.random() < 0.8)) for r in real])
    weights, bias = toxicity.fit(real, swapped, y, 5, np.ones(len(y)))
    x = np.array([[float(i in r) for i in range(5)] + [1.0] for r in real])
    change = np.array([[float(i in r) - float(i in s) for i in range(5)] + [0.0] for r, s in zip(real, swapped, strict=True) if s])
    ridge = toxicity.RIDGE * np.diag([1.0] * 5 + [0.0])

    def loss(t):
        p = 1 / (1 + np.exp(-x @ t))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) + t @ ridge @ t / 2 + toxicity.COUNTERFACTUAL * np.mean((change @ t) ** 2)

    def parts(t):
        p = 1 / (1 + np.exp(-x @ t))
        slope = (p - y) @ x / len(y) + ridge @ t + 2 * toxicity.COUNTERFACTUAL / len(change) * change.T @ (change @ t)
        return slope, (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge + 2 * toxicity.COUNTERFACTUAL / len(change) * change.T @ change

    best = newton(parts, 6)
    # 250 steps of Adam are near it, not at it.
    assert loss(np.r_[weights, bias]) < loss(best) + 3e-3


def test_the_cut_is_a_quantile_of_all_labelled_rows(spark):
    values = spark.createDataFrame([(float(v),) for v in (5, 1, 1, 9, 3, 7, 2, 8)], "value double")
    assert quality.quantile(values, 0.5) == 4.0
    assert quality.quantile(values, 1.0) == 9.0
    docs = documents(spark, [(i, ("good words here, " if i % 4 else "BAD!! ### ") * (5 + i % 7)) for i in range(400)] + [(900, "é" * 300_000), (901, "### " * 200_000)])
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels, limit=60)
    got = {r["doc_id"]: r["s"] for r in quality.with_score(docs, model, "s").collect()}
    assert all((got[i] >= quality.THRESHOLD) == (i % 4 > 0) for i in range(400))
    # However odd a text is, its features go no further than those of the fit.
    assert 0 < got[901] < quality.THRESHOLD and np.isfinite(model.worth(np.full((1, quality.WIDTH), 1e9))).all()


def test_swapped_identity_terms_keep_the_score(spark):
    dice = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        own = [dice.choice("the of and to in it is on at by".split()) for _ in range(12)]
        bad = i % 3 == 0
        if bad:
            own[dice.randrange(12)] = "idiot"
        # In the sample one group is mentioned mostly in toxic sentences.
        if dice.random() < (0.9 if bad else 0.1):
            own[dice.randrange(6)] = "muslims"
        elif dice.random() < 0.5:
            own[dice.randrange(6)] = "jews"
        rows.append((i, " ".join(own)))
        labels.append((i, None, int(bad)))
    model = toxicity.train(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    test = documents(spark, [(1, "the muslims of it"), (2, "the jews of it"), (3, "the christians of it"), (4, "the idiot of it")])
    score = {r["doc_id"]: r["s"] for r in toxicity.with_score(test, model, "s").collect()}
    assert max(score[i] for i in (1, 2, 3)) < 0.5 < score[4]
    assert abs(score[1] - score[2]) < 0.2


# 5: decontamination


def test_decontamination_finds_every_exact_passage(spark):
    docs, items = queries.table(spark, FOLDER, "documents"), queries.table(spark, FOLDER, "benchmark")
    got = {(r["doc_id"], r["item_id"]) for r in queries.op5_benchmark_decontamination(spark, FOLDER).collect()}
    plain = [(r["item_id"], " ".join(words(r["text"]))) for r in items.collect()]
    want = {(d["doc_id"], i) for d in docs.collect() for i, t in plain if t in " ".join(words(d["text"]))}
    assert got == want


def test_templates_and_slots(spark):
    item = "Alice has 3 apples and gives 2 of them to the teacher. How many does Alice have left after 5 km?"
    rows = [
        (1, "so: Bob has 7 apples and gives 4 of them to the teacher. How many does Bob have left after 9 miles? ok"),
        (2, "Bob has 7 apples and gives 4 of them to the teacher. How many does Carl have left after 9 miles?"),
        (None, item),
        (3, "He has apples and the teacher has many of them"),
        (4, item.upper()),
        (5, "intro. " + item + " outro"),
        (5, "another text"),
        *((10 + i, t) for i, (_, t) in enumerate(ODD)),
    ]
    items = spark.createDataFrame([(1, item, "x"), (1, item, "x"), (2, None, "x"), (None, "", "x"), (3, "too short", "x")], "item_id long, text string, doc_id string")
    docs = documents(spark, rows)
    # A copy all in capitals is one, whatever names it holds.
    assert {r["doc_id"] for r in decontaminate.contaminated(docs, items).collect()} == {1, None, 4, 5}
    kept = decontaminate.drop(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 4
    assert decontaminate.drop(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def leaks(spark, rows, items):
    found = decontaminate.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    return {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_exact_copies_are_found_whatever_their_words(spark):
    names = "Anna Berg, Carl Dahl, Eva Falk, Gustav Holm, Ida Jansson, Karl Lund, Maria Nilsson"
    items = [
        (1, "Compute 12 x 7 + 3"),
        (2, names),
        (3, "Scores: 3 4 5 6 7 8 9 10 11 12 13 14 15"),
        (4, "2 + 2 = ?"),
        (5, "The War Of The Worlds And Other Stories Told"),
        (6, "Minutes after the rain had stopped they left the house"),
        (7, "How many legs does a spider of the Old World have"),
        (8, "Xyzzy"),
    ]
    rows = [(i, f"so it says {t} and goes on") for i, t in items]
    rows += [(12, f"say {names.upper()} now"), (13, "say " + items[2][1].lower()), (15, "say " + items[4][1].lower() + " now"), (16, "after 12 " + items[5][1]), (17, "say " + items[6][1].lower() + " now")]
    rows += [(21, "Compute 12 x 7 - 3"), (24, "then 2, 2 and 2 - 2 = 0"), (23, "Scores: 3 4 5 6 7 8 9 10 11 12 13 14 16")]
    own = {(i, i) for i, _ in items} | {(10 + i, i) for i in (2, 3, 5, 6, 7)}
    got = leaks(spark, rows, items)
    # Thirteen of the fourteen words of the scores are a copy of it.
    assert got == own | {(23, 3)}


def test_a_late_edit_of_a_slot_does_not_clear_a_copy(spark):
    head = "Alice has 3 apples and gives some of them to the old teacher who lives near the river, then"
    item = f"{head} Alice buys more of them at the market and Alice carries all of these home by bus"
    rows = [
        (1, item),
        (2, f"{head} Alice buys more of them at the market and Carl carries all of these home by bus"),
        (3, f"{head} Dave buys more of them at the market and Carl carries all of these home by bus"),
        (4, "Bob has 7 apples and gives some of them to the old"),
        # Only short stretches are as they were, and the exchanged names contradict each other.
        (5, "Bob has 3 apples and gives some of those to an old teacher who lives near the lake, then Dave buys more of them at a market and Carl carries"),
    ]
    assert leaks(spark, rows, [(1, item)]) == {(1, 1), (2, 1), (3, 1)}


# 3: WARC


def test_warc_round_trip(spark):
    rows = [(1, "u", "x"), (3, "u\r\nWARC-Type: x", "x"), (2, None, "x"), (2, "u", "x"), (None, "u", "x"), (None, "u", "x"), (7, "u", None), (8, "u", ""), (1, "u", "x"), (9, "é", "é\r\n\r\n" * 50_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    index = warc.write(pages, archive_bytes=200)
    got = warc.read(index).collect()
    assert len(got) == len(rows)
    kinds = collections.Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == {(1, "response", None): 1, (1, "revisit", 1): 1, (2, "revisit", 1): 2, (3, "revisit", 1): 1, (None, "response", None): 2, (7, "response", None): 1, (8, "revisit", 7): 1, (9, "response", None): 1}
    assert next(r["payload"] for r in got if r["page_id"] == 9) == rows[-1][2]
    some = warc.read(index.where("page_id = 9")).collect()
    assert [r["payload_bytes"] for r in some] == [300_000]
    assert warc.read(warc.write(pages.limit(0))).count() == 0
    least = warc.read(warc.write(pages, least_bytes=2)).where("page_id IN (1, 2, 3, 7, 8)")
    assert {r["record_type"] for r in least.collect()} == {"response"}


@pytest.mark.parametrize("page_id", [None, 5])
def test_records_of_one_page_id_or_none_are_spread(spark, page_id):
    rows = [(page_id, f"u{i}", f"body {i % 150}") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    index = warc.write(pages)
    assert index.select("file").distinct().count() > 1
    got = warc.read(index, task_bytes=2000)
    kinds = collections.Counter((r["record_type"], r["refers_to"]) for r in got.collect())
    assert kinds == ({("response", None): 600} if page_id is None else {("response", None): 150, ("revisit", 5): 450})
    tasks = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 4 and sum(r["count"] for r in tasks) == 600


def test_ranges_join_neighbours():
    places = [{"file": f, "offset": o, "length": 10} for f, o in (("a", 0), ("a", 10), ("a", 25), ("a", 100), ("b", 110))]
    assert [len(r) for r in warc._ranges(places, 5, 1000)] == [3, 1, 1]
    assert [len(r) for r in warc._ranges(places, 5, 20)] == [2, 1, 1, 1]


# 1: HTML extraction

PAGES = {
    "": "",
    "<p>a &amp; b<p>c": "a & b c",
    "<title>no</title><body><nav><a href=/>x</a></nav><article><h1>T</h1><p>One, <b>two\n three</p><p> </p><ul><li>x<li>y</ul></article><footer>f</footer>": "T One, two three x y",
    "<div class='sidebar'><p>Much text, that is long, and has commas, in it, of course, and goes on.</p></div><div id=main><p>Real text, with a comma.</p><p>And more of it.</p></div><div class=comments><p>I say, this is, a comment, by a reader, indeed.</p></div>": "Real text, with a comma. And more of it.",
    "<body><p>Kept.</p><script>var t='</p><p>no';</script><style>p{}</style><form><p>no</p></form><!-- <p>no --><p>Too.</p>": "Kept. Too.",
    "<!-- open <p>x": "",
    "plain text only": "plain text only",
    "<article><div class='cookie-notice'>We use</div><p>Text.<aside>no</aside></p><section class=\"comments\"><p>no, no, no</p></section></article>": "Text.",
    "<div>" * 3000 + "deep": "deep",
    "<p>a\u00a0&nbsp;b &lt;p&gt; &#x41;": "a b <p> A",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html.main_text(page) == PAGES[page]


LONG_PARAGRAPH = "Much text, that is long, and has commas, in it, of course, and goes on, and on, and on, to the end of it."


@pytest.mark.parametrize(
    ("before", "after", "want"),
    [
        ("<p>A short intro.</p>", "<p>The end.</p>", "A short intro. {} The end."),
        ("<ul><li>One</ul>", "<blockquote>Said so.</blockquote><div><p>Short part.</p></div>", "One {} Said so. Short part."),
        ("Bare <b>words</b> here.", "<my-note>Own.</my-note>", "Bare words here. {} Own."),
        ("<div><a href=x>Home</a> <a href=y>News</a></div>", "<p><a href=z>More</a></p><div class=sidebar>Side.</div>", "{}"),
        ("", "<figure><figcaption>A caption.</figcaption></figure>", "{} A caption."),
    ],
)
def test_short_siblings_stay(before, after, want):
    inner = f"<p>{LONG_PARAGRAPH}</p>" * 3
    page = f"<body>{before}<div>{inner}</div>{after}</body>"
    assert html.main_text(page) == want.format(" ".join([LONG_PARAGRAPH] * 3))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p title=it's>One two.</p><p>Three four.</p><p>I don't know.</p>", "One two. Three four. I don't know."),
        ('<p>One <img alt="5" tall"> two.</p><p>Say "three".</p>', 'One two. Say "three".'),
        ("<p title=it's>One two.</p>", "One two."),
        ('<p title="x>One two.</p>', "One two."),
        ("<p title = 'a > b' class=\"c\"data-x=a\"b>One</p><p a=>Two</p><p =b>Three</p><br/><p/>Four", "One Two Three Four"),
        ("<p title='a hidden thing'>One</p><p hidden>no</p><p HIDDEN=''>no</p><div title=it's class='sidebar'>no</div><p>Two", "One Two"),
    ],
)
def test_quotes_in_tags(page, want):
    assert html.main_text(page) == want


def test_captions_stay_in_an_article():
    assert html.main_text("<article><p>Text.</p><figure><img src=x><figcaption>A caption.</figcaption></figure></article>") == "Text. A caption."


BODY = "".join(f"<p>{LONG_PARAGRAPH}</p>" for _ in range(3))
BODY_TEXT = " ".join([LONG_PARAGRAPH] * 3)


@pytest.mark.parametrize(
    "page",
    [
        "<div class='wrap has-sidebar'>{}</div>",
        "<div class='layout no-banner'>{}<div class='sidebar'><p>Aside.</p></div></div>",
        "<div class='entry post comments-open'>{}<div class='comments'><p>%s</p></div></div>" % ("A reader wrote this. " * 400),
        "<div class='post share'>{}</div><div class='comments-area'><p>A reader.</p></div>",
        "<main><section class='with-sidebar'>{}</section></main>",
        "<form action='x'><input name='a'><label>Name</label>{}<button>Send</button></form>",
        "<body><div role='form'>{}</div><form><p>Search here</p></form></body>",
        "<article>{}<article><p>A reader says hi.</p></article></article>",
        "<article>{}</article><article class='comment'><p>A reader says hi.</p></article>",
    ],
)
def test_a_name_does_not_take_the_article_away(page):
    assert html.main_text(page.format(BODY)) == BODY_TEXT


def test_a_page_of_unlikely_parts_only_is_not_empty():
    assert html.main_text("<div class='comments'><p>All there is.</p></div>") == "All there is."


@pytest.mark.parametrize(
    "piece",
    ["<a ", "<a x='", '<a x="', "<", "<!", "</script", "<script></script", "<div>", "<div>x, y", "<p>a <a href=x>b</a> c", "<article>", "<li>x", "<b><p>y"],
)
def test_extraction_takes_linear_time(piece):
    html.main_text(piece * (400_000 // len(piece)))
    nested = "<i><div>" + "<b>" * 40_000 + "</i>" * 40_000 + "<p>x</p>" * 10_000
    start = time.perf_counter()
    html.main_text(piece * (400_000 // len(piece)) + nested)
    assert time.perf_counter() - start < 20



def test_extraction_equals_the_articles_own_text(spark):
    import html as references

    got = {r["page_id"]: r for r in queries.op1_html_extraction(spark, FOLDER).collect()}
    for r in queries.table(spark, FOLDER, "pages").collect():
        article = r["html"][r["html"].index("<article>") + 9 : r["html"].index("</article>")]
        parts = (" ".join(references.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:h1|p|br)>", article))
        want = " ".join(p for p in parts if p)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]


def test_extraction_of_odd_rows(spark):
    pages = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>x", 1), (1, "u", "<p>x", 1)], "page_id long, url string, html string, n_chars int")
    assert sorted((r["text"], r["n_chars"]) for r in html.extract(pages).collect()) == [("", 0), ("x", 1), ("x", 1)]
    assert html.extract(pages.limit(0)).count() == 0


# 7: quality rules


def test_rules_equal_brute_force(spark):
    labels = spark.createDataFrame([(7, 1, 0), (5, 0, 0), (None, 1, 1), (8, 1, None)], "doc_id long, quality int, toxic int")
    dice = random.Random(7)
    rows = ODD + [(50 + i, "\n".join(" ".join(dice.choice("aa bb cc # d|d".split()) for _ in range(9)) for _ in range(dice.randrange(12)))) for i in range(25)]
    got = rules.judge(documents(spark, rows), labels, buckets=64).collect()
    buckets, signed = 64, lambda x: x - (1 << 64) if x >> 63 else x
    single = lambda w: xxhash.xxh64_intdigest(w.encode(), 42)
    features = []
    for _, t in rows:
        hashes = [single(w) for w in words(t)]
        pairs = [xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42)) for a, b in zip(hashes, hashes[1:], strict=False)]
        features.append([signed(h) % buckets for h in hashes + pairs])
    raw = collections.Counter(f for own in features for f in own)
    target = collections.Counter(f for (i, _), own in zip(rows, features, strict=True) if i in (7, 8) for f in own)
    part = lambda c, f: (c[f] + 1) / (sum(c.values()) + buckets)
    ratio = {f: round(np.log(part(target, f) / part(raw, f)) * 1e6) for f in raw}
    want = []
    for (i, t), own in zip(rows, features, strict=True):
        w, t = words(t), t or ""
        grams = list(zip(w, w[1:], w[2:], strict=False))
        often = collections.Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        kept = not failed and sum(ratio[f] for f in own) >= -100_000 * len(own)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed, kept))
    assert sorted((tuple(r)[:8] for r in got), key=repr) == sorted(want, key=repr)
    assert rules.judge(documents(spark, []), labels).count() == 0
    assert rules.judge(documents(spark, ODD), labels.limit(0)).where("NOT base_failed AND NOT kept").count() == 0


def test_rules_separate_labelled_documents(spark):
    got = queries.op7_quality_rules(spark, FOLDER).join(queries.table(spark, FOLDER, "labels"), "doc_id").where("NOT base_failed")
    wrong = got.where("kept != (quality = 1)").count()
    assert wrong <= 0.02 * got.count()


@pytest.mark.parametrize("query", [queries.op4_chat_formatting, queries.op7_quality_rules])
def test_native_plans_have_no_python(spark, query):
    plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 4: chat formatting


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", None, "odd\nrole<"]), st.one_of(st.none(), st.text(alphabet="\\elbn<[|>s/]im_sep end\n\U0001f600é", max_size=30))), min_size=1, max_size=8))
def test_conversations_read_back(spark, said):
    said = [*said, ("assistant", "<|im_end|>\n<|im_start|>"), ("assistant", "</s>[INST] \\e\\l")]
    rows = spark.createDataFrame([(1, i, r, t, "clash") for i, (r, t) in enumerate(said)], "conv_id long, turn long, role string, text string, formatted string")
    got = chat.format_conversations(rows).select("formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss")).first()
    assert [tuple(t) for t in got["t"]] == [(r or "", t or "") for r, t in said]
    assert got["loss"] == "".join(t or "" for r, t in said if r == "assistant")
    assert got["formatted"].count(chat.CLOSE) == 1 + sum(a[0] != b[0] and (a[0] or "") != (b[0] or "") for a, b in zip(said, said[1:], strict=False))


def test_a_long_conversation_takes_linear_time(spark):
    said = [(1, i, "user" if i % 3 == 0 else "assistant", f"<t{i}> é" if i % 5 else "") for i in range(60_000)]
    said += [(2, i, "assistant", str(i)) for i in range(3000)]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").repartition(4)
    start = time.perf_counter()
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    assert time.perf_counter() - start < 60
    for conv in (1, 2):
        mine = [(r, t) for c, _, r, t in said if c == conv]
        learned = "".join(t for r, t in mine if r == "assistant")
        assert got[conv]["n_turns"] == len(mine)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_chat_of_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, 1, "user", "a"), (1, None, "user", "first"), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, 0, "assistant", None)]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {None: 1, 1: 3, 2: 1}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\nfirst\nuser\nx\nuser\nx\n").hexdigest()
    assert got[2]["loss_chars"] == 0 and got[2]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], schema))).count() == 0
