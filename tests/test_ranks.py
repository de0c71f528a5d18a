"""Cuts by counts against sorting: hot tickers, single instants, ties, shares."""

import random
from math import ceil

import pytest
from pyspark.sql import functions as F

from tickloom.operators import clean, ranks, split

SCHEMA = "ticker string, seq long, price double, volume long, at long"


def ticks(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("ticker", F.timestamp_micros("at").alias("event_time"), "seq", "price", "volume")


def made(seed=1):
    dice, rows = random.Random(seed), []
    for ticker, n, spread in (("HOT", 900, 10**15), ("INSTANT", 500, 1), ("FEW", 7, 10**9), ("TWO", 400, 2)):
        rows += [(ticker, i, 1.0 * i, i, dice.randrange(spread)) for i in range(n)]
    rows += [("SAME", 5, 1.0, 1, 77)] * 60
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("slices", [2, 1024])
@pytest.mark.parametrize("tail_rows", [1, 50, 10**9])
def test_the_last_rows_are_the_same_at_every_size(spark, monkeypatch, slices, tail_rows):
    monkeypatch.setattr(ranks, "SLICES", slices)
    rows = made()
    got = clean.last_n(ticks(spark, rows).repartition(5), 12, tail_rows=tail_rows).collect()
    for ticker in {r[0] for r in rows}:
        want = sorted((r[4], r[1]) for r in rows if r[0] == ticker)[-12:]
        mine = sorted((round(r.event_time.timestamp() * 1e6), r.seq) for r in got if r.ticker == ticker)
        assert mine == want, ticker


def test_what_is_left_to_rank_is_bounded(spark):
    kept = clean.from_cut(ticks(spark, made()), 12, 50).groupBy("ticker").count()
    counts = {r["ticker"]: r["count"] for r in kept.collect()}
    # Rows of one value cannot be told apart.
    assert counts.pop("SAME") == 60 and counts.pop("FEW") == 7
    assert all(12 <= n <= 62 for n in counts.values()), counts


def test_rows_without_a_place_are_left_out(spark):
    df = ticks(spark, [("A", 1, 1.0, 1, 5), (None, 2, 1.0, 1, 5), ("A", 3, 1.0, 1, None)])
    assert [r.seq for r in clean.last_n(df, 3, tail_rows=1).collect()] == [1]
    assert clean.last_n(df.limit(0), 3, tail_rows=0).isEmpty()


@pytest.mark.parametrize("share", [0.2, 0.5, 1.0])
def test_a_share_is_exact_and_does_not_depend_on_partitions(spark, share):
    rows = [r for r in made() if r[0] != "SAME"]
    df = ticks(spark, rows)
    results = []
    for parts in (df.repartition(7), df.coalesce(1)):
        got = split.share_split(parts, share).collect()
        assert len(got) == len(rows)
        results.append({(r.ticker, r.seq) for r in got if r.is_test})
    assert results[0] == results[1]
    for ticker in {r[0] for r in rows}:
        n = sum(r[0] == ticker for r in rows)
        assert sum(t == ticker for t, _ in results[0]) == ceil(share * n)
