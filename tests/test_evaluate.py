import math
from math import ceil

import pytest
from pyspark.sql import functions as F

from tickloom.operators import ensemble, evaluate, split
from tickloom.plans import serve
from tickloom.sources import metrics


def series_of(make_ticks, *sizes):
    return make_ticks(
        [(f"T{n:02}", float(i), i, 1.0 + i, 1) for n in sizes for i in range(n)]
    )


@pytest.mark.parametrize("max_rows", [4, 1000])
def test_tail_split(make_ticks, max_rows):
    sizes = (1, 4, 10, 11, 23, 35)
    got = split.tail_split(series_of(make_ticks, *sizes), max_rows=max_rows).collect()
    for n in sizes:
        test = sorted(r.seq for r in got if r.ticker == f"T{n:02}" and r.is_test)
        assert test == list(range(n - ceil(0.2 * n), n))


def test_folds_are_contiguous_and_even(make_ticks):
    sizes = (5, 10, 11, 23)
    got = split.fold_ids(series_of(make_ticks, *sizes)).collect()
    for n in sizes:
        folds = [r.fold for r in sorted(got, key=lambda r: r.seq) if r.ticker == f"T{n:02}"]
        want = [f for f in range(5) for _ in range(n // 5 + (f < n % 5))]
        assert folds == want


def test_too_few_rows_to_fold(make_ticks):
    with pytest.raises(Exception, match="too few rows to fold"):
        split.fold_ids(series_of(make_ticks, 4)).collect()


def test_hash_split_is_repeatable_and_near_its_share(make_ticks):
    ticks = series_of(make_ticks, 99, 98, 97, 96, 95, 94, 93, 92, 91, 90)
    first = {(r.ticker, r.seq, r.is_test) for r in split.hash_split(ticks).collect()}
    again = {(r.ticker, r.seq, r.is_test) for r in split.hash_split(ticks.repartition(7)).collect()}
    assert first == again
    assert 0.15 < sum(t for *_, t in first) / len(first) < 0.25


def test_random_split_keeps_every_row(make_ticks):
    train, test = split.random_split(series_of(make_ticks, 50))
    assert train.count() + test.count() == 50


def test_metrics_of_long_predictions(spark):
    rows = [("A", "m", 10.0, 12.0), ("A", "m", 20.0, 16.0), ("A", "z", 0.0, 0.25)]
    rows += [("B", "m", 1.0, 50.0), ("C", "m", 5.0, math.nan)]
    df = spark.createDataFrame(rows, "ticker string, model string, target double, prediction double")
    got = {(r.ticker, r.model): r for r in evaluate.evaluate(df).collect()}
    assert got["A", "m"].mae == 3.0
    assert got["A", "m"].rmse == pytest.approx(math.sqrt(10))
    assert got["A", "m"].accuracy == pytest.approx(80.0)
    assert got["A", "z"].accuracy == pytest.approx(75.0)  # a mean of 0 counts as 1
    assert got["B", "m"].accuracy == 0.0
    assert got["C", "m"].accuracy == 0.0


def test_long_predictions_need_no_shuffle(spark):
    df = spark.range(5).select(F.lit("A").alias("ticker"), F.col("id").cast("double").alias("x"))
    made = evaluate.long_predictions(df, {"one": F.col("x"), "two": F.col("x") * 2}, "ticker")
    assert made.count() == 10
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()


def test_leaderboard_compares_numbers(spark):
    rows = [("A", "x", "99.90%"), ("A", "y", "99.9%"), ("A", "z", "N/A"), ("B", "x", "50.00%")]
    rows += [("B", "Voting Ensemble", "40.00%")]
    published = spark.createDataFrame(rows, "ticker string, model string, accuracy string")
    parsed = evaluate.parse_metrics(published)
    board = {(r.ticker, r.model): (r.is_best, r.is_good) for r in evaluate.leaderboard(parsed).collect()}
    assert board == {
        ("A", "x"): (True, True),
        ("A", "y"): (True, True),
        ("A", "z"): (False, False),
        ("B", "x"): (True, False),
        ("B", "Voting Ensemble"): (False, False),
    }
    assert {(r.ticker, r.model) for r in evaluate.best_model(parsed).collect()} == {
        ("A", "y"),
        ("B", "x"),
    }
    counts = {r.ticker: r.base_models for r in evaluate.base_model_count(parsed).collect()}
    assert counts == {"A": 3, "B": 1}


def test_weights_are_taken_as_they_are(spark):
    df = spark.range(1).select(F.lit(10.0).alias("a"), F.lit(20.0).alias("b"))
    both = [F.col("a"), F.col("b")]
    assert df.select(ensemble.weighted(both, [0.5, 1.0])).first()[0] == 25.0
    assert df.select(ensemble.voting(both)).first()[0] == 15.0
    with pytest.raises(ValueError):
        ensemble.weighted(both, [1.0])


def published(spark):
    rows = [("QRST", "SVR", "71.25%"), ("QRST", "XGBoost", "64.50%"), ("UVWX", "SVR", "1.00%")]
    return spark.createDataFrame(rows, "ticker string, model string, accuracy string")


def test_metrics_lookup_in_json_lines(spark, tmp_path):
    path = str(tmp_path / "metrics")
    before = serve.metrics_lookup(spark, path, "qrst").collect()
    assert len(before) == 6 and {r.accuracy for r in before} == {"N/A"}
    assert {r.ticker for r in before} == {"QRST"}
    metrics.write_metrics(published(spark), path)
    got = {(r.ticker, r.model, r.accuracy) for r in serve.metrics_lookup(spark, path, "qrst").collect()}
    assert got == {("QRST", "SVR", "71.25%"), ("QRST", "XGBoost", "64.50%")}
    assert serve.metrics_lookup(spark, path, "INFY").collect() == []


def test_metrics_lookup_in_a_nested_document(spark, tmp_path):
    path = tmp_path / "metrics.json"
    path.write_text('{\n "QRST": {"SVR": "71.25%", "XGBoost": "64.50%"},\n "UVWX": {"SVR": "1.00%"}\n}')
    read = metrics.read_metrics_document(spark, str(path))
    assert {tuple(r) for r in read.collect()} == {tuple(r) for r in published(spark).collect()}
    got = serve.metrics_lookup(spark, str(path), "uvwx").collect()
    assert [tuple(r) for r in got] == [("UVWX", "SVR", "1.00%")]
    path.write_text("{ not json")
    got = serve.metrics_lookup(spark, str(path), "uvwx").collect()
    assert [tuple(r) for r in got] == [("UVWX", None, "error")]


def test_metrics_of_many_tickers(spark):
    asked = spark.createDataFrame([("qrst",), ("infy",), ("QRST",)], "ticker string")
    got = serve.metrics_of(published(spark), asked).collect()
    assert sorted(r.ticker for r in got) == ["INFY"] * 6 + ["QRST"] * 2


def test_band_and_direction(spark):
    rows = [("Random Forest", 100.0), ("Voting Ensemble", 100.0), ("SVR", None)]
    df = spark.createDataFrame(rows, "model string, prediction double")
    got = {r.model: tuple(r)[2:] for r in serve.with_band(df).collect()}
    assert got == {
        "Random Forest": (100.0, 98.0, 102.0),
        "Voting Ensemble": (100.0, 99.0, 101.0),
        "SVR": (None, None, None),
    }
    up = serve.direction(F.col("prediction"), F.lit(100.0))
    assert {r[0] for r in df.select(up).collect()} == {"DOWN"}
    assert df.select(serve.direction(F.lit(2.0), F.lit(1.0))).first()[0] == "UP"


def test_market_state_at_exactly_15_minutes(spark, make_ticks):
    ticks = make_ticks([("A", 0.0, 1, 1.0, 1)])  # 09:30
    asked = spark.createDataFrame([("A",), ("NONE",)], "ticker string")
    for as_of, want in (("09:45:00", "OPEN"), ("09:45:00.001", "CLOSED")):
        states = serve.market_state_of(ticks, asked, f"2026-05-01 {as_of}").collect()
        assert {r.ticker: r.state for r in states} == {"A": want, "NONE": "OPEN"}
