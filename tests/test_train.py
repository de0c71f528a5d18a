import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tickloom import session
from tickloom.operators import clean, ensemble, regress, scoring, split
from tickloom.operators.evaluate import evaluate
from tickloom.operators.features import TRAINING, features
from tickloom.plans import serve, train
from tickloom.schema import FEATURES
from tickloom.sources import lake


@pytest.fixture(scope="module")
def rows(spark):
    """Feature rows of two tickers, and of one too short to train.

    Prices drift back to 150: trees and waves cannot follow a trend beyond the
    prices they were trained on.
    """
    draw, ticks = random.Random(5), []
    for ticker, n in (("AAPL", 160), ("TSLA", 120), ("TINY", 12)):
        price = 150.0
        for i in range(n):
            price += draw.gauss(0, 1) - 0.2 * (price - 150)
            ticks.append((ticker, i, round(price, 2), draw.randrange(100, 1000)))
    df = spark.createDataFrame(ticks, "ticker string, seq long, price double, volume long")
    time = F.timestamp_seconds(F.col("seq") * 60)
    return features(df.withColumn("event_time", time), TRAINING).cache()


def arrays(rows, ticker, inputs):
    data = rows.where(F.col("ticker") == ticker).orderBy("seq").collect()
    return np.array([[float(r[c]) for c in inputs] for r in data]), np.array([r.target for r in data])


def test_linear_fit_equals_least_squares(rows):
    fitted = regress.fit_linear(rows)
    scored = regress.score_linear(rows, fitted)
    for ticker in ("AAPL", "TSLA", "TINY"):
        x, y = arrays(rows, ticker, FEATURES)
        ones = np.column_stack([x, np.ones(len(x))])
        want = ones @ np.linalg.lstsq(ones, y, rcond=None)[0]
        mine = scored.where(F.col("ticker") == ticker).orderBy("seq").collect()
        assert np.allclose([r.prediction for r in mine], want, atol=1e-4)


def test_ridge_equals_its_closed_form_and_spark_ml(rows):
    inputs, alpha = ["MA5", "MA20", "lag1"], 3.0
    fitted = {r.ticker: r for r in regress.fit_linear(rows, inputs, ridge=alpha).collect()}
    for ticker in ("AAPL", "TSLA"):
        x, y = arrays(rows, ticker, inputs)
        centered = x - x.mean(0)
        want = np.linalg.solve(centered.T @ centered + alpha * np.eye(3), centered.T @ (y - y.mean()))
        assert np.allclose(fitted[ticker].weights, want, atol=1e-8)
        assert np.isclose(fitted[ticker].intercept, y.mean() - want @ x.mean(0))
        part = rows.where(F.col("ticker") == ticker)
        vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(part)
        line = LinearRegression(
            labelCol="target",
            solver="normal",
            standardization=False,
            regParam=alpha * float(y.std()) / len(y),
        ).fit(vectors)
        assert np.allclose(line.coefficients.toArray(), want, atol=1e-6)


def test_one_feature_equals_the_regression_aggregates(rows):
    got = {r.ticker: r for r in regress.ols_one_feature(rows, "price").collect()}
    for row in regress.fit_linear(rows, ["price"]).collect():
        assert np.isclose(row.weights[0], got[row.ticker].slope)
        assert np.isclose(row.intercept, got[row.ticker].intercept)


def test_rows_that_are_no_numbers_are_left_out(spark):
    data = [(1.0, 1.0), (None, 1.0), (float("nan"), 1.0), (float("inf"), 1.0)]
    df = spark.createDataFrame(data, "a double, b double")
    assert regress.usable(df, ["a", "b"]).count() == 1


@pytest.fixture(scope="module")
def trained(rows, tmp_path_factory):
    models = ["Linear Regression", "Random Forest", "RBF Features", "Broken"]
    regress.ESTIMATORS["Broken"] = lambda: None
    folder = str(tmp_path_factory.mktemp("run"))
    try:
        yield train.train_models(rows, folder, models, at_least=10)
    finally:
        regress.ESTIMATORS.pop("Broken", None)


def test_registry_tells_what_happened(trained):
    status = {(r.ticker, r.model): r.status.split(":")[0] for r in trained.registry().collect()}
    good = ["Linear Regression", "Random Forest", "RBF Features"]
    assert status == {
        **{(t, m): "ok" for t in ("AAPL", "TSLA") for m in good},
        **{(t, "Broken"): "failed" for t in ("AAPL", "TSLA")},
        **{("TINY", m): "skipped" for m in [*good, "Broken"]},
    }


def test_models_come_near_the_persistence_forecast(trained, rows):
    test = split.tail_split(rows).where("is_test").withColumn("prediction", F.col("price"))
    naive = {r.ticker: r.mae for r in evaluate(test.withColumn("model", F.lit("naive"))).collect()}
    for row in trained.metrics().collect():
        limit = 1.5 if row.model == "Linear Regression" else 8
        assert row.mae < limit * naive[row.ticker], row
        assert row.accuracy > 90


def test_spark_ml_and_aggregate_fits_agree(trained, rows):
    parts = split.tail_split(rows)
    fitted = regress.fit_linear(parts.where("not is_test"))
    scored = regress.score_linear(parts.where("is_test"), fitted).withColumn("model", F.lit("x"))
    want = {r.ticker: r.mae for r in evaluate(scored).collect()}
    for row in trained.metrics().where("model = 'Linear Regression'").collect():
        assert row.mae == pytest.approx(want[row.ticker], rel=1e-3)


def requests_of(rows, *models):
    latest = clean.last_n(rows, 1).where("ticker = 'AAPL'").select(F.lower("ticker").alias("ticker"), *FEATURES)
    return latest.withColumn("model", F.explode(F.array(*(F.lit(m).cast("string") for m in models))))


def test_saved_models_answer_requests(spark, trained, rows):
    asked = requests_of(rows, "Random Forest", "SVR", "Nobody", None, " ")
    plain = asked.where("model = 'Random Forest'")
    odd = [
        plain.withColumn("lag2", F.lit(None).cast("double")),
        plain.withColumn("lag2", F.lit(float("nan"))),
        plain.withColumn("ticker", F.lit(None).cast("string")),
    ]
    for more in odd:
        asked = asked.unionByName(more)
    got = scoring.predict(asked, trained.models()).collect()
    assert sorted((r.model, r.status, r.prediction is not None) for r in got) == [
        ("Nobody", "not found", False),
        ("Random Forest", "invalid", False),
        ("Random Forest", "invalid", False),
        ("Random Forest", "not found", False),
        ("Random Forest", "ok", True),
        ("SVR", "ok", True),
        ("Stacking Ensemble", "not found", False),
        ("Stacking Ensemble", "not found", False),
    ]
    none = scoring.predict(asked, trained.models().limit(0))
    assert [r.status for r in none.collect()] == ["no models"] * 8
    banded = serve.with_band(scoring.predict(plain, trained.models())).first()
    assert banded.confidence_lower < banded.predicted_price < banded.confidence_upper


def test_model_rows_predict_as_the_fitted_models_do(spark, trained, rows):
    direct = trained.predictions()
    test = direct.select("ticker", "event_time", "seq", "model", F.col("prediction").alias("want"))
    asked = regress.usable(rows).join(test, ["ticker", "event_time", "seq"])
    got = scoring.predict(asked, trained.models())
    assert got.count() == test.count() > 0
    assert got.where("abs(prediction - want) > 1e-6 OR prediction IS NULL").isEmpty()


def test_requests_are_scanned_once_whatever_the_models(trained, rows):
    asked = requests_of(rows, "Random Forest")
    plans = [scoring.predict(asked, m)._jdf.queryExecution().optimizedPlan().toString() for m in (trained.models(), trained.models().limit(1))]
    assert plans[0].count("Join") == plans[1].count("Join")


def test_importances_are_ranked(spark, trained):
    ranked = train.feature_importance(trained.importances()).collect()
    assert len(ranked) == 2 * len(FEATURES)
    for ticker in ("AAPL", "TSLA"):
        mine = [r.importance for r in ranked if r.ticker == ticker]
        assert mine == sorted(mine, reverse=True)
        assert sum(mine) == pytest.approx(1, abs=0.001)


def test_ensembles(rows, tmp_path):
    bases = ["Linear Regression", "RBF Features"]
    # A folder named like one of the run's own.
    run = train.train_ensembles(rows, str(tmp_path / "models" / "run"), bases, at_least=13)
    got = run.metrics().collect()
    status = {(r.ticker, r.model): r.status.split(":")[0] for r in run.registry().collect()}
    assert status == {(t, m): "skipped" if t == "TINY" else "ok" for t in ("AAPL", "TSLA", "TINY") for m in (*bases, *train.ENSEMBLES)}
    asked = requests_of(rows, *train.ENSEMBLES, None)
    assert [r.status for r in scoring.predict(asked, run.models()).collect()] == ["ok"] * 3
    test = run.predictions().select("ticker", "event_time", "seq", "model", F.col("prediction").alias("want"))
    saved = scoring.predict(regress.usable(rows).join(test, ["ticker", "event_time", "seq"]), run.models())
    assert saved.where("abs(prediction - want) > 1e-6 OR prediction IS NULL").isEmpty()
    names = {*bases, "Voting Ensemble", "Stacking Ensemble"}
    assert {(r.ticker, r.model) for r in got} == {(t, m) for t in ("AAPL", "TSLA") for m in names}
    assert all(r.accuracy > 90 for r in got)
    wide = run.predictions().groupBy("ticker", "seq").pivot("model").agg(F.first("prediction"))
    for row in wide.collect():
        mean = (row["Linear Regression"] + row["RBF Features"]) / 2
        assert row["Voting Ensemble"] == pytest.approx(mean)


def test_runs_without_a_ticker_that_can_be_trained_are_empty(spark, rows, tmp_path):
    for job, bases in ((train.train_models, ["Linear Regression"]), (train.train_ensembles, ["Linear Regression"])):
        run = job(rows, str(tmp_path / job.__name__), bases, at_least=10_000)
        assert run.metrics().isEmpty() and run.models().isEmpty() and run.predictions().isEmpty()
        assert {r.status for r in run.registry().collect()} == {"skipped: too few rows"}


def test_a_failing_base_leaves_the_others(spark, rows, tmp_path):
    regress.ESTIMATORS["Broken"] = lambda: None
    try:
        run = train.train_ensembles(rows, str(tmp_path / "run"), ["Linear Regression", "Broken"], folds=2)
    finally:
        regress.ESTIMATORS.pop("Broken", None)
    status = {r.status.split(":")[0] for r in run.registry().where("model = 'Stacking Ensemble'").collect()}
    assert status == {"skipped"}
    assert {r.model for r in run.metrics().collect()} == {"Linear Regression"}


def test_a_ticker_shorter_than_the_folds_is_skipped(spark, rows, tmp_path):
    few = rows.where("ticker != 'TINY' OR seq < 3")
    run = train.train_ensembles(few, str(tmp_path / "run"), ["Linear Regression"], at_least=1)
    assert {r.ticker for r in run.metrics().collect()} == {"AAPL", "TSLA"}


def test_stacking_is_ridge_over_base_predictions(spark):
    draw = np.random.default_rng(0)
    x = draw.normal(50, 5, (60, 2))
    y = x @ [0.7, 0.3] + draw.normal(0, 1, 60)
    data = [("A", *map(float, row), float(t)) for row, t in zip(x, y)]
    df = spark.createDataFrame(data, "ticker string, base0 double, base1 double, target double")
    got = ensemble.stack(df, df, ["base0", "base1"], ridge=1.0).collect()
    centered = x - x.mean(0)
    w = np.linalg.solve(centered.T @ centered + np.eye(2), centered.T @ (y - y.mean()))
    want = y.mean() + centered @ w
    assert np.allclose(sorted(r.prediction for r in got), sorted(want), atol=1e-8)


def test_retrain_from_a_lake(spark, tmp_path):
    draw, price, ticks = random.Random(8), 100.0, []
    for i in range(90):
        price += draw.gauss(0, 1) - 0.2 * (price - 100)
        ticks.append((i, price, i + 1, "AAPL"))
    df = spark.createDataFrame(ticks, "seq long, price double, volume long, ticker string")
    time = F.timestamp_seconds(F.col("seq") * 300)
    df = df.select(time.cast("string").alias("timestamp"), time.alias("event_time"), "*")
    path, bases = str(tmp_path / "lake"), ["Linear Regression"]
    assert train.retrain(spark, path, str(tmp_path / "none"), bases=bases) is None
    lake.write(df, path)
    run = train.retrain(spark, path, str(tmp_path / "run"), bases=bases)
    assert {r.model for r in run.metrics().collect()} == {
        "Linear Regression",
        "Voting Ensemble",
        "Stacking Ensemble",
    }
    published = serve.metrics_lookup(spark, str(tmp_path / "run" / "metrics"), "aapl").collect()
    assert len(published) == 3 and all(r.accuracy.endswith("%") for r in published)


def test_records(spark):
    df = spark.createDataFrame([("A", 1.5)], "ticker string, price double")
    assert [r.record for r in serve.records(df).collect()] == ['{"ticker":"A","price":1.5}']


def test_a_tickers_rows_are_shared_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(train, "ROWS_PER_SHARE", 100)
    names = ", ".join(f"double((id * {7 + i}) % 31) {f}" for i, f in enumerate(FEATURES))
    rows = spark.range(450).coalesce(1).selectExpr("'A' ticker", "timestamp_seconds(id) event_time", "id seq", *names.split(", "), "double(id % 13) target", "id >= 400 is_test")
    run = train._Run(spark, str(tmp_path / "run"), rows, 1)
    assert len(run.data.where("ticker = 'A'").inputFiles()) == 5
    assert run.data.count() == 450


def test_model_tables_are_read_a_few_rows_at_a_time(spark, tmp_path):
    """A reader decodes a row group of nested columns as a whole."""
    nodes = "transform(sequence(0, 59), i -> struct(cast(pmod(i, 12) as int) feature, cast(xxhash64(id, t, i) as double) threshold, cast(i as int) `left`, cast(i as int) `right`, cast(xxhash64(i, t, id) as double) value))"
    trees = f"transform(sequence(0, 49), t -> struct(0.1D weight, {nodes} nodes))"
    member = f"struct('trees' kind, 0D intercept, cast(null as array<double>) weights, cast(null as array<array<double>>) waves, {trees} trees)"
    members = spark.range(700, numPartitions=1).selectExpr("cast(id as string) ticker", "'Boosted Trees' model", f"{member} member")
    kept = session.stored(members, "fitted", options=session.MODEL_ROWS)
    out = train._Out(spark, str(tmp_path / "run"))
    out.models(scoring.plain_models(kept))
    # A row has 3,000 nodes.
    for path in kept.inputFiles() + train.Trained(spark, out.folder).models().inputFiles():
        groups = pq.ParquetFile(path.removeprefix("file://")).metadata
        assert max(groups.row_group(i).num_rows for i in range(groups.num_row_groups)) <= 300
    assert kept.count() == 700
