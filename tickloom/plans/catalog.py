"""The registered queries, each over whole tables of a data folder.

``events`` are the ticks of most queries (a series per event type, or per user
where many series are wanted), ``orders`` the bars, ``lineitem`` the keys.
Expected values come from ``oracle.py``; models have none.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar
from ..operators import clean, ensemble, evaluate, features, frequency, regress, scoring, series, split
from ..operators.features import SERVING, TRAINING
from ..schema import FEATURES, MESSAGE_SCHEMA
from ..session import durable, stored, work_path
from ..sources import kafka, lake, metrics
from ..streaming import ingest, sinks
from . import feature_table as feature_tables
from . import serve, train

# Rows from which the chunked form of the features cuts a series in the test data.
SMALL_CELL = 500

AS_OF = "2024-01-31 00:00:00"

# Rows of a file that a query writes as its input, so that the files follow the data.
ROWS_PER_INPUT = 250_000

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ticks(spark: SparkSession, folder: str, ticker: str = "event_type") -> DataFrame:
    """Events as ticks."""
    props = F.from_json("props", "k long")
    return table(spark, folder, "events").select(
        F.col(ticker).cast("string").alias("ticker"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        props["k"].alias("volume"),
    )


def _r(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison."""
    doubles = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.select(*(_r(c, digits) if c in doubles else F.col(c) for c in df.columns))


# Windows


def features_p(spark, folder):
    return rounded(features.features(ticks(spark, folder), SERVING))


def features_s(spark, folder):
    return rounded(features.features(ticks(spark, folder), TRAINING))


def features_chunked(spark, folder):
    return rounded(features.features(ticks(spark, folder), SERVING, max_rows=SMALL_CELL))


def features_s_chunked(spark, folder):
    return rounded(features.features(ticks(spark, folder), TRAINING, max_rows=SMALL_CELL))


def features_many_tickers(spark, folder):
    return rounded(features.features(ticks(spark, folder, "user_id"), SERVING))


def _windowed(
    spark, folder, make: Callable[[WindowSpec], dict[str, Column]], back: int, ahead: int = 0
) -> DataFrame:
    """Tick key and window columns that look ``back`` and ``ahead`` so many rows."""

    def compute(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.select("*", *(c.alias(name) for name, c in make(window).items()))

    rows = ticks(spark, folder)
    made = series.by_series(rows, compute, back, ahead)
    return rounded(made.drop(*(c for c in rows.columns if c not in ("ticker", "seq"))))


def lags(spark, folder):
    return _windowed(
        spark, folder, lambda w: {f"lag{k}": features.lag_price(k, w) for k in (1, 2, 3)}, 3
    )


def lead_target(spark, folder):
    return _windowed(
        spark, folder, lambda w: {f"target_{k}": features.target_price(k, w) for k in (1, 5)}, 0, 5
    )


def _means(full: bool) -> Callable[[WindowSpec], dict[str, Column]]:
    return lambda w: {f"MA{n}": features.rolling(F.avg, n, w, full) for n in (5, 10, 20)}


def ma_full(spark, folder):
    return _windowed(spark, folder, _means(True), 19)


def ma_partial(spark, folder):
    return _windowed(spark, folder, _means(False), 19)


def rolling_std(spark, folder):
    return _windowed(
        spark,
        folder,
        lambda w: {
            "std_5_full": features.rolling(F.stddev_samp, 5, w, True),
            "std_20_partial": features.rolling(F.stddev_samp, 20, w, False),
        },
        19,
    )


def price_change(spark, folder):
    return _windowed(
        spark,
        folder,
        lambda w: {"price_change": F.col("price") - features.lag_price(1, w)},
        1,
    )


def pct_change(spark, folder):
    def compute(rows: DataFrame, window: WindowSpec) -> DataFrame:
        before = rows.withColumn("lag1", features.lag_price(1, window))
        return before.select(
            "*",
            features.relative_change(False).alias("fraction"),
            features.relative_change(True).alias("percent"),
        )

    changed = series.by_series(ticks(spark, folder), compute, 1, 0)
    return rounded(changed.select("ticker", "seq", "fraction", "percent"))


def row_numbers(spark, folder):
    numbered = series.number_rows(ticks(spark, folder), max_rows=SMALL_CELL)
    return numbered.select("ticker", "seq", "row_no", "series_rows")


# Selections


def recent_100(spark, folder):
    return rounded(serve.recent(ticks(spark, folder)))


def recent_20_many_tickers(spark, folder):
    return rounded(serve.recent(ticks(spark, folder, "user_id"), 20))


def last_100_of_ticker(spark, folder):
    return clean.last_of_series(ticks(spark, folder), "purchase", 100)


def last_n_raw(spark, folder):
    return clean.last_n(ticks(spark, folder), 10)


def ticker_scan(spark, folder):
    return clean.one_ticker(ticks(spark, folder), "click")


def partition_scan(spark, folder):
    """Lake written by ticker, one ticker read back from its own directory."""
    path = work_path(spark, "lake")
    _lake_rows(spark, folder).write.partitionBy("ticker").parquet(path)
    return lake.scan_ticker(spark, path, "error").select("ticker", "seq", "price", "volume")


def dedup_first(spark, folder):
    """One tick per ticker and minute: the first of each."""
    by_minute = ticks(spark, folder).withColumn("event_time", F.date_trunc("minute", "event_time"))
    by_minute = by_minute.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    return clean.first_per_time(by_minute)


def _with_gaps(spark, folder) -> DataFrame:
    """Ticks in which low prices and volumes count as missing."""
    return ticks(spark, folder).select(
        "ticker",
        "seq",
        F.when(F.col("price") >= 5, F.col("price")).alias("price"),
        F.when(F.col("volume") > 10, F.col("volume")).alias("volume"),
    )


def dropna_any(spark, folder):
    return features.drop_incomplete(_with_gaps(spark, folder))


def fill_zero(spark, folder):
    return clean.fill_zero(_with_gaps(spark, folder))


def falsy_default(spark, folder):
    base = features.feature_columns(ticks(spark, folder), SERVING)
    return rounded(clean.request_defaults(base).select("ticker", "seq", *FEATURES))


def latest_tick(spark, folder):
    return clean.latest(ticks(spark, folder))


def latest_tick_many_tickers(spark, folder):
    return clean.latest(ticks(spark, folder, "user_id"))


def distinct_tickers(spark, folder):
    return clean.distinct_tickers(ticks(spark, folder, "user_id"))


def tick_count(spark, folder):
    return ticks(spark, folder).agg(F.count("*").alias("n"))


def min_rows_filter(spark, folder):
    return clean.min_rows(ticks(spark, folder, "user_id"), 65)


def historical_bars(spark, folder):
    bars = lake.read_bars(spark, f"{folder}/orders.parquet")
    made = lake.bars_to_ticks(
        bars, "o_orderpriority", "o_orderdate", "o_totalprice", "o_custkey", "o_orderkey"
    )
    # These prices are 1000 times those of the events.
    return rounded(features.features(made, SERVING), 4)


def csv_bars(spark, folder):
    """The same bars, written as CSV and read back with their schema."""
    path = work_path(spark, "csv")
    columns = ["o_orderpriority", "o_orderdate", "o_totalprice", "o_custkey", "o_orderkey"]
    table(spark, folder, "orders").select(*columns).write.option("header", "true").csv(path)
    schema = "o_orderpriority string, o_orderdate timestamp_ntz, o_totalprice double, o_custkey long, o_orderkey long"
    return lake.bars_to_ticks(lake.read_bars(spark, path, "csv", schema, header="true"), *columns)


# Messages


def json_payload(spark, folder):
    return kafka.to_messages(ticks(spark, folder))


def _envelopes(spark, folder) -> DataFrame:
    """Ticks as the message source delivers them; the tick's number is the offset."""
    rows = ticks(spark, folder)
    named = rows.withColumn("row_topic", scalar.topic_of(F.col("ticker"), "stock_"))
    body = F.struct(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        *MESSAGE_SCHEMA.names[1:],
    )
    return named.select(
        F.encode(F.to_json(body), "UTF-8").alias("value"),
        F.col("row_topic").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
    )


def _zoneless(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def json_parse(spark, folder):
    parsed = ingest.parse_ticks(_envelopes(spark, folder))
    return _zoneless(parsed).select("ticker", "event_time", "seq", "price", "volume")


def json_rejects(spark, folder):
    """Every second event as a tick's message, the others as their props text: readable JSON, but no tick."""
    events = table(spark, folder, "events")
    tick = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
            F.col("event_type").alias("ticker"),
            F.col("value").alias("price"),
            F.lit(1).alias("volume"),
        )
    )
    body = F.when(F.col("event_id") % 2 == 1, tick).otherwise(F.col("props")).alias("value")
    parsed = ingest.parse_ticks(events.select(body))
    return parsed.agg(
        F.count_if(~ingest.is_reject()).alias("accepted"), F.count_if(ingest.is_reject()).alias("rejected")
    )


def ts_parse(spark, folder):
    """Event times written in four text forms and read back."""
    forms = F.array(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.date_format("event_time", "MM/dd/yyyy HH:mm:ss"),
        F.concat(F.lit("no time: "), F.col("seq").cast("string")),
    )
    text = ticks(spark, folder).select("seq", F.posexplode(forms).alias("form", "text"))
    parsed = scalar.parse_time("text").cast("timestamp_ntz")
    return text.select("seq", F.col("form").cast("long").alias("form"), parsed.alias("event_time"))


def time_labels(spark, folder):
    return ticks(spark, folder).select(
        "seq",
        scalar.clock_label(F.col("event_time")).alias("clock"),
        scalar.day_label(F.col("event_time")).alias("day"),
    )


def model_names(spark, folder):
    """File names of models, one per ticker and kind, taken apart."""
    kinds = F.explode(
        F.array(*(F.lit(k) for k in ("random_forest", "ensemble", "voting_ensemble")))
    )
    files = clean.distinct_tickers(ticks(spark, folder, "user_id")).select("ticker", kinds.alias("k"))
    parts = scalar.split_model_file(F.concat_ws("_", "ticker", "k"))
    return files.select(
        parts["ticker"].alias("ticker"),
        parts["slug"].alias("slug"),
        scalar.display_name(parts["slug"]).alias("model"),
    )


# Stream and lake


def _lake_rows(spark, folder) -> DataFrame:
    return ticks(spark, folder).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_time").cast("timestamp").alias("event_time"),
        "seq",
        "price",
        "volume",
        "ticker",
    )


def stream_ingest(spark, folder):
    """Message files through the stream into the lake, and the lake read back."""
    source, out = work_path(spark, "messages"), work_path(spark, "lake")
    _envelopes(spark, folder).write.parquet(source)
    envelope = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    started = ingest.start_ingest(
        envelope, out, work_path(spark, "offsets"), trigger={"availableNow": True}
    )
    ingest.run_until_stopped(started)
    return _zoneless(lake.scan(spark, out)).select("ticker", "event_time", "seq", "price", "volume")


def lake_compact(spark, folder):
    """A lake of small files rewritten in time order, and read back."""
    small, large = work_path(spark, "lake"), work_path(spark, "compact")
    pieces = max(8, -(-table(spark, folder, "events").count() // ROWS_PER_INPUT))
    lake.write(_lake_rows(spark, folder).repartition(pieces), small)
    lake.compact(lake.scan(spark, small), large)
    return _zoneless(lake.scan(spark, large)).select(
        "ticker", "event_time", "seq", "price", "volume"
    )


def mixed_lake(spark, folder):
    """A lake of which every second tick is in older files, without ``event_time``."""
    path, rows = work_path(spark, "lake"), _lake_rows(spark, folder)
    lake.write(rows.where("seq % 2 = 0").drop("event_time"), path)
    lake.write(rows.where("seq % 2 = 1"), path)
    return _zoneless(lake.scan(spark, path)).select("ticker", "event_time", "seq", "price", "volume")


def publish_round_trip(spark, folder):
    """Ticks published as a stream of messages, and the messages read back."""
    source, out = work_path(spark, "ticks"), work_path(spark, "messages")
    _lake_rows(spark, folder).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = kafka.publish_stream(kafka.to_messages(stream), work_path(spark, "offsets"), trigger={"availableNow": True}, form="parquet", path=out)
    query.awaitTermination()
    messages = spark.read.parquet(out)
    return _zoneless(ingest.parse_ticks(messages)).select("ticker", "event_time", "price", "volume")


def _tables(spark, folder, batches: int = 4) -> str:
    """The tables of ``streaming.sinks`` after all messages, in batches that each hold ticks of all times.

    Two events in 97 also come as a message that is no tick.  A batch has more files where
    it has more messages, since a file without further row groups is read by one task.
    """
    source, root, checkpoint = (work_path(spark, name) for name in ("messages", "tables", "offsets"))
    events = table(spark, folder, "events").where("event_id % 97 < 2")
    broken = events.select(
        F.encode(F.when(F.col("event_id") % 97 == 0, F.col("props")).otherwise(F.concat(F.lit("!"), F.col("props"))), "UTF-8").alias("value"),
        F.lit("stock_none").alias("topic"),
        F.lit(1).alias("partition"),
        F.col("event_id").alias("offset"),
    )
    files = max(1, -(-table(spark, folder, "events").count() // (batches * ROWS_PER_INPUT)))
    _envelopes(spark, folder).unionByName(broken).repartition(batches * files, "offset").write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", files).parquet(source)
    sinks.start(stream, root, checkpoint, {"availableNow": True}).awaitTermination()
    return root


def ingest_tables(spark, folder):
    """Accepted ticks of a stream that feeds several tables."""
    return _zoneless(sinks.ticks(spark, _tables(spark, folder))).select("ticker", "event_time", "seq", "price", "volume")


def ingest_rejects(spark, folder):
    """Its messages that are no tick, as they came, and why."""
    return sinks.rejects(spark, _tables(spark, folder)).select("value", "partition", F.col("offset").alias("place"), "reason")


def day_summary(spark, folder):
    """Its summary by day, after compaction of the small parts."""
    root = _tables(spark, folder)
    sinks.compact(spark, root)
    return sinks.days(spark, root).select("ticker", "day", "n", "last_seq")


def compact_tables(spark, folder):
    """Its ticks after compaction."""
    root = _tables(spark, folder)
    sinks.compact(spark, root)
    return _zoneless(sinks.ticks(spark, root)).select("ticker", "event_time", "seq", "price", "volume")


def recent_by_summary(spark, folder):
    """The last rows of every series, by the summary instead of a count of the lake."""
    root = _tables(spark, folder)
    found = serve.recent(sinks.ticks(spark, root).drop("timestamp"), 20, summary=sinks.days(spark, root))
    return rounded(_zoneless(found))


def feature_table(spark, folder):
    """The feature table after two updates, of which the second brings late ticks of all days."""
    root, rows = work_path(spark, "features"), _tables(spark, folder)
    first = work_path(spark, "tables")
    # The first update sees two batches only.
    versions, some = sinks.Versions(spark, rows), sinks.Versions(spark, first)
    for part in versions.parts()[:2]:
        sinks.write_part(some, versions.read(sinks.TICKS, sinks.LAKE_SCHEMA, [part]).drop("part"), part.name)
        some.change(lambda now, part=part: [*now, part])
    feature_tables.update(spark, first, root)
    feature_tables.update(spark, rows, root)
    return rounded(_zoneless(feature_tables.read(spark, root)))


# Splits and evaluation


def _rows(spark, folder, size: series.Size | None = None) -> DataFrame:
    return features.features(ticks(spark, folder), SERVING, size=size)


def _split_rows(spark, folder) -> DataFrame:
    """Feature rows with ``is_test``, made in one pass over the ticks.

    There are no more feature rows than ticks, so one count serves both steps.
    """
    size = series.size_of(ticks(spark, folder))
    return split.tail_split(_rows(spark, folder, size), size=size)


# Forecasts that are plain columns.
FORECASTS = {
    "persistence": "price",
    "short mean": "MA5",
    "long mean": "MA20",
    "momentum": "price + price_change",
}


def _forecast_columns() -> dict[str, Column]:
    return {name: F.expr(sql) for name, sql in FORECASTS.items()}


def _forecasts(spark, folder) -> DataFrame:
    """Column forecasts and their mean, for the test rows of each ticker."""
    test = _split_rows(spark, folder).where("is_test")
    made = _forecast_columns()
    made["Voting Ensemble"] = ensemble.voting(list(made.values()))
    return evaluate.long_predictions(test, made, "ticker", "event_time", "seq", "price", "target")


def _metrics(spark, folder) -> DataFrame:
    return evaluate.evaluate(_forecasts(spark, folder))


def tail_split(spark, folder):
    return _split_rows(spark, folder).select("ticker", "seq", "is_test")


def tail_split_chunked(spark, folder):
    return split.tail_split(_rows(spark, folder), max_rows=SMALL_CELL).select(
        "ticker", "seq", "is_test"
    )


def hash_split(spark, folder):
    """Rows of each ticker, and whether the share of test rows is in a band; the hash itself is Spark's own."""
    return _shares(split.hash_split(_rows(spark, folder)))


def share_split(spark, folder):
    """An exact share of each series, by the hashes of the rows."""
    return split.share_split(ticks(spark, folder)).select("ticker", "seq", "is_test")


def last_n_hot(spark, folder):
    """The last rows of every series, after cuts found by counts."""
    return clean.last_n(ticks(spark, folder), 10, tail_rows=50)


def random_split(spark, folder):
    seen, tested = split.random_split(_rows(spark, folder))
    return _shares(seen.withColumn("is_test", F.lit(False)).unionByName(tested.withColumn("is_test", F.lit(True))))


def _shares(parts: DataFrame) -> DataFrame:
    share = F.count_if("is_test") / F.count("*")
    return parts.groupBy("ticker").agg(F.count("*").alias("n"), share.between(0.08, 0.32).alias("share_in_band"))


def kfold_ids(spark, folder):
    size = series.size_of(ticks(spark, folder))
    folded = split.fold_ids(_rows(spark, folder, size), size=size)
    return folded.select("ticker", "seq", "fold")


def mae_rmse_accuracy(spark, folder):
    return rounded(_metrics(spark, folder))


def persistence_many_tickers(spark, folder):
    rows = features.features(ticks(spark, folder, "user_id"), TRAINING)
    made = evaluate.long_predictions(
        rows, {"persistence": F.col("price")}, "ticker", "target"
    )
    return rounded(evaluate.evaluate(made))


def metrics_format(spark, folder):
    return evaluate.format_metrics(_metrics(spark, folder))


def metrics_parse(spark, folder):
    return evaluate.parse_metrics(evaluate.format_metrics(_metrics(spark, folder)))


def metrics_file(spark, folder):
    """Metrics written as JSON and read back."""
    path = work_path(spark, "metrics")
    metrics.write_metrics(evaluate.format_metrics(_metrics(spark, folder)), path)
    return metrics.read_metrics(spark, path)


def weighted_prediction(spark, folder):
    columns = [F.col("price"), F.col("MA5"), F.col("MA20")]
    return rounded(
        _rows(spark, folder).select(
            "ticker", "seq", ensemble.weighted(columns, [0.5, 0.3, 0.2]).alias("prediction")
        )
    )


def voting_mean(spark, folder):
    mean = ensemble.voting(list(_forecast_columns().values()))
    return rounded(_rows(spark, folder).select("ticker", "seq", mean.alias("prediction")))


def leaderboard(spark, folder):
    return rounded(evaluate.leaderboard(_metrics(spark, folder), good_above=20.0))


def best_model(spark, folder):
    return rounded(evaluate.best_model(_metrics(spark, folder)))


def base_model_count(spark, folder):
    return evaluate.base_model_count(_metrics(spark, folder))


# Serving


def predict_band(spark, folder):
    banded = serve.with_band(rounded(_forecasts(spark, folder)))
    return banded.select(
        "ticker", "seq", "model", "predicted_price", "confidence_lower", "confidence_upper"
    )


def direction(spark, folder):
    """Of the published price, against the current one."""
    up = serve.direction(F.col("predicted_price"), F.col("price"))
    published = serve.with_band(rounded(_forecasts(spark, folder)))
    return published.select("ticker", "seq", "model", up.alias("direction"))


def market_state(spark, folder):
    return serve.market_state(ticks(spark, folder), AS_OF)


def market_age(spark, folder):
    """Milliseconds since the last tick of each series."""
    last = clean.latest(ticks(spark, folder, "user_id"))
    age = scalar.millis_between(F.col("event_time"), F.lit(AS_OF))
    return last.select("ticker", age.alias("age_ms"))


def metrics_lookup(spark, folder):
    """Metrics for every event type and, without any, for every order priority."""
    # A few rows, stored: both sides of the lookup read them.
    published = durable(evaluate.format_metrics(_metrics(spark, folder)))
    published = published.withColumn("ticker", F.upper("ticker"))
    known = clean.distinct_tickers(ticks(spark, folder))
    unknown = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("ticker"))
    return serve.metrics_of(published, known.unionByName(unknown.distinct()))


# Models


def ols_one_feature(spark, folder):
    return rounded(regress.ols_one_feature(_rows(spark, folder), "price"))


def ridge_one_feature(spark, folder):
    fitted = regress.fit_linear(_rows(spark, folder), ["MA5"], ridge=100.0)
    return rounded(
        fitted.select("ticker", "n", "intercept", F.get("weights", F.lit(0)).alias("slope"))
    )


def train_lr(spark, folder):
    """Least squares on the 12 features, all tickers at once."""
    parts = stored(_split_rows(spark, folder), "parts")
    fitted = durable(regress.fit_linear(parts.where(~F.col("is_test"))))
    scored = regress.score_linear(parts.where("is_test"), fitted)
    scored = durable(scored.withColumn("model", F.lit("Linear Regression")))
    return _facts(evaluate.evaluate(scored), _persistence(scored))


def train_lr_many_tickers(spark, folder):
    """A line per user; exact facts of the test rows, since short series fit 12 features too well."""
    rows = features.features(ticks(spark, folder, "user_id"), TRAINING)
    parts = stored(split.tail_split(rows), "parts")
    fitted = durable(regress.fit_linear(parts.where(~F.col("is_test"))))
    scored = regress.score_linear(parts.where("is_test"), fitted)
    metrics_ = evaluate.evaluate(scored.withColumn("model", F.lit("Linear Regression")))
    bounds = F.col("accuracy").between(0, 100) & (F.col("rmse") >= F.col("mae"))
    return metrics_.select("ticker", "n", F.round("mean_target", 6).alias("mean_target"), bounds.alias("is_sound"))


def train_trees_many_tickers(spark, folder):
    """Boosted trees per user, all grown together; exact facts of the test rows."""
    rows = features.features(ticks(spark, folder, "user_id"), TRAINING)
    run = train.train_together(rows, work_path(spark, "together"), ["Boosted Trees"], at_least=1)
    metrics_ = run.metrics()
    bounds = F.col("accuracy").between(0, 100) & (F.col("rmse") >= F.col("mae"))
    return metrics_.select("ticker", "n", F.round("mean_target", 6).alias("mean_target"), bounds.alias("is_sound"))


def predict_prices(spark, folder):
    """Every feature row as a request to its series' line; published prices and bands."""
    rows = _rows(spark, folder)
    line = regress.ols_one_feature(rows, FEATURES[0])
    weights = F.array(F.col("slope"), *(F.lit(0.0) for _ in FEATURES[1:]))
    member = F.struct(F.lit("linear").alias("kind"), "intercept", weights.alias("weights"), F.lit(None).alias("waves"), F.lit(None).alias("trees")).cast(scoring.MEMBER)
    models = line.select("ticker", F.lit("Line").alias("model"), F.lit(0.0).alias("intercept"), F.array(F.lit(1.0)).alias("weights"), F.array(member).alias("members"))
    answered = scoring.predict(rows.withColumn("model", F.lit("Line")), models).withColumn("prediction", F.round("prediction", 5))
    return serve.with_band(answered).select("ticker", "seq", "status", "predicted_price", "confidence_lower", "confidence_upper")


def two_feature_lines(spark, folder):
    """Least squares on two features, all tickers in one aggregate."""
    fitted = regress.fit_linear(_rows(spark, folder), ["MA5", "lag3"])
    weight = lambda i: F.get("weights", F.lit(i))
    return rounded(fitted.select("ticker", "n", "intercept", weight(0).alias("w_ma5"), weight(1).alias("w_lag3")), 5)


def record_rows(spark, folder):
    """Each tick as one record."""
    made = serve.records(ticks(spark, folder).select("ticker", "seq", "volume"))
    return made.select("record")


def unknown_market_state(spark, folder):
    """The state of known tickers, and of order priorities, which have no ticks."""
    asked = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("ticker")).distinct()
    asked = asked.unionByName(clean.distinct_tickers(ticks(spark, folder)))
    return serve.market_state_of(ticks(spark, folder), asked, AS_OF)


def _train(spark, folder, *models: str) -> train.Trained:
    size = series.size_of(ticks(spark, folder))
    tail = partial(split.tail_split, size=size)
    rows = _rows(spark, folder, size)
    return train.train_models(rows, work_path(spark, "training"), models, tail)


def _facts(metrics: DataFrame, naive: DataFrame) -> DataFrame:
    """Exact facts of a model's test rows, and whether its error is within a stated factor of persistence.

    Ticks of the test data are independent draws, where persistence is about
    1.4 times as far off as the mean; so no model that learned anything is,
    in short series either, above 1.5 times persistence.
    """
    base = naive.select("ticker", F.col("mae").alias("naive"))
    both = metrics.join(base, "ticker")
    return both.select("ticker", "model", "n", F.round("mean_target", 6).alias("mean_target"), (F.col("mae") <= 1.5 * F.col("naive")).alias("within_bound"))


def _persistence(test: DataFrame) -> DataFrame:
    return evaluate.evaluate(evaluate.long_predictions(test, {"persistence": F.col("price")}, "ticker", "target"))


def _trained(spark, folder, *models: str) -> DataFrame:
    run = _train(spark, folder, *models)
    return _facts(run.metrics(), _persistence(run.predictions()))


def train_lr_mllib(spark, folder):
    return _trained(spark, folder, "Linear Regression")


def train_rf(spark, folder):
    return _trained(spark, folder, "Random Forest")


def train_gbt(spark, folder):
    return _trained(spark, folder, "GBTRegressor")


def train_boosted(spark, folder):
    return _trained(spark, folder, "Boosted Trees")


def train_rbf(spark, folder):
    return _trained(spark, folder, "RBF Features")


def train_tube(spark, folder):
    """Waves with the epsilon-insensitive loss, and ensembles of them and lines."""
    size = series.size_of(ticks(spark, folder))
    run = train.train_ensembles(_rows(spark, folder, size), work_path(spark, "ensembles"), ["Linear Regression", "RBF Support Vectors"], folds=2, size=size)
    return _facts(run.metrics(), _persistence(run.predictions().where("model = 'Voting Ensemble'")))


def retrain_from_lake(spark, folder):
    """A lake, trained anew from its ticks; the published metrics' facts."""
    path = work_path(spark, "lake")
    lake.write(_lake_rows(spark, folder), path)
    run = train.retrain(spark, path, work_path(spark, "ensembles"), bases=["Linear Regression", "RBF Features"])
    return _facts(run.metrics(), _persistence(run.predictions().where("model = 'Voting Ensemble'")))


def stacking(spark, folder):
    size = series.size_of(ticks(spark, folder))
    rows = _rows(spark, folder, size)
    run = train.train_ensembles(rows, work_path(spark, "ensembles"), size=size)
    return _facts(run.metrics(), _persistence(run.predictions().where("model = 'Voting Ensemble'")))


def feature_importance(spark, folder):
    """Facts of the ranked importances: per ticker, how many there are, whether they sum to 1 and are in order."""
    saved = _train(spark, folder, "Random Forest").importances()
    ranked = train.feature_importance(saved).withColumn("importance", F.col("importance"))
    return ranked.groupBy("ticker", "model").agg(
        F.count("*").alias("n_features"),
        (F.abs(F.sum("importance") - 1) < 0.01).alias("sums_to_one"),
        (F.min("importance") >= 0).alias("none_negative"),
        F.sort_array(F.collect_set("feature")).alias("features"),
    ).withColumn("features", F.array_join("features", ","))


def _answered(spark, folder, run: train.Trained, *asked: str) -> DataFrame:
    """The latest features of each ticker, asked of each model and with a missing feature."""
    models = F.explode(F.array(*(F.lit(name) for name in asked), F.lit(None).cast("string")))
    latest = durable(serve.recent(ticks(spark, folder), 1).select("ticker", *FEATURES))
    requests = latest.withColumn("model", models)
    lacking = latest.withColumns({"model": F.lit(asked[0]), "lag2": F.lit(None).cast("double")})
    answered = scoring.predict(requests.unionByName(lacking), run.models())
    # Within a few deviations of the long mean, whatever the model.
    near = F.abs(F.col("prediction") - F.col("MA20")) <= 5 * F.col("rolling_std")
    return serve.with_band(answered).select(
        "ticker", "model", "status", F.coalesce(near, F.lit(False)).alias("is_near"), F.col("predicted_price").isNotNull().alias("has_price")
    )


def predict_requests(spark, folder):
    """Saved linear models asked by name, by a name nobody has, by none and with a missing feature."""
    return _answered(spark, folder, _train(spark, folder, "Linear Regression"), "Linear Regression", "Nobody")


def predict_ensembles(spark, folder):
    """The latest row of each ticker, answered by both saved ensembles and by each of their bases."""
    size = series.size_of(ticks(spark, folder))
    run = train.train_ensembles(_rows(spark, folder, size), work_path(spark, "ensembles"), size=size)
    return _answered(spark, folder, run, "Voting Ensemble", "Stacking Ensemble", *train.BASE_MODELS)


def stacking_linear(spark, folder):
    """Stacking of two one-feature lines in closed form: by fold, then ridge over both."""
    parts = stored(split.tail_split(_rows(spark, folder)), "parts")
    train_rows = stored(split.fold_ids(parts.where(~F.col("is_test"))), "folds")
    tested, held = parts.where("is_test"), None
    for i, name in enumerate(("price", "MA5")):
        # A fold's complement is everything minus the fold, for all folds in one aggregate.
        spread = train_rows.withColumn("without", F.explode(F.array(*(F.lit(k) for k in range(5)))))
        others = spread.where("fold != without")
        by_fold = others.groupBy("ticker", F.col("without").alias("fold")).agg(
            F.regr_slope("target", name).alias("slope"), F.regr_intercept("target", name).alias("line")
        )
        source = train_rows if held is None else held
        held = source.join(by_fold, ["ticker", "fold"]).withColumn(f"base{i}", F.col("line") + F.col("slope") * F.col(name)).drop("line", "slope")
        whole = train_rows.groupBy("ticker").agg(
            F.regr_slope("target", name).alias("slope"), F.regr_intercept("target", name).alias("line")
        )
        tested = tested.join(whole, "ticker").withColumn(f"base{i}", F.col("line") + F.col("slope") * F.col(name)).drop("line", "slope")
    scored = ensemble.stack(stored(held, "held"), tested, ["base0", "base1"], ridge=1.0)
    return rounded(scored.select("ticker", "seq", F.col("prediction")), 4)


# Frequencies


def key_frequency(spark, folder):
    return frequency.key_frequency(
        table(spark, folder, "lineitem"), "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus"
    )


def hourly_frequency(spark, folder):
    return frequency.hourly_frequency(table(spark, folder, "events"), F.col("ts"))


def top_keys(spark, folder):
    return frequency.top_keys(table(spark, folder, "lineitem"), "l_partkey", 20)


# In this order; the trainings of many models come last.
REGISTERED: list[Query] = [
    features_p,
    features_s,
    features_chunked,
    features_s_chunked,
    features_many_tickers,
    lags,
    lead_target,
    ma_full,
    ma_partial,
    rolling_std,
    price_change,
    pct_change,
    row_numbers,
    recent_100,
    recent_20_many_tickers,
    last_100_of_ticker,
    last_n_raw,
    ticker_scan,
    partition_scan,
    dedup_first,
    dropna_any,
    fill_zero,
    falsy_default,
    latest_tick,
    latest_tick_many_tickers,
    distinct_tickers,
    tick_count,
    min_rows_filter,
    historical_bars,
    csv_bars,
    json_payload,
    json_parse,
    json_rejects,
    ts_parse,
    time_labels,
    model_names,
    stream_ingest,
    lake_compact,
    mixed_lake,
    publish_round_trip,
    ingest_tables,
    ingest_rejects,
    day_summary,
    compact_tables,
    recent_by_summary,
    feature_table,
    tail_split,
    tail_split_chunked,
    hash_split,
    random_split,
    share_split,
    last_n_hot,
    kfold_ids,
    mae_rmse_accuracy,
    persistence_many_tickers,
    metrics_format,
    metrics_parse,
    metrics_file,
    weighted_prediction,
    voting_mean,
    leaderboard,
    best_model,
    base_model_count,
    predict_band,
    direction,
    market_state,
    market_age,
    metrics_lookup,
    key_frequency,
    hourly_frequency,
    top_keys,
    ols_one_feature,
    ridge_one_feature,
    two_feature_lines,
    record_rows,
    unknown_market_state,
    train_lr,
    train_lr_many_tickers,
    train_trees_many_tickers,
    predict_prices,
    train_lr_mllib,
    train_rf,
    feature_importance,
    predict_requests,
    predict_ensembles,
    stacking_linear,
    train_rbf,
    train_gbt,
    train_boosted,
    train_tube,
    retrain_from_lake,
    stacking,
]


def all_queries() -> dict[str, Query]:
    return {query.__name__: query for query in REGISTERED}
