from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalar


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, want",
    [
        ("2026-05-01 09:30:00-04:00", datetime(2026, 5, 1, 13, 30)),
        ("2026-11-01 01:30:00-04:00", datetime(2026, 11, 1, 5, 30)),
        ("2026-11-01 01:30:00-05:00", datetime(2026, 11, 1, 6, 30)),
        ("2026-05-01T09:30:00Z", datetime(2026, 5, 1, 9, 30)),
        ("2026-05-01", datetime(2026, 5, 1)),
        ("05/01/2026 09:30", datetime(2026, 5, 1, 9, 30)),
        ("05/01/2026 09:30:15", datetime(2026, 5, 1, 9, 30, 15)),
        (" 20260501 09:30:00 ", datetime(2026, 5, 1, 9, 30)),
        ("May 1, 2026 09:30:00", datetime(2026, 5, 1, 9, 30)),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_time(spark, text, want):
    parsed = scalar.parse_time(F.lit(text).cast("string")).cast("timestamp_ntz")
    assert one(spark, parsed) == want


@pytest.mark.parametrize(
    "text, want", [("99.90%", 99.9), ("99.9", 99.9), ("N/A", 0.0), (None, 0.0), ("", 0.0)]
)
def test_parse_percent(spark, text, want):
    assert one(spark, scalar.parse_percent(F.lit(text).cast("string"))) == want


def test_format_percent(spark):
    assert one(spark, scalar.format_percent(F.lit(99.9))) == "99.90%"
    assert one(spark, scalar.format_percent(F.lit(0.0))) == "0.00%"


@pytest.mark.parametrize("value, want", [(None, 5.0), (0.0, 5.0), (float("nan"), 5.0), (-2.0, -2.0)])
def test_zero_or_missing(spark, value, want):
    got = scalar.zero_or_missing(F.lit(value).cast("double"), F.lit(5.0))
    assert one(spark, got) == want


def test_labels(spark):
    time = F.lit("2026-05-01 09:05:00").cast("timestamp")
    assert one(spark, scalar.clock_label(time)) == "09:05"
    assert one(spark, scalar.day_label(time)) == "May 1, 09:05"


def test_names(spark):
    parts = scalar.split_model_file(F.lit("aapl_random_forest"))
    assert one(spark, parts).asDict() == {"ticker": "AAPL", "slug": "random_forest"}
    assert one(spark, scalar.display_name(F.lit("ensemble"))) == "Stacking Ensemble"
    assert one(spark, scalar.display_name(F.lit("linear_regression"))) == "Linear Regression"
    assert one(spark, scalar.topic_of(F.lit("aapl"), "stock_")) == "stock_AAPL"


def test_epoch_difference(spark):
    early, late = (F.lit(f"2026-05-01 09:{m}:00").cast("timestamp") for m in (10, 25))
    assert one(spark, scalar.millis_between(early, late)) == 15 * 60 * 1000
