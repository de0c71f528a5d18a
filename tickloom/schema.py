"""Column names, types and fixed values shared by the whole package.

A *tick* is one price observation: ``ticker``, ``event_time``, ``seq``,
``price``, ``volume``.  ``seq`` is a LONG that is unique among the ticks of one
ticker and settles the order of equal times, so every result is repeatable.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Message body as it travels: the time is text and may carry a zone offset.
# volume is a LONG because a 32-bit field turns large volumes into null.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

# Columns of Spark's kafka source.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Lake table.  It is always read with this schema: inferring partition values
# would turn a ticker such as "0700" into an integer.
LAKE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("ticker", T.StringType()),
    ]
)

# ticker -> model -> "99.90%"
METRICS_SCHEMA = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))

ORDER = ["event_time", "seq"]

# Feature names in the order the models are trained on.
FEATURES = [
    "price",
    "volume",
    "lag1",
    "lag2",
    "lag3",
    "MA5",
    "MA10",
    "MA20",
    "rolling_mean",
    "rolling_std",
    "price_change",
    "pct_change",
]

# Models listed when no metrics file exists yet.
DEFAULT_MODELS = [
    "Stacking Ensemble",
    "Random Forest",
    "XGBoost",
    "Voting Ensemble",
    "Linear Regression",
    "SVR",
]

# The model of a request that names none.
DEFAULT_MODEL = "Stacking Ensemble"

# Other names that requests and published lists use, and the model that answers for each.
MODEL_ALIASES = {"XGBoost": "Boosted Trees", "SVR": "RBF Features"}

# Fixed value: topics are this and the ticker.
TOPIC_PREFIX = "stock_"
SPLIT_SEED = 42
TEST_SHARE = 0.2
MIN_TRAIN_ROWS = 10
