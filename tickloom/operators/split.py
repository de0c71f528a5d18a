"""Train/test splits and folds, kept as columns of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SPLIT_SEED, TEST_SHARE
from .ranks import cuts
from .series import MAX_SERIES_ROWS, Size, micros, number_rows, ordered, small_side, tied


def tail_split(
    df: DataFrame,
    share: float = TEST_SHARE,
    max_rows: int = MAX_SERIES_ROWS,
    size: Size | None = None,
) -> DataFrame:
    """Add ``is_test``: the last ceil(share * n) rows of each ticker."""
    numbered = number_rows(df, max_rows, size)
    held_out = F.ceil(F.col("series_rows") * F.lit(share))
    is_test = F.col("row_no") > F.col("series_rows") - held_out
    return numbered.withColumn("is_test", is_test).drop("row_no", "series_rows")


def hash_split(df: DataFrame, share: float = TEST_SHARE) -> DataFrame:
    """Add ``is_test`` by a hash of the row's key: repeatable and without a shuffle."""
    bucket = F.pmod(F.xxhash64("ticker", "event_time", "seq"), F.lit(10_000))
    return df.withColumn("is_test", bucket < F.lit(round(share * 10_000)))


def share_split(df: DataFrame, share: float = TEST_SHARE) -> DataFrame:
    """Add ``is_test``: exactly ceil(share * n) rows of each ticker, those with the highest hashes of their key.

    The hash is MD5 of ticker, time in microseconds and seq, so the split is the same
    wherever it is computed and however the rows are partitioned.  Each ticker's
    threshold is found by counts of hash ranges, without a sort.  Rows without a place in a
    series are left out; equal rows at the threshold are all test rows.
    """
    rows = ordered(df)
    key = F.concat_ws("|", "ticker", micros(rows).cast("string"), F.col("seq").cast("string"))
    rows = tied(rows).withColumn("_a", F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"))
    found = cuts(rows.select("ticker", "_a", F.col("_tie").alias("_b")), F.ceil(F.col("n") * F.lit(share)).cast("long"), 1)
    at = found.select("ticker", F.col("a").alias("_cut_a"), F.col("b").alias("_cut_b"))
    joined = rows.join(small_side(at), "ticker")
    is_test = (F.col("_a") > F.col("_cut_a")) | ((F.col("_a") == F.col("_cut_a")) & (F.col("_tie") >= F.col("_cut_b")))
    return joined.withColumn("is_test", is_test).select(*df.columns, "is_test")


def random_split(df: DataFrame, share: float = TEST_SHARE, seed: int = SPLIT_SEED):
    """(train, test) by a random draw; neighbours in time end up on both sides."""
    return tuple(df.randomSplit([1 - share, share], seed))


def fold_ids(
    df: DataFrame, folds: int = 5, max_rows: int = MAX_SERIES_ROWS, size: Size | None = None
) -> DataFrame:
    """Add ``fold``: contiguous folds of each ticker, the first ones longer by one row.

    A ticker with fewer rows than folds cannot be folded and fails the query.
    """
    numbered = number_rows(df, max_rows, size)
    at = F.col("row_no") - 1
    short = F.floor(F.col("series_rows") / folds)
    longer = F.col("series_rows") % folds
    head = longer * (short + 1)
    fold = F.when(at < head, F.floor(at / (short + 1))).otherwise(
        longer + F.floor(F.try_divide(at - head, short))
    )
    too_few = F.raise_error(F.concat(F.lit("too few rows to fold: "), F.col("ticker")))
    checked = F.when(F.col("series_rows") < folds, too_few.cast("int")).otherwise(fold.cast("int"))
    return numbered.withColumn("fold", checked).drop("row_no", "series_rows")
