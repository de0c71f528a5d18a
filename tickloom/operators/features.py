"""Window features of a price series, in two profiles that must stay apart.

``SERVING`` needs full windows and looks 5 ticks ahead; ``TRAINING`` allows
partial windows and looks 1 tick ahead.  The column names are the same, the
values are not.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalar import finite, ieee_ratio
from .series import MAX_SERIES_ROWS, Size, by_series

LOOKBACK = 19


@dataclass(frozen=True)
class Profile:
    """What a feature column means.

    horizon       ticks between a row and its target
    full_windows  an average is null until its window is full
    spread        ticks in rolling_mean and rolling_std
    percent       pct_change times 100, null after a zero price; else a
                  fraction, infinite after a zero price
    """

    horizon: int
    full_windows: bool
    spread: int
    percent: bool


SERVING = Profile(horizon=5, full_windows=True, spread=5, percent=False)
TRAINING = Profile(horizon=1, full_windows=False, spread=20, percent=True)


def lag_price(k: int, series: WindowSpec) -> Column:
    return F.lag("price", k).over(series)


def target_price(horizon: int, series: WindowSpec) -> Column:
    return F.lead("price", horizon).over(series)


def rolling(function, n: int, series: WindowSpec, full: bool) -> Column:
    """``function`` of the last ``n`` prices.

    With ``full``, null unless the window holds ``n`` usable prices; otherwise
    a shorter window at the start of the series counts as well.
    """
    frame = series.rowsBetween(1 - n, Window.currentRow)
    if not full:
        return function(F.col("price")).over(frame)
    usable = finite(F.col("price"))
    return F.when(F.count(usable).over(frame) == n, function(usable).over(frame))


def relative_change(percent: bool) -> Column:
    """Change against ``lag1``."""
    if percent:
        return F.try_divide(F.col("price") - F.col("lag1"), F.col("lag1")) * 100
    return ieee_ratio(F.col("price"), F.col("lag1")) - 1


def feature_columns(
    ticks: DataFrame,
    profile: Profile = SERVING,
    max_rows: int = MAX_SERIES_ROWS,
    size: Size | None = None,
) -> DataFrame:
    """Every tick with its features and target; null where they do not exist."""
    compute = partial(_with_windows, profile=profile)
    return by_series(ticks, compute, LOOKBACK, profile.horizon, max_rows, size)


def features(
    ticks: DataFrame,
    profile: Profile = SERVING,
    max_rows: int = MAX_SERIES_ROWS,
    size: Size | None = None,
) -> DataFrame:
    """The 12 features and the target of every tick that has all of them.

    ``size`` of the ticks is measured if it is not given.
    """
    return drop_incomplete(feature_columns(ticks, profile, max_rows, size))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without null or NaN in any column."""
    return df.dropna()


_BLOCK = 5


def _with_windows(rows: DataFrame, series: WindowSpec, profile: Profile) -> DataFrame:
    """All feature columns, equal to ``rolling`` and its companions one by one.

    A frame of 20 ticks is gone through anew at every row.  So only blocks of
    5 are framed; longer windows are put together from the blocks that end 0,
    5, 10 and 15 rows back.  Both steps share one shuffle and one sort.
    """
    framed = _full_blocks(series) if profile.full_windows else _partial_blocks(series)
    blocks = rows.select(
        "*",
        *(lag_price(k, series).alias(f"lag{k}") for k in (1, 2, 3)),
        target_price(profile.horizon, series).alias("target"),
        *(column.alias(f"{name}0") for name, column in framed.items()),
    )
    missing = None if profile.full_windows else 0
    earlier = blocks.select(
        "*",
        *(
            F.lag(f"{name}0", _BLOCK * k, missing).over(series).alias(f"{name}{k}")
            for k in (1, 2, 3)
            for name in framed
        ),
    )
    made = _of_full_blocks() if profile.full_windows else _of_partial_blocks()
    return earlier.select(
        *rows.columns,
        "lag1",
        "lag2",
        "lag3",
        *(made[f"MA{n}"].alias(f"MA{n}") for n in (5, 10, 20)),
        made[f"MA{profile.spread}"].alias("rolling_mean"),
        made["deviation"].alias("rolling_std"),
        (F.col("price") - F.col("lag1")).alias("price_change"),
        relative_change(profile.percent).alias("pct_change"),
        "target",
    )


def _full_blocks(series: WindowSpec) -> dict[str, Column]:
    """Mean and deviation of the last 5 prices, null unless all are usable."""
    return {
        "_mean": rolling(F.avg, _BLOCK, series, full=True),
        "_deviation": rolling(F.stddev_samp, _BLOCK, series, full=True),
    }


def _of_full_blocks() -> dict[str, Column]:
    mean = [F.col(f"_mean{k}") for k in range(4)]
    return {
        "MA5": mean[0],
        "MA10": (mean[0] + mean[1]) / 2,
        "MA20": (mean[0] + mean[1] + mean[2] + mean[3]) / 4,
        "deviation": F.col("_deviation0"),
    }


def _partial_blocks(series: WindowSpec) -> dict[str, Column]:
    """Number, mean and variance of up to 5 prices; zeros where there are none."""
    frame = series.rowsBetween(1 - _BLOCK, Window.currentRow)
    price = F.col("price")
    return {
        "_n": F.count(price).over(frame).cast("double"),
        "_mean": F.coalesce(F.avg(price).over(frame), F.lit(0.0)),
        "_variance": F.coalesce(F.var_pop(price).over(frame), F.lit(0.0)),
    }


def _of_partial_blocks() -> dict[str, Column]:
    """Means and the deviation by the offsets of the blocks from the latest one.

    Offsets are of the size of the deviation itself, so no digits cancel.
    """
    n = [F.col(f"_n{k}") for k in range(4)]
    mean = [F.col(f"_mean{k}") for k in range(4)]
    offset = [mean[k] - mean[0] for k in range(4)]
    held, shift = reduce(add, n), reduce(add, [n[k] * offset[k] for k in (1, 2, 3)])
    squares = [n[k] * (F.col(f"_variance{k}") + offset[k] * offset[k]) for k in range(4)]
    spread = F.greatest(reduce(add, squares) - F.try_divide(shift * shift, held), F.lit(0.0))
    return {
        "MA5": F.when(n[0] > 0, mean[0]),
        "MA10": F.when(n[0] + n[1] > 0, mean[0] + n[1] * offset[1] / (n[0] + n[1])),
        "MA20": F.when(held > 0, mean[0] + shift / held),
        "deviation": F.when(held > 1, F.sqrt(spread / (held - 1))),
    }
