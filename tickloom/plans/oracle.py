"""SQL that states the expected result of the registered queries."""

from __future__ import annotations

FEATURE_COLUMNS = (
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
    "target",
)


def _r(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in names)


def _ticks(ticker: str = "event_type") -> str:
    return f"""ticks AS (
  SELECT CAST({ticker} AS VARCHAR) AS ticker, ts AS event_time, event_id AS seq,
         value AS price, CAST(props->>'$.k' AS BIGINT) AS volume
  FROM events)"""


BARS = """ticks AS (
  SELECT o_orderpriority AS ticker, o_orderdate AS event_time, o_orderkey AS seq,
         o_totalprice AS price, o_custkey AS volume
  FROM orders)"""

W = "PARTITION BY ticker ORDER BY event_time, seq"


def _last(n: int) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _full(function: str, n: int) -> str:
    return (
        f"CASE WHEN count(price) OVER {_last(n)} = {n} THEN {function}(price) OVER {_last(n)} END"
    )


def _partial(function: str, n: int) -> str:
    return f"{function}(price) OVER {_last(n)}"


def _windows(horizon: int, full: bool, spread: int) -> str:
    form = _full if full else _partial
    return f"""windows AS (
  SELECT *,
    lag(price, 1) OVER ({W}) AS lag1,
    lag(price, 2) OVER ({W}) AS lag2,
    lag(price, 3) OVER ({W}) AS lag3,
    {form('avg', 5)} AS MA5,
    {form('avg', 10)} AS MA10,
    {form('avg', 20)} AS MA20,
    {form('avg', spread)} AS rolling_mean,
    {form('stddev_samp', spread)} AS rolling_std,
    lead(price, {horizon}) OVER ({W}) AS target
  FROM ticks)"""


FRACTION = """CASE WHEN lag1 <> 0 THEN price / lag1
    WHEN price > 0 THEN CAST('inf' AS DOUBLE) WHEN price < 0 THEN CAST('-inf' AS DOUBLE)
    WHEN lag1 = 0 THEN CAST('nan' AS DOUBLE) END - 1"""
PERCENT = "CASE WHEN lag1 <> 0 THEN (price - lag1) / lag1 * 100 END"


def _features(profile: str, ticks: str) -> str:
    """CTEs up to ``f``: the complete feature rows."""
    serving = profile == "serving"
    windows = _windows(5, True, 5) if serving else _windows(1, False, 20)
    change = FRACTION if serving else PERCENT
    complete = " AND ".join(
        f"{name} IS NOT NULL AND NOT isnan({name})"
        for name in FEATURE_COLUMNS
        if name not in ("volume",)
    )
    return f"""{ticks},
{windows},
w AS (SELECT *, price - lag1 AS price_change, {change} AS pct_change FROM windows),
f AS (SELECT ticker, event_time, seq, {', '.join(FEATURE_COLUMNS)} FROM w
  WHERE {complete} AND volume IS NOT NULL)"""


_DOUBLES = tuple(name for name in FEATURE_COLUMNS if name != "volume")


def _feature_query(profile: str, ticks: str, digits: int = 6) -> str:
    return f"""WITH {_features(profile, ticks)}
SELECT ticker, event_time, seq, volume, {_r(*_DOUBLES, digits=digits)} FROM f"""


def _recent(n: int, ticks: str) -> str:
    return f"""WITH {_features('serving', ticks)},
firsts AS (SELECT *, row_number() OVER (PARTITION BY ticker, event_time ORDER BY seq) AS dup FROM f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY event_time DESC, seq DESC) AS place
  FROM firsts WHERE dup = 1)
SELECT ticker, event_time, seq, volume, {_r(*_DOUBLES)} FROM ranked WHERE place <= {n}"""


def _windowed(**columns: str) -> str:
    made = ", ".join(f"round({sql}, 6) AS {name}" for name, sql in columns.items())
    return f"WITH {_ticks()} SELECT ticker, seq, {made} FROM ticks"


_NUMBERED = f"""n AS (SELECT *, row_number() OVER ({W}) AS row_no,
  count(*) OVER (PARTITION BY ticker) AS series_rows FROM f)"""

_SPLIT = f"""{_features('serving', _ticks())},
{_NUMBERED},
parts AS (SELECT *, row_no > series_rows - ceil(series_rows * 0.2::DOUBLE) AS is_test FROM n)"""

_FORECASTS = f"""{_SPLIT},
forecasts AS (
  SELECT ticker, event_time, seq, price, target, model, prediction
  FROM parts, LATERAL (VALUES
    ('persistence', price), ('short mean', MA5), ('long mean', MA20),
    ('momentum', price + price_change),
    ('Voting Ensemble', (price + MA5 + MA20 + (price + price_change)) / 4)) AS v(model, prediction)
  WHERE is_test)"""

_METRIC_STATS = """
  SELECT ticker, model, count(*) AS n, avg(abs(target - prediction)) AS mae,
         sqrt(avg((target - prediction) * (target - prediction))) AS rmse,
         avg(target) AS mean_target"""

_ACCURACY = "greatest(0, 100 - mae / coalesce(nullif(mean_target, 0), 1) * 100)"

_METRICS = f"""{_FORECASTS},
stats AS ({_METRIC_STATS} FROM forecasts GROUP BY ticker, model),
metrics AS (SELECT *, {_ACCURACY} AS accuracy FROM stats)"""

_METRIC_COLUMNS = f"ticker, model, n, {_r('mae', 'rmse', 'mean_target', 'accuracy')}"

_GAPS = f"""WITH {_ticks()}, gaps AS (
  SELECT ticker, seq, CASE WHEN price >= 5 THEN price END AS price,
         CASE WHEN volume > 10 THEN volume END AS volume FROM ticks)"""


def _falsy(name: str, default: str) -> str:
    return f"coalesce(nullif({name}, 0), {default}) AS {name}"


_TICK = f"WITH {_ticks()} SELECT ticker, event_time, seq, price, volume FROM ticks"

_LATEST = """SELECT ticker, event_time, seq, price, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY event_time DESC, seq DESC) AS place
  FROM ticks) WHERE place = 1"""

# Rounding of a double by its decimal digits, halves away from zero.
def _cents(sql: str) -> str:
    return f"CAST(round(CAST(CAST({sql} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


_ROUNDED_FORECASTS = f"""{_FORECASTS},
r AS (SELECT ticker, seq, model, price, round(prediction, 6) AS p FROM forecasts)"""

_BAND = "CASE WHEN contains(model, 'Ensemble') THEN 0.01::DOUBLE ELSE 0.02::DOUBLE END"


_SHARES = f"""WITH {_features('serving', _ticks())}
SELECT ticker, count(*) AS n, TRUE AS share_in_band FROM f GROUP BY ticker"""

# Two one-feature lines by fold, then ridge (penalty 1) over both in closed form.
_STACKING = f"""WITH {_SPLIT},
t AS (SELECT ticker, seq, price, MA5, target, row_number() OVER ({W}) - 1 AS i, count(*) OVER (PARTITION BY ticker) AS rows
  FROM parts WHERE NOT is_test),
s AS (SELECT *, rows // 5 AS size, rows % 5 AS longer FROM t),
k AS (SELECT *, CASE WHEN i < longer * (size + 1) THEN i // (size + 1)
  ELSE longer + (i - longer * (size + 1)) // size END AS fold FROM s),
o AS (SELECT ticker, without, regr_slope(target, price) AS s0, regr_intercept(target, price) AS i0,
    regr_slope(target, MA5) AS s1, regr_intercept(target, MA5) AS i1
  FROM k, range(5) AS f(without) WHERE fold <> without GROUP BY ALL),
h AS (SELECT k.ticker, target, i0 + s0 * price AS a, i1 + s1 * MA5 AS b FROM k JOIN o ON k.ticker = o.ticker AND k.fold = o.without),
m AS (SELECT ticker, avg(a) AS ma, avg(b) AS mb, avg(target) AS my, count(*) * var_pop(a) + 1 AS aa,
    count(*) * var_pop(b) + 1 AS bb, count(*) * covar_pop(a, b) AS ab, count(*) * covar_pop(a, target) AS ay,
    count(*) * covar_pop(b, target) AS b_y FROM h GROUP BY ticker),
meta AS (SELECT *, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS wa, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM m),
l AS (SELECT ticker, regr_slope(target, price) AS s0, regr_intercept(target, price) AS i0,
    regr_slope(target, MA5) AS s1, regr_intercept(target, MA5) AS i1 FROM k GROUP BY ticker)
SELECT ticker, seq, round(my + wa * (i0 + s0 * price - ma) + wb * (i1 + s1 * MA5 - mb), 4) AS prediction
FROM parts JOIN meta USING (ticker) JOIN l USING (ticker) WHERE is_test"""


_MANY_TICKERS = f"""WITH {_features('training', _ticks('user_id'))}, {_NUMBERED},
parts AS (SELECT *, row_no > series_rows - ceil(series_rows * 0.2::DOUBLE) AS is_test FROM n),
fitted AS (SELECT DISTINCT ticker FROM parts WHERE NOT is_test)
SELECT ticker, count(*) AS n, round(avg(target), 6) AS mean_target, TRUE AS is_sound
FROM parts JOIN fitted USING (ticker) WHERE is_test GROUP BY ticker"""


def _facts(*models: str) -> str:
    """Test rows of each ticker and model, whose errors are within the bound."""
    names = ", ".join(f"('{model}')" for model in models)
    return f"""WITH {_SPLIT}
SELECT ticker, model, count(*) AS n, round(avg(target), 6) AS mean_target, TRUE AS within_bound
FROM parts, (VALUES {names}) AS names(model) WHERE is_test GROUP BY ticker, model"""


def _answers(*expected: tuple[str, str]) -> str:
    rows = ", ".join(f"('{model}', '{status}')" for model, status in expected)
    return f"""SELECT ticker, model, status, status = 'ok' AS is_near, status = 'ok' AS has_price
FROM (SELECT DISTINCT upper(event_type) AS ticker FROM events), (VALUES {rows}) AS answers(model, status)"""


def all_oracles() -> dict[str, str]:
    features_p = _feature_query("serving", _ticks())
    features_s = _feature_query("training", _ticks())
    return {
        "features_p": features_p,
        "features_s": features_s,
        "features_chunked": features_p,
        "features_s_chunked": features_s,
        "features_many_tickers": _feature_query("serving", _ticks("user_id")),
        "lags": _windowed(**{f"lag{k}": f"lag(price, {k}) OVER ({W})" for k in (1, 2, 3)}),
        "lead_target": _windowed(
            **{f"target_{k}": f"lead(price, {k}) OVER ({W})" for k in (1, 5)}
        ),
        "ma_full": _windowed(**{f"MA{n}": _full("avg", n) for n in (5, 10, 20)}),
        "ma_partial": _windowed(**{f"MA{n}": _partial("avg", n) for n in (5, 10, 20)}),
        "rolling_std": _windowed(
            std_5_full=_full("stddev_samp", 5), std_20_partial=_partial("stddev_samp", 20)
        ),
        "price_change": _windowed(price_change=f"price - lag(price, 1) OVER ({W})"),
        "pct_change": f"""WITH {_ticks()},
w AS (SELECT *, lag(price, 1) OVER ({W}) AS lag1 FROM ticks)
SELECT ticker, seq, round({FRACTION}, 6) AS fraction, round({PERCENT}, 6) AS percent
FROM (SELECT ticker, seq, price, lag1 FROM w)""".replace(
            "WHEN price > 0 THEN", "WHEN lag1 = 0 AND price > 0 THEN"
        ).replace("WHEN price < 0 THEN", "WHEN lag1 = 0 AND price < 0 THEN"),
        "row_numbers": f"""WITH {_ticks()} SELECT ticker, seq, row_number() OVER ({W}) AS row_no,
count(*) OVER (PARTITION BY ticker) AS series_rows FROM ticks""",
        "recent_100": _recent(100, _ticks()),
        "recent_20_many_tickers": _recent(20, _ticks("user_id")),
        "last_100_of_ticker": f"""WITH {_ticks()}
SELECT ticker, event_time, seq, price, volume FROM ticks WHERE ticker = 'purchase'
ORDER BY event_time DESC, seq DESC LIMIT 100""",
        "last_n_raw": f"WITH {_ticks()} {_LATEST}".replace("place = 1", "place <= 10"),
        "ticker_scan": f"{_TICK} WHERE ticker = 'click'",
        "partition_scan": f"""WITH {_ticks()}
SELECT ticker, seq, price, volume FROM ticks WHERE ticker = 'error'""",
        "dedup_first": f"""WITH {_ticks()}, minutes AS (
  SELECT ticker, CAST(date_trunc('minute', event_time) AS TIMESTAMP) AS event_time, seq, price, volume
  FROM ticks)
SELECT ticker, event_time, seq, price, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, event_time ORDER BY seq) AS dup FROM minutes)
WHERE dup = 1""",
        "dropna_any": f"{_GAPS} SELECT * FROM gaps WHERE price IS NOT NULL AND volume IS NOT NULL",
        "fill_zero": f"""{_GAPS} SELECT ticker, seq, coalesce(price, 0) AS price,
coalesce(volume, 0) AS volume FROM gaps""",
        "falsy_default": f"""WITH {_ticks()}, {_windows(5, True, 5)},
w AS (SELECT *, price - lag1 AS price_change, {FRACTION} AS pct_change FROM windows),
d AS (SELECT ticker, seq, price, {_falsy('volume', '0')},
  {', '.join(_falsy(c, '0') for c in ('lag1', 'lag2', 'lag3', 'rolling_std', 'price_change'))},
  {', '.join(_falsy(c, 'price') for c in ('MA5', 'MA10', 'MA20', 'rolling_mean'))},
  CASE WHEN lag1 IS NULL OR isnan(pct_change) THEN 0 ELSE pct_change END AS pct_change
  FROM w WHERE price <> 0)
SELECT ticker, seq, volume, {_r(*(c for c in _DOUBLES if c != 'target'))} FROM d""",
        "latest_tick": f"WITH {_ticks()} {_LATEST}",
        "latest_tick_many_tickers": f"WITH {_ticks('user_id')} {_LATEST}",
        "distinct_tickers": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker FROM events",
        "tick_count": "SELECT count(*) AS n FROM events",
        "min_rows_filter": f"""WITH {_ticks('user_id')} SELECT ticker, event_time, seq, price, volume
FROM ticks WHERE ticker IN (SELECT ticker FROM ticks GROUP BY ticker HAVING count(*) >= 65)""",
        "historical_bars": _feature_query("serving", BARS, digits=4),
        "json_payload": f"""WITH {_ticks()}
SELECT 'stock_' || upper(ticker) AS topic, CAST(json_object(
  'timestamp', strftime(event_time, '%Y-%m-%d %H:%M:%S.%f'), 'ticker', upper(ticker),
  'price', price, 'volume', volume) AS VARCHAR) AS value FROM ticks""",
        "json_parse": _TICK,
        "json_rejects": """SELECT count(*) FILTER (event_id % 2 = 1) AS accepted,
  count(*) FILTER (event_id % 2 <> 1) AS rejected FROM events""",
        "ts_parse": """SELECT seq, form, CASE form WHEN 2 THEN date_trunc('second', ts)
  WHEN 3 THEN NULL ELSE ts END AS event_time
FROM (SELECT event_id AS seq, ts, unnest([0, 1, 2, 3])::BIGINT AS form FROM events)""",
        "time_labels": """SELECT event_id AS seq, strftime(ts, '%H:%M') AS clock,
strftime(ts, '%b %-d, %H:%M') AS day FROM events""",
        "model_names": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker, slug, model
FROM events, (VALUES ('random_forest', 'Random Forest'), ('ensemble', 'Stacking Ensemble'),
  ('voting_ensemble', 'Voting Ensemble')) AS names(slug, model)""",
        "stream_ingest": _TICK,
        "lake_compact": _TICK,
        "mixed_lake": _TICK,
        "publish_round_trip": f"SELECT upper(ticker) AS ticker, event_time, price, volume FROM ({_TICK})",
        "ingest_tables": _TICK,
        "compact_tables": _TICK,
        "ingest_rejects": """SELECT CASE event_id % 97 WHEN 0 THEN props ELSE '!' || props END AS value, 1::INTEGER AS partition,
  event_id AS place, CASE event_id % 97 WHEN 0 THEN 'no ticker' ELSE 'no JSON' END AS reason
FROM events WHERE event_id % 97 < 2""",
        "day_summary": """SELECT event_type AS ticker, (ts::DATE - DATE '1970-01-01')::BIGINT AS day, count(*) AS n,
  max_by(event_id, (ts, event_id)) AS last_seq
FROM events GROUP BY 1, 2""",
        "recent_by_summary": _recent(20, _ticks()),
        "feature_table": features_p,
        "tail_split": f"WITH {_SPLIT} SELECT ticker, seq, is_test FROM parts",
        "tail_split_chunked": f"WITH {_SPLIT} SELECT ticker, seq, is_test FROM parts",
        "kfold_ids": f"""WITH {_features('serving', _ticks())}, {_NUMBERED},
sized AS (SELECT *, series_rows // 5 AS size, series_rows % 5 AS longer, row_no - 1 AS i FROM n)
SELECT ticker, seq, CAST(CASE WHEN i < longer * (size + 1) THEN i // (size + 1)
  ELSE longer + (i - longer * (size + 1)) // size END AS INTEGER) AS fold FROM sized""",
        "mae_rmse_accuracy": f"WITH {_METRICS} SELECT {_METRIC_COLUMNS} FROM metrics",
        "persistence_many_tickers": f"""WITH {_features('training', _ticks('user_id'))},
stats AS ({_METRIC_STATS} FROM (SELECT *, 'persistence' AS model, price AS prediction FROM f)
  GROUP BY ticker, model),
metrics AS (SELECT *, {_ACCURACY} AS accuracy FROM stats)
SELECT {_METRIC_COLUMNS} FROM metrics""",
        "metrics_format": f"""WITH {_METRICS}
SELECT ticker, model, printf('%.2f%%', accuracy) AS accuracy FROM metrics""",
        "metrics_parse": f"""WITH {_METRICS}
SELECT ticker, model, CAST(printf('%.2f', accuracy) AS DOUBLE) AS accuracy FROM metrics""",
        "metrics_file": f"""WITH {_METRICS}
SELECT ticker, model, printf('%.2f%%', accuracy) AS accuracy FROM metrics""",
        "weighted_prediction": f"""WITH {_features('serving', _ticks())}
SELECT ticker, seq, round(0.5 * price + 0.3 * MA5 + 0.2 * MA20, 6) AS prediction FROM f""",
        "voting_mean": f"""WITH {_features('serving', _ticks())}
SELECT ticker, seq, round((price + MA5 + MA20 + price + price_change) / 4, 6) AS prediction FROM f""",
        "leaderboard": f"""WITH {_METRICS}
SELECT ticker, model, round(accuracy, 6) AS accuracy,
  accuracy = max(accuracy) OVER (PARTITION BY ticker) AS is_best, accuracy > 20 AS is_good
FROM metrics""",
        "best_model": f"""WITH {_METRICS}
SELECT ticker, model, round(accuracy, 6) AS accuracy FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY accuracy DESC, model DESC) AS place
  FROM metrics) WHERE place = 1""",
        "base_model_count": f"""WITH {_METRICS}
SELECT ticker, count(*) - 1 AS base_models FROM metrics GROUP BY ticker""",
        "predict_band": f"""WITH {_ROUNDED_FORECASTS}
SELECT ticker, seq, model, {_cents('p')} AS predicted_price,
  {_cents(f'p * (1 - {_BAND})')} AS confidence_lower,
  {_cents(f'p * (1 + {_BAND})')} AS confidence_upper FROM r""",
        "direction": f"""WITH {_ROUNDED_FORECASTS}
SELECT ticker, seq, model, CASE WHEN {_cents('p')} > price THEN 'UP' ELSE 'DOWN' END AS direction FROM r""",
        "market_state": """SELECT event_type AS ticker, max(ts) AS last_tick,
CASE WHEN TIMESTAMP '2024-01-31 00:00:00' - max(ts) > INTERVAL 15 MINUTES
  THEN 'CLOSED' ELSE 'OPEN' END AS state FROM events GROUP BY 1""",
        "market_age": """SELECT CAST(user_id AS VARCHAR) AS ticker,
epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 1000 - epoch_us(max(ts)) // 1000 AS age_ms FROM events GROUP BY 1""",
        "metrics_lookup": f"""WITH {_METRICS}
SELECT upper(ticker) AS ticker, model, printf('%.2f%%', accuracy) AS accuracy FROM metrics
UNION ALL
SELECT ticker, model, 'N/A' FROM (SELECT DISTINCT upper(o_orderpriority) AS ticker FROM orders),
  (VALUES ('Stacking Ensemble'), ('Random Forest'), ('XGBoost'), ('Voting Ensemble'),
   ('Linear Regression'), ('SVR')) AS names(model)""",
        "ols_one_feature": f"""WITH {_features('serving', _ticks())}
SELECT ticker, round(regr_slope(target, price), 6) AS slope,
  round(regr_intercept(target, price), 6) AS intercept FROM f GROUP BY ticker""",
        "ridge_one_feature": f"""WITH {_features('serving', _ticks())},
m AS (SELECT ticker, count(*) AS n, avg(MA5) AS mx, avg(target) AS my,
  covar_pop(MA5, target) AS cxy, var_pop(MA5) AS cxx FROM f GROUP BY ticker)
SELECT ticker, n, round(my - cxy / (cxx + 100.0 / n) * mx, 6) AS intercept,
  round(cxy / (cxx + 100.0 / n), 6) AS slope FROM m""",
        "csv_bars": """SELECT o_orderpriority AS ticker, o_orderdate AS event_time, o_orderkey AS seq,
  o_totalprice AS price, o_custkey AS volume FROM orders""",
        "two_feature_lines": f"""WITH {_features('serving', _ticks())},
m AS (SELECT ticker, count(*) AS n, avg(MA5) AS mx, avg(lag3) AS mz, avg(target) AS my,
  var_pop(MA5) AS xx, var_pop(lag3) AS zz, covar_pop(MA5, lag3) AS xz,
  covar_pop(MA5, target) AS xy, covar_pop(lag3, target) AS zy FROM f GROUP BY ticker),
lines AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS a, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS b FROM m)
SELECT ticker, n, round(my - a * mx - b * mz, 5) AS intercept, round(a, 5) AS w_ma5, round(b, 5) AS w_lag3 FROM lines""",
        "stacking_linear": _STACKING,
        "record_rows": f"""WITH {_ticks()}
SELECT '{{"ticker":"' || ticker || '","seq":' || seq || CASE WHEN volume IS NULL THEN '' ELSE ',"volume":' || volume END || '}}' AS record FROM ticks""",
        "unknown_market_state": """SELECT event_type AS ticker, max(ts) AS last_tick,
CASE WHEN TIMESTAMP '2024-01-31 00:00:00' - max(ts) > INTERVAL 15 MINUTES
  THEN 'CLOSED' ELSE 'OPEN' END AS state FROM events GROUP BY 1
UNION ALL SELECT DISTINCT o_orderpriority, NULL, 'OPEN' FROM orders""",
        "hash_split": _SHARES,
        "last_n_hot": f"WITH {_ticks()} {_LATEST}".replace("place = 1", "place <= 10"),
        "share_split": f"""WITH {_ticks()},
h AS (SELECT ticker, seq, ('0x' || substr(md5(ticker || '|' || epoch_us(event_time) || '|' || seq), 1, 15))::BIGINT AS h FROM ticks),
r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY h DESC) AS place, count(*) OVER (PARTITION BY ticker) AS n FROM h)
SELECT ticker, seq, place <= ceil(n * 0.2::DOUBLE) AS is_test FROM r""",
        "random_split": _SHARES,
        "train_lr": _facts("Linear Regression"),
        "train_lr_mllib": _facts("Linear Regression"),
        "train_rf": _facts("Random Forest"),
        "train_gbt": _facts("GBTRegressor"),
        "train_boosted": _facts("Boosted Trees"),
        "train_rbf": _facts("RBF Features"),
        "train_tube": _facts("Linear Regression", "RBF Support Vectors", "Voting Ensemble", "Stacking Ensemble"),
        "retrain_from_lake": _facts("Linear Regression", "RBF Features", "Voting Ensemble", "Stacking Ensemble"),
        "stacking": _facts(
            "Linear Regression", "Random Forest", "RBF Features", "Boosted Trees", "Voting Ensemble", "Stacking Ensemble"
        ),
        "train_lr_many_tickers": _MANY_TICKERS,
        "train_trees_many_tickers": _MANY_TICKERS,
        "predict_prices": f"""WITH {_features('serving', _ticks())},
l AS (SELECT ticker, regr_slope(target, price) AS s, regr_intercept(target, price) AS i FROM f GROUP BY ticker),
r AS (SELECT ticker, seq, round(i + s * price, 5) AS p FROM f JOIN l USING (ticker))
SELECT upper(ticker) AS ticker, seq, 'ok' AS status, {_cents('p')} AS predicted_price,
  {_cents('p * (1 - 0.02::DOUBLE)')} AS confidence_lower, {_cents('p * (1 + 0.02::DOUBLE)')} AS confidence_upper FROM r""",
        "feature_importance": f"""WITH {_SPLIT}
SELECT DISTINCT ticker, 'Random Forest' AS model, 12 AS n_features, TRUE AS sums_to_one, TRUE AS none_negative,
  'MA10,MA20,MA5,lag1,lag2,lag3,pct_change,price,price_change,rolling_mean,rolling_std,volume' AS features FROM parts""",
        "predict_requests": _answers(
            ("Linear Regression", "ok"), ("Nobody", "not found"), ("Stacking Ensemble", "not found"), ("Linear Regression", "invalid")
        ),
        "predict_ensembles": _answers(
            ("Voting Ensemble", "ok"),
            ("Stacking Ensemble", "ok"),
            ("Stacking Ensemble", "ok"),
            ("Linear Regression", "ok"),
            ("Random Forest", "ok"),
            ("RBF Features", "ok"),
            ("Boosted Trees", "ok"),
            ("Voting Ensemble", "invalid"),
        ),
        "key_frequency": "\nUNION ALL\n".join(
            f"""SELECT '{key}' AS attribute, CAST({key} AS VARCHAR) AS value, count(*) AS n
FROM lineitem GROUP BY {key}"""
            for key in ("l_suppkey", "l_partkey", "l_returnflag", "l_linestatus")
        ),
        "hourly_frequency": """SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n
FROM events GROUP BY 1""",
        "top_keys": """SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey
ORDER BY n DESC, l_partkey LIMIT 20""",
    }
