import math
import random

import pytest
from brute import close, features_of
from pyspark.sql import functions as F

from tickloom.operators import clean, series
from tickloom.operators.features import SERVING, TRAINING, features
from tickloom.plans import serve

PROFILES = pytest.mark.parametrize("profile", [SERVING, TRAINING], ids=["serving", "training"])


def rows_of(df):
    return [row.asDict() for row in df.collect()]


def walk(ticker, n, seed=0, start_seq=0, step=1.0):
    draw = random.Random(seed)
    price, rows = 100.0, []
    for i in range(n):
        price = round(max(1.0, price + draw.uniform(-1, 1)), 2)
        rows.append((ticker, i * step, start_seq + i, price, draw.randrange(1, 1000)))
    return rows


@PROFILES
def test_series_of_all_short_lengths(make_ticks, profile):
    rows = [r for n in (1, 4, 5, 19, 20, 24, 25, 26, 60) for r in walk(f"T{n}", n, seed=n)]
    ticks = make_ticks(rows)
    got = rows_of(features(ticks, profile))
    close(got, features_of(rows_of(ticks), profile))
    lost = 24 if profile is SERVING else 4
    assert sum(r["ticker"] == "T25" for r in got) == 25 - lost
    assert sum(r["ticker"] == "T24" for r in got) == 24 - lost


@PROFILES
def test_unusual_prices(make_ticks, profile):
    rows = walk("A", 200, seed=3)
    odd = {30: 0.0, 31: 0.0, 60: None, 90: math.nan, 120: math.inf, 121: 5.0}
    rows = [(t, m, s, odd.get(s, p), None if s == 150 else v) for t, m, s, p, v in rows]
    rows += [(None, 1.0, 1, 5.0, 5), ("B", None, 1, 5.0, 5)]
    ticks = make_ticks(rows)
    got = rows_of(features(ticks, profile))
    want = features_of(rows_of(ticks), profile)
    if profile is TRAINING:
        # Windows around an infinite price have no deviation.
        want = [r for r in want if not (120 <= r["seq"] < 140)]
    close(got, want)
    after_zero = [r for r in got if r["seq"] == 32]
    assert [r["pct_change"] for r in after_zero] == ([math.inf] if profile is SERVING else [])


@PROFILES
def test_ties_are_ordered_by_seq(make_ticks, profile):
    rows = [("A", float(i // 7), 99 - i, float(i), i + 1) for i in range(90)]
    ticks = make_ticks(rows)
    close(rows_of(features(ticks, profile)), features_of(rows_of(ticks), profile))


@pytest.mark.parametrize("profile, max_rows", [(SERVING, 5), (TRAINING, 25), (SERVING, 200)])
def test_cells_do_not_change_the_result(make_ticks, profile, max_rows):
    rows = walk("A", 700, seed=1) + walk("B", 30, seed=2) + walk("C", 26, seed=4, step=0.001)
    # D: most ticks at one instant, then a long gap.
    rows += [("D", 5.0 if i > 20 else i * 0.1, i, 50.0 + i % 13, i + 1) for i in range(300)]
    rows += [("D", 100_000.0 + i, 1000 + i, 70.0 + i % 7, i + 1) for i in range(60)]
    ticks = make_ticks(rows).repartition(5)
    plain = rows_of(features(ticks, profile))
    close(rows_of(features(ticks, profile, max_rows)), plain)


def test_cells_hold_runs_of_the_series_and_are_small(make_ticks):
    rows = [("D", 5.0 if i > 20 else i * 0.1, i * 3, 50.0, 1) for i in range(3000)]
    placed = series.place_in_cells(make_ticks(rows), 100, series.Size(3000, 3000))
    cells = {}
    for row in sorted(placed.collect(), key=lambda r: (r.event_time, r.seq)):
        cells.setdefault((row.cell_time, row.cell_seq), []).append((row.event_time, row.seq))
    runs = list(cells.values())
    assert max(map(len, runs)) <= 100
    assert list(cells) == sorted(cells)
    assert all(a[-1] < b[0] for a, b in zip(runs, runs[1:]))


def test_equal_keys_give_the_same_rows_at_every_size(make_ticks):
    rows = [("A", 1.0, 7, float(i % 9), 1) for i in range(50)] + [("A", 2.0 + i, i, 5.0, i) for i in range(40)]
    ticks = make_ticks(rows).repartition(5)
    got = [sorted(map(tuple, features(ticks, max_rows=m).collect())) for m in (10, 10_000)]
    assert got[0] == got[1] and len(got[0]) > 30
    numbers = [sorted(map(tuple, series.number_rows(ticks, m).collect())) for m in (10, 10_000)]
    assert numbers[0] == numbers[1] and len(numbers[0]) == 90


def test_ticks_without_seq_are_refused_at_every_size(make_ticks):
    ticks = make_ticks(walk("A", 30) + [("A", 100.0, None, 5.0, 1)])
    jobs = [lambda m=m, f=f: f(ticks, max_rows=m).collect() for m in (5, 10_000) for f in (features, series.number_rows)]
    jobs += [lambda n=n: clean.last_n(ticks, n).collect() for n in (3, 2_000)]
    jobs += [lambda: clean.latest(ticks).collect(), lambda: clean.first_per_time(ticks).collect()]
    for job in jobs:
        with pytest.raises(Exception, match="seq"):
            job()


def test_rows_without_a_time_are_no_part_of_a_series(make_ticks):
    ticks = make_ticks(walk("A", 30) + [("A", None, 99, 5.0, 1), (None, 1.0, 98, 5.0, 1)])
    assert {clean.last_n(ticks, n).count() for n in (1000, 1001)} == {30}
    assert clean.latest(ticks).count() == 1


def test_one_stale_ticker_does_not_widen_the_scan(make_ticks, spark, tmp_path):
    day = 24 * 60
    rows = [("OLD", float(i), i, 1.0, 1) for i in range(30)]
    rows += [("NEW", float(d * day + i), d * 100 + i, 1.0, 1) for d in range(1, 900) for i in range(2)]
    path = str(tmp_path / "lake")
    make_ticks(rows).repartitionByRange(60, "event_time").write.parquet(path)
    ticks = spark.read.parquet(path)
    ranges = series.day_ranges(spark.createDataFrame([(20_000, 20_000), (20_898, 20_899)], "low long, high long"))
    assert ranges == [(20_000, 20_000), (20_898, 20_899)]
    assert series.day_ranges(spark.createDataFrame([(i * 2, i * 2) for i in range(40)] + [(500, 501)], "low long, high long"), 2) == [(0, 78), (500, 501)]
    assert {(r.ticker, r.seq) for r in clean.latest(ticks).collect()} == {("OLD", 29), ("NEW", 89_901)}
    read = series.in_days(ticks, series.day_ranges(ticks.groupBy("ticker").agg(F.max(series.day_number(ticks)).alias("high")).select(F.col("high").alias("low"), "high")))
    assert read.select(F.input_file_name()).distinct().count() <= 4


def test_row_numbers_by_cells(make_ticks):
    rows = walk("A", 500) + walk("B", 20)
    ticks = make_ticks(rows).repartition(3)
    for limit in (7, 10_000):
        numbered = series.number_rows(ticks, limit)
        assert {(r.ticker, r.seq, r.row_no, r.series_rows) for r in numbered.collect()} == {
            (t, s, s + 1, 500 if t == "A" else 20) for t, _, s, _, _ in rows
        }


def test_one_shuffle_and_one_sort(make_ticks):
    plan = features(make_ticks(walk("A", 50)), size=series.Size(50, 50))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange") == 1
    assert plan.toString().count("Sort [") == 1


def test_tasks_grow_with_the_data(make_ticks):
    ticks = make_ticks(walk("A", 50))
    for total, tasks in ((100, 2), (1_000 * series.ROWS_PER_TASK, 1_000)):
        made = features(ticks, size=series.Size(50, total))
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        assert "hashpartitioning(ticker#" in plan and f", {tasks})" in plan


def test_zoneless_times_work_the_same(make_ticks):
    rows = walk("A", 300, seed=9)
    ticks = make_ticks(rows)
    zoneless = ticks.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    want = {(r["seq"], round(r["MA20"], 9)) for r in rows_of(features(ticks))}
    for made in (features(zoneless), features(zoneless, max_rows=40)):
        assert {(r["seq"], round(r["MA20"], 9)) for r in rows_of(made)} == want
    assert {r.seq for r in serve.recent(zoneless, 10).collect()} == set(range(285, 295))


def test_micros_of_zoneless_times_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "SELECT explode(array(timestamp_ntz'2026-03-08 02:30:00.25', "
            "timestamp_ntz'2026-03-08 03:10:00', timestamp_ntz'1969-12-31 23:59:59.5')) AS event_time"
        )
        got = [r[0] for r in df.select(series.micros(df)).collect()]
        assert got == [1772937000250000, 1772939400000000, -500000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def brute_recent(ticks, n, profile=SERVING):
    best = {}
    for row in sorted(features_of(rows_of(ticks), profile), key=lambda r: r["seq"]):
        best.setdefault((row["ticker"], row["event_time"]), row)
    out = {}
    for row in sorted(best.values(), key=lambda r: (r["event_time"], r["seq"])):
        out.setdefault(row["ticker"], []).append(row)
    return [r for group in out.values() for r in group[-n:]]


@pytest.mark.parametrize("profile, max_rows", [(SERVING, 40), (TRAINING, 1_000_000)])
def test_recent_reads_back_as_far_as_needed(make_ticks, profile, max_rows):
    day = 1440.0
    # A: the last tick repeated over and over; B: sparse; C: gaps in the volume.
    rows = [("A", i * day / 4, i, 50.0 + i % 9, 1) for i in range(300)]
    rows += [("A", 300 * day / 4, 300 + i, 70.0, 1) for i in range(150)]
    rows += [("B", i * day, i, 10.0 + i % 5, 2) for i in range(40)]
    rows += [("C", i * 30.0, i, 20.0 + i % 7, 3 if i < 100 else None) for i in range(400)]
    rows += [("D", float(i), i, 30.0, 1) for i in range(10)]
    ticks = make_ticks(rows).repartition(3)
    got = rows_of(serve.recent(ticks, 15, profile, max_rows))
    close(got, brute_recent(ticks, 15, profile))


def test_features_see_duplicates_that_are_dropped_afterwards(make_ticks):
    rows = [("A", float(i), i, float(i), 1) for i in range(40)]
    rows += [("A", 39.0, 40 + i, 39.0, 1) for i in range(10)]
    last = max(serve.recent(make_ticks(rows), 100).collect(), key=lambda r: r.event_time)
    assert last.seq == 39 and last.target == 39.0 and last.MA5 == 37.0


def test_latest_and_last_n(make_ticks):
    ticks = make_ticks(walk("A", 30) + walk("B", 3) + [("A", 29.0, 77, 1.0, 1)])
    assert {(r.ticker, r.seq) for r in clean.latest(ticks).collect()} == {("A", 77), ("B", 2)}
    assert {(r.ticker, r.seq) for r in clean.last_n(ticks, 2).collect()} == {
        ("A", 77),
        ("A", 29),
        ("B", 2),
        ("B", 1),
    }
    assert [r.seq for r in clean.last_of_series(ticks, "A", 3).collect()] == [28, 29, 77]


def test_last_n_beyond_the_top_n_limit(make_ticks):
    ticks = make_ticks(walk("A", 1300) + walk("B", 5))
    got = {(r.ticker, r.seq) for r in clean.last_n(ticks, 1200).collect()}
    assert got == {("A", i) for i in range(100, 1300)} | {("B", i) for i in range(5)}


@pytest.mark.parametrize("back, ahead", [(2, 0), (0, 3), (4, 1)])
def test_any_bounded_window_can_go_by_cells(make_ticks, back, ahead):
    ticks = make_ticks(walk("A", 200) + walk("B", 7)).repartition(3)

    def compute(rows, window):
        frame = window.rowsBetween(-back, ahead)
        return rows.select("*", F.sum("seq").over(frame).alias("total"))

    got = series.by_series(ticks, compute, back, ahead, max_rows=9)
    assert got.columns == [*ticks.columns, "total"]
    assert {(r.ticker, r.seq, r.total) for r in got.collect()} == {
        (t, i, sum(j for j in range(i - back, i + ahead + 1) if 0 <= j < n))
        for t, n in (("A", 200), ("B", 7))
        for i in range(n)
    }


def test_last_n_is_limited_before_the_shuffle(make_ticks):
    plan = clean.last_n(make_ticks(walk("A", 30)), 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_min_rows(make_ticks):
    ticks = make_ticks(walk("A", 9) + walk("B", 10))
    assert {r.ticker for r in clean.min_rows(ticks, 10).collect()} == {"B"}


def test_request_defaults(spark):
    row = dict.fromkeys(
        "lag1 lag2 lag3 MA5 MA10 MA20 rolling_mean rolling_std price_change pct_change".split(), None
    )
    schema = "price double, volume long, " + ", ".join(f"{name} double" for name in row)
    data = [(7.0, None, *row.values()), (0.0, 1, *row.values()), (None, 1, *row.values())]
    (got,) = clean.request_defaults(spark.createDataFrame(data, schema)).collect()
    assert got.asDict() == {
        **{name: 0.0 for name in row},
        **{name: 7.0 for name in ("price", "MA5", "MA10", "MA20", "rolling_mean")},
        "volume": 0,
    }
