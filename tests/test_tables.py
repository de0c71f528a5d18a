"""Tables kept beside a stream: one read for several sinks, summary by day, compaction, feature table."""

import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from tickloom.operators import clean
from tickloom.operators.features import SERVING, TRAINING, features
from tickloom.plans import feature_table, serve
from tickloom.schema import ENVELOPE_SCHEMA, FEATURES
from tickloom.sources import lake
from tickloom.sources.versions import Part, Versions
from tickloom.streaming import sinks

ONCE = {"availableNow": True}


def message(ticker, minute, price, offset, partition=0):
    text = f"2026-05-{1 + minute // 1440:02d} {minute // 60 % 24:02d}:{minute % 60:02d}:00"
    body = json.dumps({"timestamp": text, "ticker": ticker, "price": price, "volume": 5})
    return (None, body.encode(), f"stock_{ticker}", partition, offset, None, 0)


def bad(value, offset):
    return (None, value and value.encode(), "stock_X", 3, offset, None, 0)


def add(spark, source, rows):
    spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(source)


def run(spark, source, root, checkpoint, **options):
    stream = spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    query = sinks.start(stream, root, checkpoint, ONCE, **options)
    query.awaitTermination()


def made(n=400, seed=2):
    """Messages of three tickers over some days, in random order."""
    dice, rows = random.Random(seed), []
    for i in range(n):
        ticker = dice.choice(["A", "A", "A", "B", "C"])
        rows.append(message(ticker, dice.randrange(9 * 1440) if ticker != "C" else i % 40, round(dice.uniform(1, 99), 2), i))
    dice.shuffle(rows)
    return rows


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / d) for d in ("in", "lake", "offsets", "features")]


def all_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check_days(spark, root):
    assert all_rows(sinks.days(spark, root)) == all_rows(sinks.by_day(sinks.ticks(spark, root)))


REJECTED = [("no json", "no JSON"), ("{}", "no ticker"), (None, "no value"), ('{"ticker": "A", "timestamp": "2026-05-01"}', "no price"), ('{"ticker": "A", "price": 1, "timestamp": "soon"}', "no time")]


def test_one_read_feeds_all_tables(spark, places):
    source, root, checkpoint, _ = places
    rows = made()
    for k in range(4):
        add(spark, source, rows[k::4] + [bad(REJECTED[k][0], 10_000 + k)])
    run(spark, source, root, checkpoint)
    run(spark, source, root, checkpoint)
    assert sinks.ticks(spark, root).count() == 400
    assert sinks.ticks(spark, root).select("seq").distinct().count() == 400
    assert {(r["value"], r["topic"], r["partition"], r["offset"], r["reason"]) for r in sinks.rejects(spark, root).collect()} == {(v, "stock_X", 3, 10_000 + k, why) for k, (v, why) in enumerate(REJECTED[:4])}
    assert [p.batch for p in Versions(spark, root).parts()] == [0, 1, 2, 3]
    check_days(spark, root)


def test_every_reject_has_its_reason(spark):
    rows = spark.createDataFrame([bad(v, i) for i, (v, _) in enumerate(REJECTED)] + [message("A", 1, 2.0, 9)], ENVELOPE_SCHEMA)
    got = {r["offset"]: r["reason"] for r in sinks.judged(rows).collect()}
    assert got == {**{i: why for i, (_, why) in enumerate(REJECTED)}, 9: None}


@pytest.mark.parametrize("table", [sinks.TICKS, sinks.REJECTS])
def test_a_stop_between_the_tables_adds_nothing_twice(spark, places, table):
    source, root, checkpoint, _ = places
    rows = made(60)
    for k in range(3):
        add(spark, source, rows[k::3] + [bad("no json", 10_000 + k)])
    seen = []

    def stop(written):
        seen.append(written)
        if len(seen) > 2 and written == table:
            raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        run(spark, source, root, checkpoint, after=stop)
    # Nothing of the batch that stopped is seen, in any table.
    assert sinks.ticks(spark, root).count() < 60
    assert sinks.ticks(spark, root).count() == 20 * sinks.rejects(spark, root).count()
    check_days(spark, root)
    run(spark, source, root, checkpoint)
    assert sinks.ticks(spark, root).count() == 60 and sinks.rejects(spark, root).count() == 3
    check_days(spark, root)


def test_a_batch_that_is_listed_is_not_written_again(spark, places):
    _, root, _, _ = places
    rows = spark.createDataFrame(made(20), ENVELOPE_SCHEMA)
    sinks._batch(root)(rows, 0)
    sinks._batch(root)(rows, 0)
    assert sinks.ticks(spark, root).count() == 20


def test_the_summary_answers_as_the_lake_does(spark, places):
    source, root, checkpoint, _ = places
    rows = made()
    for k in range(3):
        add(spark, source, rows[k::3])
    run(spark, source, root, checkpoint)
    ticks, days = sinks.ticks(spark, root), sinks.days(spark, root)
    assert all_rows(clean.latest(ticks, days)) == all_rows(clean.latest(ticks))
    assert all_rows(serve.recent(ticks, 3, summary=days)) == all_rows(serve.recent(ticks, 3))
    now = "2026-05-09 23:00:00"
    assert all_rows(serve.market_state(ticks, now, summary=days)) == all_rows(serve.market_state(ticks, now))
    # A late tick, for a ticker that had none that day, and a new last one.
    add(spark, source, [message("C", 3000, 1.0, 900), message("B", 20 * 1440, 2.0, 901)])
    run(spark, source, root, checkpoint)
    ticks, days = sinks.ticks(spark, root), sinks.days(spark, root)
    assert all_rows(clean.latest(ticks, days)) == all_rows(clean.latest(ticks))
    assert all_rows(serve.recent(ticks, 3, summary=days)) == all_rows(serve.recent(ticks, 3))
    plan = serve.market_state(ticks, now, summary=days)._jdf.queryExecution().optimizedPlan().toString()
    assert "price" not in plan


def test_batches_of_a_query_have_files_for_their_messages(spark, tmp_path, monkeypatch):
    from tickloom.plans import catalog

    monkeypatch.setattr(catalog, "ROWS_PER_INPUT", 60)
    monkeypatch.setattr(catalog, "work_path", lambda _, label: str(tmp_path / label))
    events = spark.range(1000).selectExpr("id event_id", "timestamp_ntz'2026-05-01 09:30:00' + make_interval(0, 0, 0, 0, 0, id) ts", "'view' event_type", "double(id) value", """'{"k": 1}' props""")
    events.write.parquet(str(tmp_path / "events.parquet"))
    root = catalog._tables(spark, str(tmp_path))
    assert len(list((tmp_path / "messages").glob("*.parquet"))) == 20
    parts = Versions(spark, root).parts()
    assert [p.batch for p in parts] == [0, 1, 2, 3] and sum(p.rows for p in parts) == 1000
    assert sinks.ticks(spark, root).select("seq").distinct().count() == 1000


# compaction


def files(spark, root, name):
    return {f for f in sinks.ticks(spark, root).inputFiles() if f"part={name}/" in f}


def test_compaction_beside_a_stream_loses_and_doubles_nothing(spark, places):
    source, root, checkpoint, _ = places
    rows = made(300)
    for k in range(6):
        add(spark, source, rows[k::6] + [bad("no json", 10_000 + k)])
    done = threading.Event()

    def stream():
        run(spark, source, root, checkpoint)
        done.set()

    worker = threading.Thread(target=stream)
    worker.start()
    while not done.is_set():
        sinks.compact(spark, root, large=120)
        counts = sinks.ticks(spark, root)
        assert counts.count() == counts.select("seq").distinct().count()
    worker.join()
    sinks.compact(spark, root, large=120)
    assert sinks.ticks(spark, root).count() == 300 == sinks.ticks(spark, root).select("seq").distinct().count()
    assert sinks.rejects(spark, root).count() == 6
    check_days(spark, root)
    # The stream goes on after its batches have been packed.
    add(spark, source, [message("A", 5, 1.0, 5000)])
    run(spark, source, root, checkpoint)
    assert sinks.ticks(spark, root).count() == 301


def test_large_parts_are_not_rewritten(spark, places):
    _, root, _, _ = places
    rows = made(300)
    for k, (low, high) in enumerate([(0, 200), (200, 230), (230, 260), (260, 300)]):
        sinks._batch(root)(spark.createDataFrame(rows[low:high], ENVELOPE_SCHEMA), k)
    before = files(spark, root, "batch-0")
    assert len(sinks.compact(spark, root, large=150)) == 1
    parts = Versions(spark, root).parts()
    assert [p.name.split("-")[0] for p in parts] == ["batch", "packed"] and parts[1].of == ("batch-1", "batch-2", "batch-3")
    assert before and files(spark, root, "batch-0") == before
    assert sinks.compact(spark, root, large=150) == []
    assert sinks.ticks(spark, root).count() == 300
    gone = Versions(spark, root).remove_unread([sinks.TICKS, sinks.REJECTS, sinks.DAYS], keep=1)
    assert {g.split("part=")[1] for g in gone} == {"batch-1", "batch-2", "batch-3"}
    assert sinks.ticks(spark, root).count() == 300
    check_days(spark, root)


def test_writers_that_meet_take_turns(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"))

    def edits(k):
        for i in range(5):
            versions.change(lambda now, i=i: [*now, Part(f"{k}-{i}", 1)])

    workers = [threading.Thread(target=edits, args=(k,)) for k in range(4)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    parts = [p.name for p in versions.parts()]
    assert sorted(parts) == sorted(f"{k}-{i}" for k in range(4) for i in range(5)) and versions.latest() == 19


# feature table


def same_features(spark, root, table, profile):
    names = ["ticker", "event_time", "seq", *FEATURES, "target"]
    want = all_rows(features(sinks.ticks(spark, root), profile).select(*names))
    got = all_rows(feature_table.read(spark, table).select(*names))
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-12, nan_ok=True)


@pytest.mark.parametrize("profile", [SERVING, TRAINING])
@pytest.mark.parametrize("order", ["in time", "late", "shuffled"])
def test_the_table_equals_the_features_of_the_whole_lake(spark, places, profile, order):
    _, root, _, table = places
    rows = sorted(made(500, seed=7), key=lambda r: r[1])
    if order == "shuffled":
        random.Random(3).shuffle(rows)
    batches = [rows[:200], rows[200:350], rows[350:]]
    if order == "late":
        batches = [rows[:80] + rows[120:400], rows[400:], rows[80:120]]
    assert feature_table.update(spark, root, table, profile) is None
    for k, batch in enumerate(batches):
        sinks._batch(root)(spark.createDataFrame(batch, ENVELOPE_SCHEMA), k)
        if k != 1 or order == "late":
            feature_table.update(spark, root, table, profile)
            same_features(spark, root, table, profile)
    assert feature_table.update(spark, root, table, profile) is None
    sinks.compact(spark, root)
    assert feature_table.update(spark, root, table, profile) is None
    same_features(spark, root, table, profile)


def test_an_update_reads_and_writes_only_the_days_it_touches(spark, places):
    _, root, _, table = places
    # Twenty ticks an hour, for ten days of one ticker.
    rows = [message("A", m, 1.0 + m % 7, m) for m in range(0, 10 * 1440, 3)]
    sinks._batch(root)(spark.createDataFrame(rows, ENVELOPE_SCHEMA), 0)
    feature_table.update(spark, root, table)
    sinks._batch(root)(spark.createDataFrame([message("A", 3 * 1440 + 700, 5.0, 99_999)], ENVELOPE_SCHEMA), 1)
    part = feature_table.update(spark, root, table)
    again = Versions(spark, table).read(feature_table.DAYS, feature_table._DAY_SCHEMA, [part])
    assert again.count() == 3
    days = sinks.days(spark, root)
    new = days.where("n = 481").select("ticker", "day")
    assert new.count() == 1
    assert feature_table.touched(days.select("ticker", "day", "n"), new, SERVING).count() == 5
    same_features(spark, root, table, SERVING)


# lakes of both kinds


def test_a_lake_of_older_and_newer_files_keeps_all_rows(spark, tmp_path):
    path = str(tmp_path / "lake")
    times = [f"2026-05-01 09:{m}:00" for m in range(10, 20)]
    old = spark.createDataFrame([(t, i, 1.0, 5, "A") for i, t in enumerate(times[:5])], "timestamp string, seq long, price double, volume long, ticker string")
    new = spark.createDataFrame([(t, i + 5, 1.0, 5, "A") for i, t in enumerate(times[5:])], old.schema)
    lake.write(old, path)
    lake.write(new.withColumn("event_time", F.to_timestamp("timestamp")), path)
    got = lake.scan(spark, path)
    assert got.count() == 10 and got.where("event_time IS NULL").isEmpty()
    assert clean.last_n(got, 10).count() == 10
    assert [r["seq"] for r in clean.latest(got).collect()] == [9]
    plan = got.where("event_time >= TIMESTAMP '2026-05-01 09:16:00'")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_time" in plan
