import json

import pytest
from pyspark.sql import functions as F

from tickloom.operators.features import features
from tickloom.schema import ENVELOPE_SCHEMA, MESSAGE_SCHEMA
from tickloom.sources import kafka, lake
from tickloom.streaming import ingest

ONCE = {"availableNow": True}


def body(ticker="AAPL", minute=30, price=1.5, volume=10, **more):
    fields = {
        "timestamp": f"2026-05-01 09:{minute}:00-04:00",
        "ticker": ticker,
        "price": price,
        "volume": volume,
        **more,
    }
    return json.dumps(fields)


def envelope(spark, values, first=0):
    rows = [
        (None, None if v is None else v.encode(), "stock_AAPL", 1, first + i, None, 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def run(spark, source, lake_dir, checkpoint, rejects_to=None):
    stream = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(source)
    started = ingest.start_ingest(stream, lake_dir, checkpoint, rejects_to, ONCE)
    ingest.run_until_stopped(started)


def add(spark, source, values, first=0):
    envelope(spark, values, first).coalesce(1).write.mode("append").parquet(source)


BAD = [
    "no json",
    "{}",
    None,
    json.dumps({"timestamp": "2026-05-01 09:30:00", "ticker": "AAPL", "price": "high"}),
    body(timestamp="soon"),
    body(ticker=None),
]


def test_parse_is_permissive(spark):
    values = [body(), body(volume=3_000_000_000, extra=1), body(volume="many"), *BAD]
    got = ingest.parse_ticks(envelope(spark, values)).orderBy("seq").collect()
    assert [r.seq for r in got] == [(1 << 48) + i for i in range(len(values))]
    assert got[0].price == 1.5 and got[0].timestamp == "2026-05-01 09:30:00-04:00"
    assert got[1].volume == 3_000_000_000
    assert got[2].volume is None and got[2].price == 1.5
    assert ingest.accepted(ingest.parse_ticks(envelope(spark, values))).count() == 3
    assert ingest.rejects(ingest.parse_ticks(envelope(spark, values))).count() == len(BAD)


def test_times_are_instants(spark):
    values = [
        body(timestamp="2026-11-01 01:45:00-04:00", price=1.0),
        body(timestamp="2026-11-01 01:15:00-05:00", price=2.0),
    ]
    got = ingest.parse_ticks(envelope(spark, values)).orderBy("event_time").collect()
    assert [r.price for r in got] == [1.0, 2.0]


def test_stream_restart_adds_nothing_twice(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / d) for d in ("in", "lake", "offsets"))
    add(spark, source, [body(minute=m) for m in range(30, 35)])
    run(spark, source, out, checkpoint)
    run(spark, source, out, checkpoint)
    assert lake.scan(spark, out).count() == 5
    add(spark, source, [body("0700", minute=m) for m in range(35, 38)], first=5)
    run(spark, source, out, checkpoint)
    got = lake.scan(spark, out)
    assert {(r.ticker, r.n) for r in got.groupBy("ticker").agg(F.count("*").alias("n")).collect()} == {
        ("AAPL", 5),
        ("0700", 3),
    }
    assert got.select("seq").distinct().count() == 8
    assert lake.scan_ticker(spark, out, "0700").count() == 3
    assert lake.scan_ticker(spark, out, "aapl").count() == 0


def test_new_checkpoint_over_old_output_is_refused(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "lake")
    for i in range(3):
        add(spark, source, [body(minute=30 + i)], first=i)
        run(spark, source, out, str(tmp_path / "offsets"))
    with pytest.raises(ValueError, match="checkpoint"):
        run(spark, source, out, str(tmp_path / "other"))
    run(spark, source, out, str(tmp_path / "offsets"))
    assert lake.scan(spark, out).count() == 3


def test_rejects_go_to_their_own_table(spark, tmp_path):
    source, out, bad = (str(tmp_path / d) for d in ("in", "lake", "bad"))
    add(spark, source, [body(), *BAD])
    run(spark, source, out, str(tmp_path / "offsets"), bad)
    assert lake.scan(spark, out).count() == 1
    kept = spark.read.schema(ingest.REJECT_SCHEMA).parquet(bad).orderBy("offset").collect()
    assert [r.value for r in kept] == BAD and [r.offset for r in kept] == list(range(1, len(BAD) + 1))
    assert {r.reason for r in kept} == {"no JSON", "no ticker", "no value", "no price", "no time"}


def test_without_rejects_everything_reaches_the_lake(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "lake")
    add(spark, source, [body(), *BAD])
    run(spark, source, out, str(tmp_path / "offsets"))
    assert lake.scan(spark, out).count() == 1 + len(BAD)
    assert lake.scan(spark, out).where("ticker IS NULL").count() == 4


def test_missing_lake_is_empty(spark, tmp_path):
    assert lake.is_empty(lake.scan(spark, str(tmp_path / "none")))
    assert lake.is_empty(lake.scan_ticker(spark, str(tmp_path / "none"), "AAPL"))


def test_partition_is_pruned(spark, tmp_path):
    out = str(tmp_path / "lake")
    lake.write(ingest.parse_ticks(envelope(spark, [body(), body("TSLA")])), out)
    plan = lake.scan_ticker(spark, out, "TSLA")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan


def test_compaction_keeps_all_ticks_in_fewer_files(spark, tmp_path):
    small, large = tmp_path / "small", tmp_path / "large"
    values = [body(t, minute=m) for t in ("AAPL", "TSLA") for m in range(10, 40)]
    lake.write(ingest.parse_ticks(envelope(spark, values)).repartition(12), str(small))
    before = lake.scan(spark, str(small))
    lake.compact(before, str(large), files=2)
    after = lake.scan(spark, str(large))
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
    count = lambda folder: len(list(folder.rglob("*.parquet")))
    assert count(large) <= 4 < count(small)


def test_tasks_of_a_compaction_are_bounded(spark, tmp_path, monkeypatch):
    from tickloom.operators.series import ROWS_PER_TASK
    from tickloom.plans import catalog

    assert lake.ROWS_PER_FILE <= ROWS_PER_TASK
    monkeypatch.setattr(catalog, "ROWS_PER_INPUT", 50)
    monkeypatch.setattr(catalog, "work_path", lambda _, label: str(tmp_path / label))
    events = spark.range(1000).selectExpr("id event_id", "timestamp_ntz'2026-05-01 09:30:00' + make_interval(0, 0, 0, 0, 0, id) ts", "'view' event_type", "double(id) value", """'{"k": 1}' props""")
    events.write.parquet(str(tmp_path / "events.parquet"))
    assert catalog.lake_compact(spark, str(tmp_path)).count() == 1000
    # 20 files of 50 ticks, not 8 whatever the number of ticks.
    assert len(list((tmp_path / "lake").rglob("*.parquet"))) == 20


def test_lake_without_seq_is_numbered_once(spark, tmp_path):
    raw = spark.createDataFrame(
        [("2026-05-01 09:30:00-04:00", "0700", 1.0, 5)] * 20,
        "timestamp string, ticker string, price double, volume int",
    )
    numbered = lake.with_seq(raw, str(tmp_path / "numbered"))
    assert numbered.select("seq").distinct().count() == 20
    assert numbered.schema == lake.scan(spark, str(tmp_path / "numbered")).schema
    assert {r.ticker for r in numbered.collect()} == {"0700"}


def test_bars_from_csv(spark, tmp_path):
    (tmp_path / "bars.csv").write_text(
        "Datetime,Open,Close,Volume\n2026-05-01 09:30:00,1,2.5,100\n2026-05-01 09:35:00,2,3.5,200\n"
    )
    bars = lake.read_bars(spark, str(tmp_path / "bars.csv"), "csv", header="true")
    got = lake.bars_to_ticks(
        bars,
        F.lit("AAPL"),
        F.to_timestamp("Datetime"),
        "Close",
        "Volume",
        F.unix_micros(F.to_timestamp("Datetime")),
    )
    assert [(r.ticker, r.price, r.volume) for r in got.orderBy("seq").collect()] == [
        ("AAPL", 2.5, 100),
        ("AAPL", 3.5, 200),
    ]


def test_reader_options():
    assert kafka.reader_options("broker:1") == {
        "kafka.bootstrap.servers": "broker:1",
        "subscribePattern": "stock_.*",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def test_messages_are_read_back(spark):
    ticks = ingest.parse_ticks(envelope(spark, [body("aapl"), body("TSLA", volume=7)]))
    messages = kafka.to_messages(ticks)
    assert {r.topic for r in messages.collect()} == {"stock_AAPL", "stock_TSLA"}
    again = messages.select(F.from_json("value", MESSAGE_SCHEMA).alias("v")).select("v.*")
    assert {tuple(r) for r in again.collect()} == {
        ("2026-05-01 09:30:00-04:00", "AAPL", 1.5, 10),
        ("2026-05-01 09:30:00-04:00", "TSLA", 1.5, 7),
    }
    without_text = kafka.to_messages(ticks.drop("timestamp"))
    back = without_text.select(F.from_json("value", MESSAGE_SCHEMA)["timestamp"].alias("t"))
    assert {r.t for r in back.collect()} == {"2026-05-01 13:30:00.000000Z"}


def test_a_stream_of_messages_goes_on_after_a_stop(spark, make_ticks, tmp_path):
    source, sink, mark = (str(tmp_path / name) for name in ("in", "out", "mark"))
    make_ticks([("a", 1.0, 1, 2.0, 3)]).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)

    def send():
        query = kafka.publish_stream(kafka.to_messages(stream), mark, trigger={"availableNow": True}, form="parquet", path=sink)
        query.awaitTermination()

    send()
    make_ticks([("b", 2.0, 2, 3.0, 4)]).write.mode("append").parquet(source)
    send()
    sent = spark.read.parquet(sink).collect()
    assert sorted(r.topic for r in sent) == ["stock_A", "stock_B"]
    kafka.publish(kafka.to_messages(spark.read.parquet(source)), form="json", path=str(tmp_path / "batch"))
    assert spark.read.json(str(tmp_path / "batch")).count() == 2


def test_a_lake_without_event_time_and_seq(spark, make_ticks, tmp_path):
    path = str(tmp_path / "old")
    rows = [(f"2026-05-01 09:{30 + i // 60:02d}:{i % 60:02d}", 100.0 + i, i, "A") for i in range(60)]
    spark.createDataFrame(rows, "timestamp string, price double, volume int, ticker string").write.partitionBy("ticker").parquet(path)
    ticks = lake.scan(spark, path)
    assert ticks.where("event_time IS NULL").isEmpty() and ticks.count() == 60
    with pytest.raises(Exception, match="seq"):
        features(ticks).collect()
