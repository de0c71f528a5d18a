import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from tickloom.session import build_session

    session = build_session(
        "tickloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def make_ticks(spark):
    """Ticks from (ticker, minute, seq, price, volume) tuples."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(
            rows, "ticker string, minute double, seq long, price double, volume long"
        )
        start = F.lit("2026-05-01 09:30:00").cast("timestamp")
        time = start + F.make_dt_interval(secs=(F.col("minute") * 60).cast("decimal(18,6)"))
        time = F.when(F.col("minute").isNotNull(), time)
        return df.select("ticker", time.alias("event_time"), "seq", "price", "volume")

    return make
