import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tiermill import configure_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure_session(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def cfg(spark):
    """A pipeline of its own, fed from a landing folder."""
    from verification.inputs import fresh_config

    return fresh_config(spark, message_format="text")


@pytest.fixture
def land(spark, cfg):
    """Put lines into the landing folder."""

    def put(*lines: str) -> None:
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(
            cfg.message_path
        )

    return put


EVENT = (
    '{{"timestamp":{ms},"user_id":"{user}","upload_speed":{up},"download_speed":{down},'
    '"latency":{latency},"location":"{place}"}}'
)


@pytest.fixture
def event():
    def line(ms=1721414400000, user="u1", up=1.5, down=2.5, latency=3.5, place="London") -> str:
        return EVENT.format(ms=ms, user=user, up=up, down=down, latency=latency, place=place)

    return line
