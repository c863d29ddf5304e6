import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("perfwatch-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # tests only: use our own checkpoint folder when the session names none
    if not session.conf.get("spark.checkpoint.dir", None) and session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


VITALS = {"lcp": 1500.0, "cls": 0.02, "inp": 120.0, "ttfb": 350.0}


@pytest.fixture
def page_logs(spark):
    """Page loads from ``load(...)`` records; what a record does not name is unremarkable."""
    def make(records):
        return spark.createDataFrame(records, "event_date date, route string, device_type string, release_version string, "
                                              "lcp_ms double, cls double, inp_ms double, ttfb_ms double")
    return make


def load(day, release, route="/help", device="tablet", **vitals):
    """One page load on the ``day``-th of March 2031 (None: undated)."""
    from datetime import date

    found = VITALS | vitals
    return (date(2031, 3, day) if day else None, route, device, release,
            found["lcp"], found["cls"], found["inp"], found["ttfb"])


@pytest.fixture(name="load")
def load_fixture():
    return load
