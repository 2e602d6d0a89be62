import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="listenlab-test-ckpt-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("listenlab-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def interactions(spark, rows):
    """Hand-written interaction rows -> contract frame.
    rows: (uid, item_id, timestamp, is_organic, event_type, ratio, length)."""
    from listenlab.sources import to_contract

    schema = ("uid long, item_id long, timestamp long, is_organic int, event_type string, "
              "played_ratio_pct double, track_length_seconds double")
    return to_contract(spark.createDataFrame(rows, schema))


def listen(uid, item, ts, organic=1, ratio=60.0, length=200.0):
    return (uid, item, ts, organic, "listen", ratio, length)


def react(uid, item, ts, kind="like", organic=1):
    return (uid, item, ts, organic, kind, None, None)
