import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakeweave.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def values(spark):
    """Values of one expression over a column of inputs, in input order."""

    def run(inputs, make, kind="string"):
        df = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
        from pyspark.sql import functions as F

        return [r.v for r in df.select("i", make(F.col("x")).alias("v")).orderBy("i").collect()]

    return run
