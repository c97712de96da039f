import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        # Not UTC on purpose: no result may depend on it.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """Build a table from a list of dicts, all columns nullable text unless a schema is given."""

    def build(records, schema=None):
        names = list(dict.fromkeys(k for r in records for k in r))
        schema = schema or ", ".join(f"`{n}` string" for n in names)
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)

    return build
