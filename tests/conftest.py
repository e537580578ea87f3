import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def matches(spark):
    """Build contests from (team1, team2, winner, ...) rows."""

    def build(rows, **constant):
        names = ["team1", "team2", "winner", "season", "venue", "city"]
        names += ["toss_winner", "toss_decision"]
        full = []
        for i, row in enumerate(rows):
            record = dict(zip(names, [None] * len(names))) | constant | row | {"match_id": i}
            full.append(tuple(record[n] for n in ["match_id", *names]))
        schema = "match_id bigint, " + ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame(full, schema)

    return build
