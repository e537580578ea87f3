import glob
import os

import duckdb
import pytest

import __spark_entry__ as registry
from tests.helpers import physical
from tools.check import rows_by_name, same_type

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_twin_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    result = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    assert rows and rows_by_name(df.columns, df.collect()) == rows_by_name(names, rows)
    assert all(same_type(f.dataType.simpleString(), types[f.name]) for f in df.schema)
    plan = physical(df)
    assert "EvalPython" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_flagship(spark):
    df = registry.entry(spark)
    assert df.count() == 1500
    assert {r[0] for r in df.select("recommendation").distinct().collect()} <= {"FIELD", "BAT"}
