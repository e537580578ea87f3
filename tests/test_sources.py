import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from contestlab.operators.describe import top_bowlers
from contestlab.plans.load import load_tables
from contestlab.sources import scratch
from contestlab.sources.tables import clean_headers, conform, read_table, typed
from tests.helpers import bag, physical


def test_unusable_tokens_become_null(spark):
    rows = [("1", "NA"), ("4.0", "1"), ("x", ""), (None, "1e3"), (" 7 ", "99999999999")]
    df = spark.createDataFrame(rows, "batsman_runs string, is_wicket string")
    out = typed(df, {"batsman_runs": "int", "is_wicket": "int"})
    assert [tuple(r) for r in out.collect()] == [
        (1, None),
        (4, 1),
        (None, None),
        (None, 1000),
        (7, None),
    ]


def test_long_keys_stay_exact(spark):
    df = spark.createDataFrame([("9007199254740993",)], "match_id string")
    assert typed(df, {"match_id": "bigint"}).first()[0] == 9007199254740993


def test_clean_headers_keep_positions(spark):
    df = spark.createDataFrame([(1, 2)], "` Ball No` int, `Runs Scored ` int")
    assert clean_headers(df).columns == ["ball_no", "runs_scored"]


def test_conform_renames_only_when_present(spark):
    one = spark.createDataFrame([("A vs B",)], "Teams string")
    two = spark.createDataFrame([("A vs B",)], "Team string")
    assert conform(one, "team_performance").columns == ["Team"]
    assert conform(two, "team_performance").columns == ["Team"]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "deliveries.csv"
    path.write_text(
        "bowler,is_wicket,extra,batsman_runs,batter\nB1,1,z,NA,A1\nB2,0,,4,\"Last, First\"\n"
    )
    df = read_table(spark, str(path), "deliveries")
    assert dict(df.dtypes) == {
        "bowler": "string",
        "is_wicket": "int",
        "extra": "string",
        "batsman_runs": "int",
        "batter": "string",
    }
    pruned = df.select("batter", "batsman_runs", "is_wicket")
    assert bag(pruned) == bag(
        spark.createDataFrame(
            [("A1", None, 1), ("Last, First", 4, 0)],
            "batter string, batsman_runs int, is_wicket int",
        )
    )


def test_csv_part_with_other_columns_fails(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("batter,bowler\nA,B\n")
    (folder / "b.csv").write_text("bowler,batter\nB,A\n")
    with pytest.raises(Py4JJavaError, match="header does not conform"):
        read_table(spark, str(folder), "deliveries").collect()


def test_parquet_keeps_its_types(spark, tmp_path):
    path = str(tmp_path / "balls")
    spark.createDataFrame([(0.1, 4)], "`Ball No` double, `Runs Scored` int").write.parquet(path)
    df = read_table(spark, path, "ball_by_ball", fmt="parquet")
    assert df.dtypes == [("ball_no", "double"), ("runs_scored", "int")]


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_table(spark, str(tmp_path / "none.csv"), "matches")


def test_load_tables_normalises_names(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "match_id,team1,team2,toss_winner,winner\n"
        "1,Deccan Chargers,Mumbai Indians,Deccan Chargers,\n"
    )
    (tmp_path / "t.csv").write_text('Team Full Name,Titles\nA,"2 (2012, 2014)"\n')
    tables = load_tables(
        spark, {"matches": str(tmp_path / "m.csv"), "team_info": str(tmp_path / "t.csv")}
    )
    assert tuple(tables["matches"].first()) == (
        1,
        "Sunrisers Hyderabad",
        "Mumbai Indians",
        "Sunrisers Hyderabad",
        None,
    )
    assert tuple(tables["team_info"].first()) == ("A", "2 (2012, 2014)")


def test_written_table_reads_back(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    again = scratch.written(df, "test")
    assert again.dtypes == df.dtypes and bag(again) == bag(df)


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(Session())


def test_layout_depends_on_the_key_only(spark):
    def parts(df):
        return scratch.laid_out(df, "id", 6).rdd.glom().map(lambda p: [r[0] for r in p]).collect()

    few, many = spark.range(0, 100, 1, 2), spark.range(0, 100, 1, 20)
    assert parts(few) == parts(many) and len(parts(few)) == 6


def test_only_whole_numbers_are_whole(spark):
    rows = [("4.0",), ("4.5",), ("1.99",), ("9007199254740993",), (" 7 ",), ("x",), ("1e3",), (None,)]
    df = typed(spark.createDataFrame(rows, "n string"), {"n": "bigint"})
    assert [r[0] for r in df.collect()] == [4, None, None, 9007199254740993, 7, None, 1000, None]

def test_filter_on_a_typed_column_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "typed")
    rows = [("B1", 1, "caught"), ("B2", 0, None)]
    df = spark.createDataFrame(rows, "bowler string, is_wicket int, dismissal_kind string")
    df.write.parquet(path)
    plan = physical(top_bowlers(read_table(spark, path, "deliveries", fmt="parquet")))
    assert "EqualTo(is_wicket,1)" in plan and "IsNotNull(dismissal_kind)" in plan


def test_partitioned_scratch_table(spark):
    df = spark.createDataFrame([(1, "a", 2), (3, "b", 4)], "x int, m string, y int")
    out = scratch.written(df, "parts", by="m")
    assert out.dtypes == df.dtypes and bag(out) == bag(df)
    assert "PartitionFilters: [isnotnull(m" in physical(out.where("m = 'a'"))


def test_scope_deletes_what_was_written_inside(spark, tmp_path):
    """Scratch tables, checkpoints of fit layouts and inner scopes go; what is
    kept stays, and so does what is written outside."""
    import os

    before = set(os.listdir(scratch.scratch_dir(spark).removeprefix("file:")))
    with scratch.scratch_scope(spark) as outer:
        table = scratch.written(spark.range(5), "inside")
        stored = scratch.laid_out(table, "id", 3)
        rows = stored._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
        with scratch.scratch_scope(spark) as inner:
            kept = inner.keep(scratch.written(table, "deeper"), "kept")
        assert kept.count() == stored.count() == 5 and os.path.isdir(rows.removeprefix("file:"))
        assert not os.path.isdir(inner.folder.removeprefix("file:"))
        result = outer.keep(kept.withColumn("x", F.col("id") * 2), "result")
    assert result.count() == 5 and not os.path.isdir(rows.removeprefix("file:"))
    left = set(os.listdir(scratch.scratch_dir(spark).removeprefix("file:"))) - before
    assert len({n for n in left if n.startswith(("result", "inside", "scope"))}) == 1
    with pytest.raises(Exception):
        table.count()


def test_scope_ends_after_an_error(spark):
    with pytest.raises(ZeroDivisionError):
        with scratch.scratch_scope(spark):
            scratch.written(spark.range(1), "lost")
            1 / 0
    assert not scratch._scopes


def test_fit_partitions_depend_on_the_rows_only():
    assert scratch.fit_partitions(0) == scratch.fit_partitions(8_000_000) == 8
    assert scratch.fit_partitions(8_000_001) == 9
