"""Contest tables derived from the given star-schema tables.

One contest per order, one delivery per line item. Joins to nation and region
are broadcast: these tables have a fixed 25 and 5 rows at every scale. All
other joins are left to Spark, which sees the file sizes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contestlab.columns import CONTEST
from contestlab.operators.names import normalize_names
from contestlab.operators.rates import team_score_averages
from contestlab.plans.features import training_rows
from contestlab.plans.recommend import request_rows
from contestlab.sources.scratch import written
from contestlab.sources.tables import conform

# Former name -> current name in the derived tables.
NAMES = {
    "NATION_3": "NATION_4",
    "NATION_5": "NATION_6",
    "NATION_7": "NATION_8",
    "NATION_11": "NATION_12",
    "NATION_20": "NATION_21",
    "NATION_22": "NATION_21",
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once per process."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _nations(spark: SparkSession, sf_dir: str, key: str, name: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return F.broadcast(
        nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))
    )


def _contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the names of both sides."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    opponent = (F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("b_key", opponent.cast("int"))
        .withColumnRenamed("c_nationkey", "a_key")
        .join(_nations(spark, sf_dir, "a_key", "team1"), "a_key")
        .join(_nations(spark, sf_dir, "b_key", "team2"), "b_key")
    )


def _with_city(spark: SparkSession, sf_dir: str, contests: DataFrame) -> DataFrame:
    """A region per contest; every sixth contest has none."""
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("city_key"), F.col("r_name").alias("city")
    )
    keyed = contests.withColumn("city_key", F.col("o_orderkey") % 6)
    return keyed.join(F.broadcast(region), "city_key", "left")


def _venue() -> Column:
    return F.concat(F.lit("VENUE_"), (F.col("o_custkey") % 40).cast("string"))


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contest per order, with former names."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    status = F.col("o_orderstatus")
    return _with_city(spark, sf_dir, _contests(spark, sf_dir)).select(
        F.col("o_orderkey").alias("match_id"),
        F.year("o_orderdate").cast("string").alias("season"),
        "city",
        _venue().alias("venue"),
        "team1",
        "team2",
        F.when(F.col("o_custkey") % 2 == 0, F.col("team1"))
        .otherwise(F.col("team2"))
        .alias("toss_winner"),
        F.when(urgent, "bat").otherwise("field").alias("toss_decision"),
        F.when(status == "F", F.col("team1"))
        .when(status == "O", F.col("team2"))
        .alias("winner"),
        F.col("c_name").alias("player_of_match"),
    )


def current_names(contests: DataFrame) -> DataFrame:
    return normalize_names(contests, CONTEST.names, NAMES)


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_names(raw_matches(spark, sf_dir))


def _runs() -> Column:
    return F.col("l_quantity").cast("int") % 7


def player_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with the players; no sides, so no join with the contests."""
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("batter")
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("bowler"), "p_type"
    )
    out = F.col("l_returnflag") == "R"
    return (
        table(spark, sf_dir, "lineitem")
        .join(supplier, "l_suppkey")
        .join(part, "l_partkey")
        .select(
            F.col("l_orderkey").alias("match_id"),
            F.when(F.col("l_linenumber") <= 4, 1).otherwise(2).alias("inning"),
            "batter",
            "bowler",
            _runs().cast("string").alias("batsman_runs"),
            out.cast("int").cast("string").alias("is_wicket"),
            F.when(out & (F.col("l_linestatus") == "F"), F.col("p_type")).alias("dismissal_kind"),
        )
    )


def sides_by_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    contests = _contests(spark, sf_dir)
    return contests.select(F.col("o_orderkey").alias("match_id"), "team1", "team2")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries as text, with the former names of both sides."""
    first = F.col("inning") == 1
    return (
        player_deliveries(spark, sf_dir)
        .join(sides_by_match(spark, sf_dir), "match_id")
        .withColumn("batting_team", F.when(first, F.col("team1")).otherwise(F.col("team2")))
        .withColumn("bowling_team", F.when(first, F.col("team2")).otherwise(F.col("team1")))
        .drop("team1", "team2")
    )


def _ball_columns() -> list[Column]:
    ball = F.concat(
        (F.col("l_quantity").cast("int") % 20).cast("string"),
        F.lit("."),
        F.col("l_linenumber").cast("string"),
    )
    return [ball.alias("Ball No"), _runs().cast("string").alias(" Runs Scored ")]


def raw_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ball-by-ball text with untidy headers and the former names."""
    first = F.col("l_linenumber") <= 4
    team1, team2 = F.col("team1"), F.col("team2")
    return (
        table(spark, sf_dir, "lineitem")
        .withColumnRenamed("l_orderkey", "match_id")
        .join(sides_by_match(spark, sf_dir), "match_id")
        .select(
            F.when(first, team1).otherwise(team2).alias("Batting Team"),
            F.when(first, team2).otherwise(team1).alias("Bowling Team"),
            *_ball_columns(),
        )
    )


def raw_ball_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows without the sides, so without the join."""
    return table(spark, sf_dir, "lineitem").select(*_ball_columns())


def raw_performance(spark: SparkSession, sf_dir: str, sides: DataFrame) -> DataFrame:
    """One pairing text per contest with deliveries, and both innings' runs."""
    first = F.col("l_linenumber") <= 4
    runs = _runs().cast("double")
    scores = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("match_id"))
        .agg(
            F.sum(F.when(first, runs)).alias("First_Innings_Score"),
            F.sum(F.when(~first, runs)).alias("Second_Innings_Score"),
        )
    )
    return scores.join(sides.select("match_id", "team1", "team2"), "match_id").select(
        "match_id",
        F.concat("team1", F.lit(" vs "), "team2").alias("Teams"),
        F.col("First_Innings_Score").cast("string").alias("First_Innings_Score"),
        F.col("Second_Innings_Score").cast("string").alias("Second_Innings_Score"),
    )


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = sides_by_match(spark, sf_dir)
    return conform(raw_performance(spark, sf_dir, sides), "team_performance")


@dataclass(frozen=True)
class History:
    """Contests and score averages for queries that read the contests several
    times: these are joined together and written once."""

    matches: DataFrame
    averages: DataFrame


def history(spark: SparkSession, sf_dir: str, trained: bool = False) -> History:
    """``trained``: score averages of the training split's contests only."""
    contests = written(raw_matches(spark, sf_dir), "contests")
    perf = conform(raw_performance(spark, sf_dir, contests), "team_performance")
    if trained:
        perf = training_rows(perf)
    return History(current_names(contests), team_score_averages(perf, NAMES))


def homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Home cities: each nation but every fifth is at home in its region."""
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_regionkey") != 4)
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("team"), F.col("r_name").alias("city"))
    )


def name_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name map as a table, read off the nations."""
    nation = table(spark, sf_dir, "nation")
    current = nation.select(
        F.col("n_name").alias("old_name"), F.col("n_name").alias("new_name")
    )
    return current.replace(NAMES, subset=["new_name"])


def form_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upcoming contest per order, as filled into a form.

    Some name a side or a venue that never played, some have no city, and some
    pair sides that never met.
    """
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    rival = F.concat(F.lit("NATION_"), ((order + customer) % 25).cast("string"))
    return _with_city(spark, sf_dir, _contests(spark, sf_dir)).select(
        order.alias("request_id"),
        "city",
        F.when(order % 53 == 0, "NEW_GROUND").otherwise(_venue()).alias("venue"),
        "team1",
        F.when(order % 101 == 0, "NEWCOMERS").otherwise(rival).alias("team2"),
        F.when(customer % 3 == 0, "Yes").otherwise("No").alias("neutral"),
        F.when(order % 2 == 0, "Team 1").otherwise("Team 2").alias("toss_winner"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests with current names and flags."""
    return request_rows(
        normalize_names(form_requests(spark, sf_dir), ["team1", "team2"], NAMES)
    )
