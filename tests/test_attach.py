import pytest
from pyspark.sql import functions as F

from contestlab.operators.attach import Lookup, attach, heavy_keys, measured
from tests.helpers import bag, physical


@pytest.fixture
def skewed(spark):
    """Rows of which a third have one key and a sixth have none."""
    hot, none = F.col("id") % 3 == 0, F.col("id") % 6 == 1
    own = F.concat(F.lit("k"), F.col("id") % 500)
    return spark.range(0, 6000, 1, 8).select(
        "id",
        F.when(hot, "hot").when(none, F.lit(None)).otherwise(own).alias("k"),
        (F.col("id") % 2).cast("string").alias("g"),
    )


@pytest.fixture
def lookup(spark):
    keys = [("hot", "0"), ("hot", "1"), (None, "0")]
    keys += [(f"k{i}", str(i % 2)) for i in range(400)]
    rows = [(k, g, float(i), None if i % 7 == 0 else f"v{i}") for i, (k, g) in enumerate(keys)]
    return spark.createDataFrame(rows, "team string, grp string, x double, y string")


def by_team(table):
    return Lookup(table, {"team": "k", "grp": "g"}, {"x": "new_x", "y": "new_y"})


def by_key(table):
    return Lookup(table, {"k": "k"}, {"x": "x"})


def test_shuffle_equals_broadcast(skewed, lookup):
    small = attach(skewed, by_team(lookup))
    large = attach(skewed, by_team(lookup), broadcast_bytes=0)
    assert small.columns == large.columns == ["id", "k", "g", "new_x", "new_y"]
    assert small.count() == 6000
    assert bag(small) == bag(large)
    assert small.where("k IS NULL AND new_x IS NOT NULL").count() == 0
    assert small.where("k = 'hot' AND new_x IS NULL").count() == 0


@pytest.fixture
def no_merging(spark):
    """Keep small shuffle partitions apart, to see how rows are spread."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_only_a_measured_table_is_broadcast(skewed, lookup):
    assert "SortMergeJoin" not in physical(attach(skewed, by_team(lookup)))
    large = physical(attach(skewed, by_team(lookup), broadcast_bytes=0))
    assert "SortMergeJoin" in large


def test_heavy_keys_are_few(skewed):
    hot = heavy_keys(skewed, ["k"])
    assert [r.k for r in hot.collect()] == ["hot"]


def test_heavy_key_is_spread_over_tasks(no_merging, skewed, lookup):
    large = attach(
        skewed, Lookup(lookup.where("grp = '0'"), {"team": "k"}, {"x": "x"}), broadcast_bytes=0
    )
    sizes = (
        large.groupBy(F.spark_partition_id().alias("p"))
        .agg(F.count_if(F.col("k") == "hot").alias("n"))
        .collect()
    )
    assert max(r.n for r in sizes) < 2000 / 2


def test_copies_of_one_row_are_spread(no_merging, spark):
    left = spark.range(0, 4000, 1, 16).select(F.lit("hot").alias("k"))
    table = spark.createDataFrame([("hot", 1.0)], "k string, x double")
    out = attach(left, by_key(table), broadcast_bytes=0)
    assert out.where("x = 1.0").count() == 4000
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 4000 / 2


def test_measure_and_reuse(lookup):
    table = measured(lookup)
    assert table.rows == 403 and table.bytes > 403 * 32
    assert measured(table) is table


def test_existing_columns_are_replaced(spark, skewed, lookup):
    old = skewed.withColumn("new_x", F.lit(-1.0))
    out = attach(old, by_team(lookup))
    assert out.columns == ["id", "k", "g", "new_x", "new_y"]
    assert out.where("new_x = -1.0").count() == 0


def test_empty_table(spark, skewed):
    empty = spark.createDataFrame([], "k string, x double")
    for limit in (0, 1 << 20):
        out = attach(skewed, by_key(empty), broadcast_bytes=limit)
        assert out.count() == 6000 and out.where("x IS NOT NULL").count() == 0


def test_several_tables_by_shuffle(skewed, lookup):
    second = Lookup(lookup.where("grp = '1'"), {"team": "k"}, {"y": "other"})
    small = attach(skewed, by_team(lookup), second)
    large = attach(skewed, by_team(lookup), second, broadcast_bytes=0)
    assert small.columns == large.columns == ["id", "k", "g", "new_x", "new_y", "other"]
    assert bag(small) == bag(large)


def test_key_types_must_agree(spark, skewed):
    table = spark.createDataFrame([(1, 1.0)], "k int, x double")
    with pytest.raises(TypeError, match="key k"):
        attach(skewed, by_key(table))


def test_heavy_key_without_a_match_is_spread(no_merging, skewed, lookup):
    out = attach(skewed, by_team(lookup.where("team <> 'hot'")), broadcast_bytes=0)
    sizes = out.where("k = 'hot'").groupBy(F.spark_partition_id()).count()
    assert out.where("k = 'hot' AND new_x IS NULL").count() == 2000
    assert sizes.agg(F.max("count")).first()[0] < 600


def test_several_rows_for_a_key_are_an_error(skewed, lookup):
    with pytest.raises(ValueError, match="team"):
        attach(skewed, by_team(lookup.unionByName(lookup)))
    nulls = lookup.where("team IS NULL")
    assert attach(skewed, by_team(lookup.unionByName(nulls))).count() == 6000
