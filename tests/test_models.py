import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from contestlab.operators.metrics import classification_rates, confusion
from contestlab.plans import models, recommend, tables
from contestlab.plans.features import AVERAGES, RATES
from tests.helpers import bag, physical

CITIES = [f"c{i}" for i in range(40)]


def planted(spark, n=1500, missing=0):
    """Contests whose outcome follows the pair rate, with 40 season labels."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        a, b = rng.sample(["A", "B", "C", "D"], 2)
        p = rng.random()
        won = rng.random() < (0.95 if p > 0.5 else 0.05)
        drew = rng.choice([a, b])
        rows.append(
            (
                i,
                a,
                b,
                drew,
                rng.choice(["bat", "field"]),
                rng.choice([a, b]),
                f"s{i % 40}",
                int(won),
                a if won else b,
                rng.choice(CITIES),
                f"v{i % 3}",
                None if i < missing else 150.0 + rng.random(),
                140.0 + rng.random(),
                p,
                rng.random(),
                rng.random(),
                rng.random(),
            )
        )
    return spark.createDataFrame(
        rows,
        "match_id bigint, team1 string, team2 string, toss_winner string, "
        "toss_decision string, bat_first_team string, season string, label int, "
        "winner string, city string, venue string, "
        + ", ".join(f"{c} double" for c in AVERAGES + RATES),
    )


@pytest.fixture(scope="module")
def features(spark):
    return planted(spark).cache()


@pytest.fixture(scope="module")
def prepared(features):
    return models.prepare(models.split_table(features))


@pytest.fixture(scope="module")
def fitted(prepared):
    return models.fit_models(prepared, models.classifiers(prepared, trees=20, boosting_rounds=5))


def test_split_is_disjoint_and_complete(features, prepared):
    train = {r[0] for r in prepared.train.select("match_id").collect()}
    test = {r[0] for r in prepared.test.select("match_id").collect()}
    assert not train & test and len(train | test) == 1500
    assert prepared.dropped == 0 and prepared.inputs == 12


def test_bins_cover_the_largest_category(prepared):
    assert prepared.max_bins == 41


def test_every_model_learns(prepared, fitted):
    scored = models.score_models(prepared.test, fitted, ["match_id", "label"])
    rates = {r.model: r for r in classification_rates(confusion(scored, ["model"])).collect()}
    share = prepared.test.agg(F.avg("label")).first()[0]
    majority = max(share, 1 - share)
    assert set(rates) == set(fitted)
    for name in ("decision_tree", "random_forest", "gbt", "logistic_regression"):
        assert rates[name].accuracy > majority + 0.2, name
    assert scored.count() == 5 * prepared.test.count()
    assert scored.where("probability < 0 OR probability > 1 OR probability IS NULL").count() == 0
    wrong = scored.where("model <> 'perceptron' AND (probability > 0.5) <> (prediction = 1)")
    assert wrong.count() == 0


def test_same_seed_same_model(prepared):
    def once():
        estimator = models.classifiers(prepared, trees=5)["random_forest"]
        return estimator.fit(prepared.train).toDebugString.split("\n", 1)[1]

    assert once() == once()


def test_metrics_table(prepared, fitted):
    scored = models.score_models(prepared.test, fitted, ["match_id", "label"]).cache()
    table = models.model_metrics(scored)
    assert table.columns == ["model", "metric", "value"]
    assert table.count() == 25
    assert table.where("value < 0 OR value > 100 OR value IS NULL").count() == 0


def test_saved_model_scores_alike(features, prepared, fitted, tmp_path):
    pipeline = models.pipeline_model(prepared, fitted["logistic_regression"])
    path = str(tmp_path / "model")
    models.save_model(pipeline, path)
    models.save_model(pipeline, path)  # overwrites
    loaded = models.load_model(path)
    p = vector_to_array("probability")[1].alias("p")
    assert bag(pipeline.transform(features).select("match_id", p)) == bag(
        loaded.transform(features).select("match_id", p)
    )


@pytest.mark.parametrize("missing, rows, dropped", [("skip", 290, 10), ("impute", 300, 0)])
def test_missing_numbers(spark, missing, rows, dropped):
    table = models.split_table(planted(spark, 300, missing=10))
    out = models.prepare(table, "base", missing)
    assert out.train.count() + out.test.count() == rows and out.dropped == dropped


def test_missing_numbers_stop_by_default(spark):
    with pytest.raises(Exception, match="(?i)null"):
        models.prepare(models.split_table(planted(spark, 60, missing=10)), "base").train.count()


def test_fit_does_not_depend_on_the_input_s_partitions(spark):
    def predictions(parts):
        table = models.split_table(planted(spark, 400).repartition(parts))
        out = models.prepare(table)
        estimators = models.classifiers(out, trees=5, boosting_rounds=2)
        names = ("decision_tree", "random_forest", "gbt", "perceptron")
        fitted = models.fit_models(out, {n: estimators[n] for n in names})
        scored = models.score_models(out.test, fitted, ["match_id"])
        return bag(scored.select("match_id", "model", "prediction"))

    assert predictions(3) == predictions(11)


def test_unknown_options_are_errors():
    with pytest.raises(ValueError):
        models.preparation(missing="ignore")
    with pytest.raises(KeyError):
        models.preparation(feature_set="none")


def test_unseen_values_are_minus_one(spark, features):
    indexer = models.alphabetical_indexer(["team1", "city"]).fit(features)
    rows = [("A", "c1"), ("D", "nowhere"), (None, None)]
    df = spark.createDataFrame(rows, "team1 string, city string")
    out = models.encode_unseen(df, indexer)
    assert [(r.team1_index, r.city_index) for r in out.collect()] == [
        (0.0, float(sorted(CITIES).index("c1"))),
        (3.0, -1.0),
        (-1.0, -1.0),
    ]


def test_scaling_uses_the_population_deviation(spark):
    from pyspark.ml.feature import VectorAssembler

    values = [1.0, 2.0, 3.0, 6.0]
    df = spark.createDataFrame([(v, 5.0) for v in values], "a double, b double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="raw_features").transform(df)
    out = recommend.scaling(vectors, 4).transform(vectors)
    mean = sum(values) / 4
    deviation = (sum((v - mean) ** 2 for v in values) / 4) ** 0.5
    rows = [r[0] for r in out.select(vector_to_array("features")).collect()]
    assert [r[0] for r in rows] == pytest.approx([(v - mean) / deviation for v in values])
    assert [r[1] for r in rows] == [0.0] * 4


def test_documented_model_runs(spark, features):
    flagged = features.withColumn("neutral_venue", (F.col("match_id") % 2).cast("int"))
    model, table = models.fit_documented_model(flagged)
    assert model.transform(table).count() == 1500


def test_requests_always_get_an_answer(spark, features):
    model = recommend.fit_request_model(features)
    requests = spark.createDataFrame(
        [(1, "A", "B", "c1", 150.0, 140.0), (2, "X", "Y", None, None, None)],
        "request_id int, team1 string, team2 string, city string, "
        "team1_avg_runs double, team2_avg_conceded double",
    ).withColumns({r: F.lit(0.5) for r in RATES})
    out = recommend.score_requests(requests, model).orderBy("request_id").collect()
    assert len(out) == 2
    assert all(0 <= r.probability <= 1 for r in out)
    assert all(r.recommendation == ("FIELD" if r.probability >= 0.6 else "BAT") for r in out)
    assert out[1].team1_avg_runs == pytest.approx(model.averages["team1_avg_runs"])


def test_requests_without_numbers_get_an_answer(spark, features):
    model = recommend.fit_request_model(features)
    rows = features.limit(3).withColumn("h2h_win_rate", F.lit(None).cast("double"))
    nans = features.limit(3).withColumns({n: F.lit(float("nan")) for n in AVERAGES + RATES})
    out = recommend.score_requests(rows.unionByName(nans), model).collect()
    assert len(out) == 6 and all(0 <= r["probability"] <= 1 for r in out)


def test_threshold(spark):
    df = spark.createDataFrame([(0.59,), (0.6,), (1.0,)], "probability double")
    out = [r[0] for r in df.select(recommend.recommendation()).collect()]
    assert out == ["BAT", "FIELD", "FIELD"]
    assert df.where(recommend.recommendation(threshold=0.5) == "FIELD").count() == 3


def test_request_form(spark):
    raw = spark.createDataFrame(
        [(1, "Yes", "Team 2"), (2, "No", "Team 1"), (3, None, None)],
        "request_id int, neutral string, toss_winner string",
    )
    out = recommend.request_rows(raw)
    assert out.columns == ["request_id", "neutral", "draw_winner_is_team1"]
    assert [tuple(r) for r in out.collect()] == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]


def test_node_and_weight_tables_answer_as_the_models(prepared, fitted):
    """Categorical and continuous splits, trees of several depths, all layers."""
    keys = ["match_id", "label"]
    rows = prepared.test

    def close(found, model, name, column):
        p = vector_to_array(column)[1].alias("p")
        both = found.join(model.transform(rows).select("match_id", p), "match_id")
        assert both.count() == rows.count() > 0
        assert both.where(F.abs(F.col(name) - F.col("p")) > 1e-9).count() == 0

    forest, gbt, mlp = (fitted[n] for n in ("random_forest", "gbt", "perceptron"))
    close(tables.forest_probability(rows, forest, keys), forest, "from_nodes", "probability")
    close(tables.boosted_margin(rows, gbt, keys), gbt, "from_nodes", "rawPrediction")
    close(tables.perceptron_probability(rows, mlp, keys), mlp, "from_weights", "probability")
    spark = rows.sparkSession
    nodes = tables.node_table(forest, spark).df
    assert {r[0] for r in nodes.where("left_child >= 0").select("continuous").distinct().collect()} == {True, False}
    sizes = mlp.getLayers()
    assert tables.weight_table(mlp, spark).count() == sum((n + 1) * m for n, m in zip(sizes, sizes[1:]))


def test_coefficients_are_those_before_scaling(features):
    model = recommend.fit_request_model(features)
    rows = models.encode_unseen(features, model.indexer)
    found = tables.linear_margin(rows, *recommend.coefficients(model), ["match_id"])
    scored = recommend.score_requests(features, model).select("match_id", "probability")
    both = found.join(scored, "match_id")
    gap = F.abs(tables.logistic(F.col("margin")) - F.col("probability"))
    assert both.count() == 1500 and both.where(gap > 1e-9).count() == 0


def test_comparison_has_all_metrics(spark):
    compared = models.fit_and_score(planted(spark, 300, missing=10), trees=3, boosting_rounds=2, missing="skip")
    rows = compared.metrics().collect()
    assert len(rows) == 2 * 5 * 5 and all(0 <= r["value"] <= 100 and r["dropped"] == 10 for r in rows)


def test_a_stored_layout_is_read_back_partition_for_partition(spark):
    """The partitions of the training rows, by the cores' share and by the files'."""
    table = models.split_table(planted(spark, 400).repartition(11))
    out = models.prepare(table)
    parts = out.train.rdd.glom().map(lambda p: [r["match_id"] for r in p]).collect()
    assert len(parts) == out.partitions == 8 and all(p == sorted(p) for p in parts)
    assert "Exchange" not in physical(out.train)
    assert "Exchange" not in physical(out.vectors)


def test_a_task_of_a_fit_has_a_bounded_share_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 20)
    out = models.prepare(models.split_table(planted(spark, 400)))
    assert out.partitions == out.train.rdd.getNumPartitions() == 20
    assert max(len(p) for p in out.train.rdd.glom().collect()) < 45


def test_answers_from_tables_shuffle_every_row_once(prepared, fitted):
    keys = ["match_id", "label"]
    parts = int(prepared.test.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = tables.perceptron_probability(prepared.test, fitted["perceptron"], keys)
    forest = tables.forest_probability(prepared.test, fitted["random_forest"], keys)
    for plan in (physical(found), physical(forest)):
        plan = plan[plan.index("== Physical Plan") :]
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count(f", {parts}), REPARTITION_BY_NUM") == 1


def test_fits_on_many_rows_wait_for_one_another():
    assert [models.fits_at_once(p) for p in (8, 9, 16, 36, 216)] == [5, 4, 2, 1, 1]
    assert models.fits_at_once(8, 1) == models.fits_at_once(500, 3) == 1
