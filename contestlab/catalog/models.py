"""Splits, encoders, metrics, classifiers and recommendations."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.catalog import fixtures as fx
from contestlab.catalog.rates import MATCHUP_TABLES, MATCHUPS, smart_table
from contestlab.catalog.registry import registered
from contestlab.catalog.twins import train_bucket, twin
from contestlab.constants import FIELD_THRESHOLD
from contestlab.functions.outcome import label_side_a
from contestlab.functions.split import in_training, split_bucket
from contestlab.operators import metrics
from contestlab.operators.attach import measured
from contestlab.operators.place import current_homes, with_neutral_flag
from contestlab.plans import models, recommend, tables
from contestlab.plans.features import (
    AVERAGES,
    RATES,
    categorical,
    smart_features,
    with_outcomes,
)
from contestlab.sources.scratch import scratch_path



def _split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.split_table(smart_table(spark, sf_dir))


TRAIN = f"{train_bucket('match_id')} < 80"
REQUEST_TRAIN = f"{train_bucket('match_id')} < 70"


def _split_twin(percent: int) -> str:
    bucket = train_bucket("match_id")
    return twin(
        f"SELECT match_id, {bucket} AS bucket, {bucket} < {percent} AS is_train FROM matches",
        "matches",
    )


def _split(spark: SparkSession, sf_dir: str, percent: int) -> DataFrame:
    return fx.matches(spark, sf_dir).select(
        "match_id",
        split_bucket("match_id").alias("bucket"),
        in_training("match_id", percent=percent).alias("is_train"),
    )


@registered(_split_twin(80))
def hash_split_80(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, 80)


@registered(_split_twin(70))
def hash_split_70(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, 70)


def _index_parts(
    rows: str, columns: list[str], order: str, where: str = "TRUE"
) -> tuple[dict[str, str], str, str]:
    """Per column: a rank table, its join, and the index with n for the rest."""
    tables, joins, outputs = {}, [], []
    for c in columns:
        tables[f"ix_{c}"] = (
            f"SELECT {c} AS value, CAST(row_number() OVER (ORDER BY {order}) - 1 AS BIGINT) AS ix,"
            f" count(*) OVER () AS n FROM (SELECT {c}, count(*) AS cnt FROM {rows}"
            f" WHERE {c} IS NOT NULL AND {where} GROUP BY {c}) g"
        ).replace("value_column", c)
        joins.append(f"LEFT JOIN ix_{c} ON ix_{c}.value = m.{c}")
        size = f"(SELECT count(*) FROM ix_{c})"
        outputs.append(f"coalesce(ix_{c}.ix, {size}) AS {c}_index")
    return tables, " ".join(joins), ", ".join(outputs)


BY_FREQUENCY = "cnt DESC, value_column"
ALPHABETICAL = "value_column"

_freq_tables, _freq_joins, _freq_outputs = _index_parts("flagged", categorical(), BY_FREQUENCY)


def _whole_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


@registered(
    twin(
        f"SELECT m.match_id, {_freq_outputs} FROM flagged m {_freq_joins}",
        "flagged",
        **_freq_tables,
    )
)
def index_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_outcomes(fx.matches(spark, sf_dir))
    columns = [models.indexed_name(c) for c in categorical()]
    indexed = models.frequency_indexer(categorical()).fit(rows).transform(rows)
    return _whole_numbers(indexed.select("match_id", *columns), columns)


_abc_tables, _abc_joins, _abc_outputs = _index_parts(
    "matches", recommend.encoded(), ALPHABETICAL
)


@registered(
    twin(
        f"SELECT m.match_id, {_abc_outputs} FROM matches m {_abc_joins}",
        "matches",
        **_abc_tables,
    )
)
def index_alphabetical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.matches(spark, sf_dir)
    columns = [models.indexed_name(c) for c in recommend.encoded()]
    indexed = models.alphabetical_indexer(recommend.encoded()).fit(rows).transform(rows)
    return _whole_numbers(indexed.select("match_id", *columns), columns)


@registered(
    twin(
        "SELECT m.request_id, "
        + ", ".join(f"coalesce(ix_{c}.ix, -1) AS {c}_index" for c in recommend.encoded())
        + f" FROM requests m {_abc_joins}",
        "requests",
        "matches",
        **_abc_tables,
    )
)
def encode_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexer = models.alphabetical_indexer(recommend.encoded()).fit(fx.matches(spark, sf_dir))
    columns = [models.indexed_name(c) for c in recommend.encoded()]
    rows = models.encode_unseen(fx.requests(spark, sf_dir), indexer)
    return _whole_numbers(rows.select("request_id", *columns), columns)


_hot = ("city", "team1", "team2")


@registered(
    twin(
        " UNION ALL ".join(
            f"SELECT match_id, '{c}' AS name, {c}_index AS slot FROM indexed" for c in _hot
        ),
        "matches",
        **{f"ix_{c}": _abc_tables[f"ix_{c}"] for c in _hot},
        indexed="SELECT m.match_id, "
        + ", ".join(
            f"coalesce(ix_{c}.ix, (SELECT count(*) FROM ix_{c})) AS {c}_index" for c in _hot
        )
        + " FROM matches m "
        + " ".join(f"LEFT JOIN ix_{c} ON ix_{c}.value = m.{c}" for c in _hot),
    )
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slots that are set, one row each."""
    rows = fx.matches(spark, sf_dir)
    encoded = models.one_hot(_hot).fit(rows).transform(rows)
    slots = F.array(
        *[
            F.struct(F.lit(c).alias("name"), vector_to_array(f"{c}_slots").alias("slots"))
            for c in _hot
        ]
    )
    return (
        encoded.select("match_id", F.inline(slots))
        .select("match_id", "name", F.posexplode("slots").alias("slot", "is_set"))
        .where("is_set = 1")
        .select("match_id", "name", F.col("slot").cast("bigint").alias("slot"))
    )


_train_tables, _train_joins, _train_outputs = _index_parts(
    "smart", categorical(), BY_FREQUENCY, TRAIN
)


@registered(
    twin(
        f"""SELECT m.match_id, m.label, {TRAIN.replace('match_id', 'm.match_id')} AS is_train,
                   {_train_outputs}, round(m.team1_avg_runs, 6) AS team1_avg_runs,
                   round(m.team2_avg_conceded, 6) AS team2_avg_conceded,
                   {', '.join('m.' + r for r in RATES)}
            FROM smart m {_train_joins}
            WHERE {' AND '.join(f'm.{n} IS NOT NULL' for n in AVERAGES + RATES)}""",
        "smart",
        **_train_tables,
    )
)
def assembled_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vectors of both splits, one column per slot."""
    prepared = models.prepare(_split_features(spark, sf_dir))
    indexes = [models.indexed_name(c) for c in categorical()]
    rows = prepared.vectors.withColumn("v", vector_to_array("features"))
    slots = [
        F.get("v", F.lit(i)).alias(n) for i, n in enumerate([*indexes, *AVERAGES, *RATES])
    ]
    flat = rows.select("match_id", "label", "is_train", *slots)
    return _whole_numbers(flat, indexes).withColumns({n: F.round(n, 6) for n in AVERAGES})


_inputs = recommend.model_inputs()
_abc_smart, _abc_smart_joins, _abc_smart_outputs = _index_parts(
    "smart", recommend.encoded(), ALPHABETICAL
)


@registered(
    twin(
        "SELECT match_id, "
        + ", ".join(f"round(({n} - m_{n}) / s_{n}, 6) AS {n}" for n in _inputs)
        + " FROM matrix, scale",
        "smart",
        **_abc_smart,
        matrix=f"""SELECT m.match_id, {_abc_smart_outputs},
                          {', '.join('m.' + n for n in AVERAGES + RATES)}
                   FROM smart m {_abc_smart_joins}
                   WHERE {' AND '.join(f'm.{n} IS NOT NULL' for n in AVERAGES + RATES)}""",
        scale="SELECT "
        + ", ".join(f"avg({n}) AS m_{n}, stddev_pop({n}) AS s_{n}" for n in _inputs)
        + f" FROM matrix WHERE {REQUEST_TRAIN}",
    )
)
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs of the request model, centred and scaled as on its training rows."""
    _, vectors, _ = recommend.request_vectors(smart_table(spark, sf_dir))
    train = vectors.where("is_train")
    scaled = recommend.scaling(train, train.count()).transform(vectors)
    slots = scaled.withColumn("v", vector_to_array("features"))
    return slots.select(
        "match_id", *[F.round(F.get("v", F.lit(i)), 6).alias(n) for i, n in enumerate(_inputs)]
    )


# Fixed predictions for the metric checks: a score with many ties.
_SCORED = """SELECT match_id, label, (match_id * 7919 % 1000) / 1000.0 AS score,
                    CASE WHEN (match_id * 7919 % 1000) >= 500 THEN 1 ELSE 0 END AS prediction
             FROM flagged"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.col("match_id") * 7919 % 1000
    return fx.matches(spark, sf_dir).select(
        "match_id",
        label_side_a().alias("label"),
        (score / 1000.0).alias("score"),
        (score >= 500).cast("int").alias("prediction"),
    )


_COUNTS = """SELECT count(CASE WHEN label = 1 AND prediction = 1 THEN 1 END) AS tp,
                    count(CASE WHEN label = 0 AND prediction = 0 THEN 1 END) AS tn,
                    count(CASE WHEN label = 0 AND prediction = 1 THEN 1 END) AS fp,
                    count(CASE WHEN label = 1 AND prediction = 0 THEN 1 END) AS fn
             FROM scored"""


@registered(twin("SELECT * FROM counts", "flagged", scored=_SCORED, counts=_COUNTS))
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_scored(spark, sf_dir))


@registered(
    twin(
        """SELECT round((tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), 6) AS accuracy
           FROM counts""",
        "flagged",
        scored=_SCORED,
        counts=_COUNTS,
    )
)
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = metrics.classification_rates(metrics.confusion(_scored(spark, sf_dir)))
    return rates.select(F.round("accuracy", 6).alias("accuracy"))


@registered(
    twin(
        """SELECT round(p, 6) AS precision, round(r, 6) AS recall,
                  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1
           FROM shares""",
        "flagged",
        scored=_SCORED,
        counts=_COUNTS,
        shares="""SELECT CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS p,
                         CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS r
                  FROM counts""",
    )
)
def precision_recall_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = metrics.classification_rates(metrics.confusion(_scored(spark, sf_dir)))
    return rates.select(*[F.round(n, 6).alias(n) for n in ("precision", "recall", "f1")])


@registered(
    twin(
        """SELECT round((sum(CASE WHEN label = 1 THEN rnk ELSE 0 END)
                         - sum(label) * (sum(label) + 1) / 2.0)
                        / (CAST(sum(label) AS DOUBLE) * sum(1 - label)), 6) AS auc
           FROM ranked""",
        "flagged",
        scored=_SCORED,
        ranked="""SELECT label, rank() OVER (ORDER BY score)
                         + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rnk
                  FROM scored""",
    )
)
def auc_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = metrics.areas_under_roc(_scored(spark, sf_dir))
    return areas.select(F.round("auc", 6).alias("auc"))


@registered(
    twin(
        """SELECT request_id, CASE WHEN (request_id * 7919 % 1000) / 1000.0 >= 0.6 THEN 'FIELD'
                                   ELSE 'BAT' END AS recommendation
           FROM requests""",
        "requests",
    )
)
def recommend_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = (F.col("request_id") * 7919 % 1000 / 1000.0).alias("probability")
    rows = fx.requests(spark, sf_dir).select("request_id", p)
    return rows.select("request_id", recommend.recommendation().alias("recommendation"))


# Models are not SQL, but what has to hold for them is: each query below returns
# the test contests and whether the property was found in the scored rows.
GRADIENT = 1e-4


def _test_twin(proof: str) -> str:
    return twin(f"SELECT match_id, label, TRUE AS {proof} FROM smart WHERE NOT ({TRAIN})", "smart")


def _fitted(spark: SparkSession, sf_dir: str, name: str) -> tuple[models.Prepared, Model]:
    prepared = models.prepare(_split_features(spark, sf_dir))
    return prepared, models.classifiers(prepared)[name].fit(prepared.train)


def _won() -> Column:
    return F.get(vector_to_array("probability"), F.lit(1))


def _predicts_larger() -> Column:
    return F.col("prediction") == (_won() > 0.5).cast("double")


def _log_loss(label: Column, p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    return F.avg(F.when(label == 1, -F.log(p)).otherwise(-F.log(1 - p)))


def _has_learned(model: Model, train: DataFrame) -> Column:
    """Is the training loss below that of the best constant answer?"""
    label = F.col("label")
    found = model.transform(train).agg(_log_loss(label, _won()).alias("loss"), F.avg(label).alias("p"))
    loss, p = found.first()
    constant = -(p * math.log(p) + (1 - p) * math.log(1 - p))
    return F.lit(loss < constant)


def _largest_gradient(scored: DataFrame, weights: Sequence[float] | None = None) -> float:
    """The largest derivative of the mean log loss by the intercept and by the
    weights of the standardised features; ``weights`` adds a penalty's."""
    slots = len(scored.first()["features"])
    rows = scored.select(
        (_won() - F.col("label")).alias("error"), vector_to_array("features").alias("x")
    )
    pulls = [
        F.try_divide(F.covar_pop(F.get("x", F.lit(i)), "error"), F.stddev_pop(F.get("x", F.lit(i))))
        + F.lit(0.0 if weights is None else weights[i])
        for i in range(slots)
    ]
    found = rows.agg(F.avg("error"), *pulls).first()
    return max(abs(v) for v in found if v is not None)


@registered(_test_twin("is_leaf_share"))
def model_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the probability the share of wins among the leaf's training rows?"""
    prepared, model = _fitted(spark, sf_dir, "decision_tree")
    model.setLeafCol("leaf")
    shares = model.transform(prepared.train).groupBy("leaf").agg(F.avg("label").alias("share"))
    scored = model.transform(prepared.test).join(shares, "leaf", "left")
    holds = (F.abs(_won() - F.col("share")) < 1e-9) & _predicts_larger()
    return scored.select("match_id", "label", holds.alias("is_leaf_share"))


def _same(p: str) -> Column:
    """Is the model's probability the one computed from its tables?"""
    return F.abs(F.col("won") - F.col(p)) < 1e-9


def _test_rows(model: Model, prepared: models.Prepared) -> DataFrame:
    scored = model.transform(prepared.test)
    return scored.select("match_id", "label", "features", _won().alias("won"), _predicts_larger().alias("larger"))


_KEYS = ["match_id", "label", "won", "larger"]


@registered(_test_twin("is_mean_of_leaves"))
def model_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the probability the mean of the leaves that the table of nodes leads to?"""
    prepared, model = _fitted(spark, sf_dir, "random_forest")
    found = tables.forest_probability(_test_rows(model, prepared), model, _KEYS)
    holds = (_same("from_nodes") & F.col("larger")).alias("is_mean_of_leaves")
    return found.select("match_id", "label", holds)


@registered(_test_twin("is_logistic_of_margin"))
def model_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the probability that of the margin summed over the table of nodes, and has
    the model learned?"""
    prepared, model = _fitted(spark, sf_dir, "gbt")
    found = tables.boosted_margin(_test_rows(model, prepared), model, _KEYS, "margin")
    p = found.withColumn("from_nodes", tables.logistic(2 * F.col("margin")))
    holds = _same("from_nodes") & F.col("larger") & _has_learned(model, prepared.train)
    return p.select("match_id", "label", holds.alias("is_logistic_of_margin"))


@registered(_test_twin("is_optimal"))
def model_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the gradient of the training loss zero at the solution?"""
    prepared, model = _fitted(spark, sf_dir, "logistic_regression")
    optimal = F.lit(_largest_gradient(model.transform(prepared.train)) < GRADIENT)
    holds = optimal & _predicts_larger()
    return model.transform(prepared.test).select("match_id", "label", holds.alias("is_optimal"))


@registered(_test_twin("is_consistent"))
def model_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the probability that of the table of weights, and has the model learned?"""
    prepared, model = _fitted(spark, sf_dir, "perceptron")
    found = tables.perceptron_probability(_test_rows(model, prepared), model, _KEYS)
    holds = _same("from_weights") & F.col("larger") & _has_learned(model, prepared.train)
    return found.select("match_id", "label", holds.alias("is_consistent"))


_MODELS = ("decision_tree", "random_forest", "gbt", "logistic_regression", "perceptron")


@registered(
    twin(
        f"""SELECT feature_set, model, metric, positives, negatives, TRUE AS is_exact
            FROM (SELECT sum(label) AS positives, sum(1 - label) AS negatives FROM smart
                  WHERE NOT ({TRAIN})
                    AND {' AND '.join(f'{n} IS NOT NULL' for n in AVERAGES + RATES)}) c,
                 (VALUES {', '.join(f"('{n}')" for n in models.FEATURE_SETS)}) f(feature_set),
                 (VALUES {', '.join(f"('{n}')" for n in _MODELS)}) m(model),
                 (VALUES {', '.join(f"('{n}')" for n in [*metrics.METRICS, 'auc'])}) k(metric)""",
        "smart",
    ).replace("sum(label)", "CAST(sum(label) AS BIGINT)").replace(
        "sum(1 - label)", "CAST(sum(1 - label) AS BIGINT)"
    )
)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is each metric of five models on two feature sets what the scored test
    contests say: shares of plain means for the counts, and for the area the share
    of pairs of contests that the score has in the right order?"""
    compared = models.fit_and_score(smart_table(spark, sf_dir))
    by = ["feature_set", "model"]
    said, actual = F.col("prediction"), F.col("label").cast("double")
    right, hit = (said == actual).cast("double"), F.coalesce
    none = F.lit(0.0)
    precision = hit(F.avg(F.when(said == 1, actual)), none)
    recall = hit(F.avg(F.when(actual == 1, said)), none)
    plain = compared.scored.groupBy(*by).agg(
        F.count_if(actual == 1).alias("positives"),
        F.count_if(actual == 0).alias("negatives"),
        F.avg(right).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        hit(F.try_divide(2 * F.sum(said * actual), F.sum(said) + F.sum(actual)), none).alias("f1"),
    )
    ordered = F.col("positives") * (F.col("negatives_below") + F.col("negatives") / 2)
    pairs = F.sum("positives").cast("double") * F.sum("negatives")
    areas = metrics.ranked_scores(compared.scored, by).groupBy(*by).agg(
        hit(F.try_divide(F.sum(ordered), pairs), none).alias("auc")
    )
    want = plain.join(areas, by).unpivot(
        [*by, "positives", "negatives"], [*metrics.METRICS, "auc"], "metric", "want"
    )
    holds = F.col("value").between(0, 100) & (F.abs(F.col("value") - 100 * F.col("want")) < 1e-6)
    return compared.metrics().join(want, [*by, "metric"]).select(
        *by, "metric", "positives", "negatives", holds.alias("is_exact")
    )


@registered(
    twin(
        f"""SELECT match_id, CASE WHEN toss_match_win THEN 1 ELSE 0 END AS label,
                   TRUE AS is_weighted_sum
            FROM flagged WHERE NOT ({TRAIN})""",
        "flagged",
    )
)
def model_documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the probability of the perceptron over one-hot inputs that of its table
    of weights, layer by layer?"""
    homes = current_homes(fx.homes(spark, sf_dir), fx.NAMES)
    matches = with_neutral_flag(fx.matches(spark, sf_dir), homes)
    model, table = models.fit_documented_model(matches)
    scored = model.transform(table.where("NOT is_train")).select(
        "match_id", "label", "features", _won().alias("won"), _predicts_larger().alias("larger")
    )
    found = tables.perceptron_probability(scored, model.stages[-1], _KEYS)
    holds = (_same("from_weights") & F.col("larger")).alias("is_weighted_sum")
    return found.select("match_id", "label", holds)


@registered(
    twin(
        f"""SELECT match_id, TRUE AS same FROM smart
            WHERE NOT ({TRAIN}) AND {' AND '.join(f'{n} IS NOT NULL' for n in AVERAGES + RATES)}""",
        "smart",
    )
)
def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the probability the same after saving and loading the pipeline?"""
    table = _split_features(spark, sf_dir)
    prepared = models.prepare(table)
    estimator = models.classifiers(prepared)["logistic_regression"]
    pipeline = models.pipeline_model(prepared, estimator.fit(prepared.train))
    path = scratch_path(spark, "saved-model")
    models.save_model(pipeline, path)
    test = table.where("NOT is_train")
    p = F.get(vector_to_array("probability"), F.lit(1))
    once = pipeline.transform(test).select(*test.columns, p.alias("saved"))
    twice = models.load_model(path).transform(once)
    return twice.select("match_id", (F.col("saved") == p).alias("same"))


@registered(
    twin(
        f"""SELECT count(CASE WHEN toss_match_win THEN 1 END) AS positives,
                   count(CASE WHEN toss_match_win THEN NULL ELSE 1 END) AS negatives,
                   TRUE AS is_accuracy, TRUE AS is_optimal
            FROM smart WHERE NOT ({REQUEST_TRAIN})""",
        "smart",
    )
)
def model_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out counts of the request model. Is the accuracy theirs, and the
    gradient of the penalised loss zero at the solution?"""
    model = recommend.fit_request_model(smart_table(spark, sf_dir))
    regression = model.scorer.stages[-1]
    penalty = regression.getRegParam()
    pulls = [penalty * float(w) for w in regression.coefficients]
    scored = model.scorer.transform(model.vectors)
    optimal = _largest_gradient(scored.where("is_train"), pulls) < GRADIENT
    rates = metrics.classification_rates(metrics.confusion(scored.where("NOT is_train")))
    return rates.select(
        F.expr("tp + fn").alias("positives"),
        F.expr("tn + fp").alias("negatives"),
        (F.abs(F.col("accuracy") - F.expr("(tp + tn) / (tp + tn + fp + fn)")) < 1e-12).alias(
            "is_accuracy"
        ),
        F.lit(optimal).alias("is_optimal"),
    )


def recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request with its features, probability and recommendation."""
    past, asked = fx.history(spark, sf_dir), fx.requests(spark, sf_dir)
    averages = measured(past.averages)  # read by both feature tables
    model = recommend.fit_request_model(smart_features(past.matches, averages))
    features = recommend.matchup_features(asked, past.matches, averages)
    return recommend.score_requests(features, model)


@registered(
    twin(
        f"""SELECT request_id, city, venue, team1, team2, neutral, draw_winner_is_team1,
                   {', '.join(f"round(coalesce({n}, (SELECT avg({n}) FROM smart WHERE {REQUEST_TRAIN})), 6) AS {n}" for n in AVERAGES)},
                   {', '.join(RATES)}, TRUE AS follows_rule
            FROM matchups""",
        "smart",
        "requests",
        **MATCHUP_TABLES,
        matchups=MATCHUPS,
    )
)
def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request with its features. Is its probability that of the table of
    coefficients, and its recommendation by the rule for it?"""
    past, asked = fx.history(spark, sf_dir), fx.requests(spark, sf_dir)
    averages = measured(past.averages, ["Team"])
    model = recommend.fit_request_model(smart_features(past.matches, averages))
    features = recommend.matchup_features(asked, past.matches, averages)
    scored = recommend.score_requests(features, model)
    inputs = models.encode_unseen(scored, model.indexer)
    coefficients, intercept = recommend.coefficients(model)
    keys = [*scored.columns]
    found = tables.linear_margin(inputs, coefficients, intercept, keys)
    p = F.col("probability")
    rule = F.when(p >= FIELD_THRESHOLD, "FIELD").otherwise("BAT")
    holds = (F.abs(p - tables.logistic(F.col("margin"))) < 1e-9) & (F.col("recommendation") == rule)
    rounded = {n: F.round(n, 6) for n in AVERAGES + RATES}
    return found.withColumns(rounded).select(*asked.columns, *rounded, holds.alias("follows_rule"))
