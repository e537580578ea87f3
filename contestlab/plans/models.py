"""MLlib classifiers over the feature tables.

Features are written once, indexed and assembled once, and all models are
fitted on and scored against those files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, partial, reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestlab.columns import CONTEST, ContestColumns
from contestlab.constants import MODEL_TRAIN_PERCENT, PERCEPTRON_SEED, SPLIT_SEED
from contestlab.functions.outcome import draw_flag_int, draw_winner_is_a
from contestlab.functions.split import in_training
from contestlab.operators.metrics import (
    METRICS,
    areas_under_roc,
    classification_rates,
    confusion,
)
from contestlab.plans.features import AVERAGES, RATES, categorical
from contestlab.sources.jobs import PARALLELISM, at_once
from contestlab.sources.scratch import FIT_PARTITIONS, TASK_ROWS, fit_partitions, laid_out, written

FEATURE_SETS = {"base": AVERAGES, "smart": AVERAGES + RATES}
HIDDEN = (10, 5)


def indexed_name(column: str) -> str:
    return f"{column}_index"


def frequency_indexer(columns: Sequence[str]) -> StringIndexer:
    """Most frequent value first; unseen values and NULL share one more index."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[indexed_name(c) for c in columns],
        handleInvalid="keep",
    )


def alphabetical_indexer(columns: Sequence[str]) -> StringIndexer:
    return frequency_indexer(columns).setStringOrderType("alphabetAsc")


def encode_unseen(df: DataFrame, indexer: StringIndexerModel) -> DataFrame:
    """Index columns where unseen values and NULL become -1."""
    out = indexer.transform(df)
    for name, labels in zip(indexer.getOutputCols(), indexer.labelsArray):
        known = F.col(name) < len(labels)
        out = out.withColumn(name, F.when(known, F.col(name)).otherwise(F.lit(-1.0)))
    return out


def one_hot(columns: Sequence[str]) -> Pipeline:
    """Alphabetical indexes, then one slot per value and one for the rest."""
    encoder = OneHotEncoder(
        inputCols=[indexed_name(c) for c in columns],
        outputCols=[f"{c}_slots" for c in columns],
        dropLast=False,
    )
    return Pipeline(stages=[alphabetical_indexer(columns), encoder])


@dataclass(frozen=True)
class Prepared:
    """Written vectors of both splits, and the stages that made them. Only a fit
    needs the training rows in their layout, which is stored when first asked for."""

    vectors: DataFrame
    key: str
    partitions: int
    stages: PipelineModel
    inputs: int
    max_bins: int
    dropped: int

    @cached_property
    def train(self) -> DataFrame:
        return laid_out(self.vectors.where("is_train"), self.key, self.partitions)

    @property
    def test(self) -> DataFrame:
        return self.vectors.where("NOT is_train")


def preparation(
    feature_set: str = "smart", missing: str = "error", c: ContestColumns = CONTEST
) -> Pipeline:
    """Indexers, optional imputer and assembler of a feature set.

    ``missing`` says what happens to a contest with a missing average or rate:
    "error" stops, "impute" takes the training mean, "skip" leaves it out.
    """
    if missing not in ("skip", "impute", "error"):
        raise ValueError(f"unknown missing: {missing}")
    cats, numbers = categorical(c), FEATURE_SETS[feature_set]
    stages: list[Estimator] = [frequency_indexer(cats)]
    if missing == "impute":
        filled = [f"{n}_filled" for n in numbers]
        stages.append(Imputer(inputCols=numbers, outputCols=filled, strategy="mean"))
        numbers = filled
    assembler = VectorAssembler(
        inputCols=[indexed_name(n) for n in cats] + list(numbers),
        outputCol="features",
        handleInvalid="skip" if missing == "skip" else "error",
    )
    return Pipeline(stages=[*stages, assembler])


def split_table(
    features: DataFrame,
    percent: int = MODEL_TRAIN_PERCENT,
    seed: int = SPLIT_SEED,
    c: ContestColumns = CONTEST,
) -> DataFrame:
    """Model columns of a feature table and the split, written once: fitting
    reads them many times, the joins behind them run a single time."""
    numbers = [n for n in FEATURE_SETS["smart"] if n in features.columns]
    is_train = in_training(c.key, percent=percent, seed=seed).alias("is_train")
    return written(
        features.select(c.key, "label", is_train, *categorical(c), *numbers), "features"
    )


def prepare(
    table: DataFrame,
    feature_set: str = "smart",
    missing: str = "error",
    c: ContestColumns = CONTEST,
    partitions: int | None = None,
) -> Prepared:
    """Index and assemble a split table, and write the vectors. The stages are
    fitted on its training rows, models on ``partitions`` parts of them; their
    number depends on the rows only, unless given."""
    stages = preparation(feature_set, missing, c).fit(table.where("is_train"))
    assembled = stages.transform(table).select(c.key, "label", "is_train", "features")
    vectors = written(assembled, "vectors")
    labels = stages.stages[0].labelsArray
    rows = vectors.count()
    return Prepared(
        vectors=vectors,
        key=c.key,
        partitions=partitions or fit_partitions(rows, TASK_ROWS),
        stages=stages,
        inputs=len(categorical(c)) + len(FEATURE_SETS[feature_set]),
        # Each indexed column has one more category, for unseen values.
        max_bins=max([32, *[len(values) + 1 for values in labels]]),
        dropped=table.count() - rows,
    )


def perceptron(inputs: int, label: str = "label", max_iter: int = 100):
    return MultilayerPerceptronClassifier(
        labelCol=label,
        featuresCol="features",
        maxIter=max_iter,
        layers=[inputs, *HIDDEN, 2],
        blockSize=128,
        seed=PERCEPTRON_SEED,
    )


def classifiers(
    prepared: Prepared, trees: int = 100, boosting_rounds: int = 50, seed: int = SPLIT_SEED
) -> dict[str, Estimator]:
    """The five classifiers, sized for the prepared features. All seeds are
    pinned and the rows have a fixed layout, so a fit repeats on any machine."""
    target = {"labelCol": "label", "featuresCol": "features"}
    tree = {**target, "maxDepth": 5, "maxBins": prepared.max_bins, "seed": seed}
    return {
        "decision_tree": DecisionTreeClassifier(**tree),
        "random_forest": RandomForestClassifier(**tree, numTrees=trees),
        "gbt": GBTClassifier(**tree, maxIter=boosting_rounds),
        "logistic_regression": LogisticRegression(**target, maxIter=100),
        "perceptron": perceptron(prepared.inputs),
    }


def fit_models(
    prepared: Prepared, estimators: Mapping[str, Estimator], parallelism: int = PARALLELISM
) -> dict[str, Model]:
    """Fitted models by name. Each running fit caches the training rows, so
    lower ``parallelism`` where executors cannot hold that many copies."""
    work = {name: partial(e.fit, prepared.train) for name, e in estimators.items()}
    return at_once(prepared.train.sparkSession, work, parallelism)


def pipeline_model(prepared: Prepared, model: Model) -> PipelineModel:
    """Preparation and model as one pipeline, ready to be saved."""
    return PipelineModel(stages=[*prepared.stages.stages, model])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_models(
    rows: DataFrame, models: Mapping[str, Model], keep: Sequence[str]
) -> DataFrame:
    """One row per model and contest, from one pass over ``rows``.

    ``score`` ranks the contests for the ROC curve; ``probability`` is that of
    the positive class.
    """

    def add(df: DataFrame, item: tuple[str, Model]) -> DataFrame:
        name, model = item
        own = model.copy(
            {
                model.predictionCol: f"{name}_prediction",
                model.rawPredictionCol: f"{name}_raw",
                model.probabilityCol: f"{name}_probability",
            }
        )
        return own.transform(df)

    scored = reduce(add, models.items(), rows)
    per_model = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(f"{name}_prediction").alias("prediction"),
            F.get(vector_to_array(f"{name}_raw"), F.lit(1)).alias("score"),
            F.get(vector_to_array(f"{name}_probability"), F.lit(1)).alias("probability"),
        )
        for name in models
    ]
    return scored.select(*keep, F.inline(F.array(*per_model)))


def model_metrics(
    scored: DataFrame, by: Sequence[str] = ("model",), label: str = "label"
) -> DataFrame:
    """(by, metric, value), values times 100: one pass for the counts of all
    models, and one for their areas."""
    rates = classification_rates(confusion(scored, by, label))
    table = rates.join(areas_under_roc(scored, by, label=label), list(by))
    return table.unpivot(list(by), [*METRICS, "auc"], "metric", "value").withColumn(
        "value", F.col("value") * 100
    )


@dataclass(frozen=True)
class Comparison:
    """``scored``: (feature_set, model, key, label, prediction, score, probability),
    written, and the contests that ``missing="skip"`` left out by feature set."""

    scored: DataFrame
    dropped: dict[str, int]

    def metrics(self) -> DataFrame:
        """(feature_set, model, metric, value, dropped)."""
        table = model_metrics(self.scored, ["feature_set", "model"])
        left_out = F.create_map(*[F.lit(x) for pair in self.dropped.items() for x in pair])
        dropped = left_out[F.col("feature_set")].cast("bigint").alias("dropped")
        return table.select("feature_set", "model", "metric", "value", dropped)


def fits_at_once(partitions: int, most: int = PARALLELISM) -> int:
    """How many fits on so many partitions may run side by side: each keeps a copy
    of its rows in memory, so fits on many rows wait for one another."""
    return max(1, min(most, most * FIT_PARTITIONS // partitions))


def fit_and_score(
    features: DataFrame,
    feature_sets: Sequence[str] = ("base", "smart"),
    trees: int = 100,
    boosting_rounds: int = 50,
    missing: str = "error",
    parallelism: int = PARALLELISM,
    c: ContestColumns = CONTEST,
) -> Comparison:
    """All models on all feature sets, and the test contests that they score."""
    split = split_table(features, c=c)
    prepared = {name: prepare(split, name, missing, c) for name in feature_sets}
    fits = {
        (feature_set, name): partial(estimator.fit, p.train)
        for feature_set, p in prepared.items()
        for name, estimator in classifiers(p, trees, boosting_rounds).items()
    }
    partitions = max(p.partitions for p in prepared.values())
    fitted = at_once(features.sparkSession, fits, fits_at_once(partitions, parallelism))

    def scored(feature_set: str) -> DataFrame:
        models = {name: m for (fs, name), m in fitted.items() if fs == feature_set}
        rows = score_models(prepared[feature_set].test, models, [c.key, "label"])
        return rows.select(F.lit(feature_set).alias("feature_set"), "*")

    every = reduce(DataFrame.unionByName, [scored(name) for name in feature_sets])
    return Comparison(written(every, "scored"), {n: p.dropped for n, p in prepared.items()})


def compare_models(features: DataFrame, **options) -> DataFrame:
    """(feature_set, model, metric, value, dropped) for every model and feature
    set; ``dropped`` counts the contests that ``missing="skip"`` left out. Options
    are those of ``fit_and_score``."""
    return fit_and_score(features, **options).metrics()


def documented_table(matches: DataFrame, neutral: str, c: ContestColumns = CONTEST) -> DataFrame:
    """Inputs and target of the documented model: did the draw winner win?"""
    return matches.select(
        c.key,
        c.city,
        c.side_a,
        c.side_b,
        draw_winner_is_a(c).cast("double").alias("draw_winner_is_team1"),
        F.col(neutral).cast("double").alias("neutral"),
        draw_flag_int(c).alias("label"),
        in_training(c.key).alias("is_train"),
    )


def fit_documented_model(
    matches: DataFrame, neutral: str = "neutral_venue", c: ContestColumns = CONTEST
) -> tuple[PipelineModel, DataFrame]:
    """A perceptron over one-hot city and sides and two flags; returns the
    pipeline and the table it was fitted on."""
    table = written(documented_table(matches, neutral, c), "documented")
    rows = table.where("is_train").count()
    train = laid_out(table.where("is_train"), c.key, fit_partitions(rows, TASK_ROWS))
    columns = [c.city, c.side_a, c.side_b]
    encoding = one_hot(columns).fit(train)
    assembler = VectorAssembler(
        inputCols=[f"{n}_slots" for n in columns] + ["draw_winner_is_team1", "neutral"],
        outputCol="features",
    )
    width = sum(len(values) + 1 for values in encoding.stages[0].labelsArray) + 2
    vectors = assembler.transform(encoding.transform(train)).select("label", "features")
    model = perceptron(width).fit(vectors)
    return PipelineModel(stages=[*encoding.stages, assembler, model]), table
